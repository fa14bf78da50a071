"""Numbers and ranks over many tasks against sorting in one place."""

import datetime as dt
import random

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import articles as art
from tallyloom.operators import ordering


@pytest.fixture
def many_ranges(spark):
    """Ranges of a few rows each, so that groups and ties spread over several."""
    conf = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def rows_of(seed, count=400):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "a", "b", None]), rng.choice([1, 1, 1, 2, 5, 9, None]), k % 50) for k in range(count)]


def test_numbers_have_no_gaps(spark, many_ranges):
    rows = rows_of(1)
    table = spark.createDataFrame(rows, "g string, v int, k int")
    order = [F.asc("v"), F.desc("k")]
    got = ordering.numbered(table, order, start=11)
    assert got.columns == ["g", "v", "k", "number"]
    in_order = sorted((r.number, r.v, r.k) for r in got.collect())
    assert [number for number, _, _ in in_order] == list(range(11, 411))
    wanted = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, -r[2]))
    assert [(v, k) for _, v, k in in_order] == [(v, k) for _, v, k in wanted]
    assert ordering.numbered(table.where("false"), order).count() == 0


def test_numbers_do_not_depend_on_partitions(spark, many_ranges):
    table = spark.createDataFrame([(k,) for k in range(300)], "k int")
    one, two = (dict(values(ordering.numbered(table.repartition(n), [F.desc("k")]), "k", "number")) for n in (2, 9))
    assert one == two == {k: 300 - k for k in range(300)}


def test_equal_rows_are_spread(spark, many_ranges):
    table = spark.createDataFrame([("x",)] * 2000, "g string")
    placed = ordering.in_ranges(table, [F.asc("g")], "equal")
    sizes = values(placed.groupBy(ordering.RANGE).count(), "count")
    assert len(sizes) == 7 and max(sizes) < 800


@pytest.mark.parametrize("group", [["g"], ["g", "v"]])
def test_ranks_equal_row_number(spark, many_ranges, group):
    rows = rows_of(3)
    table = spark.createDataFrame(rows, "g string, v int, k int")
    got = ordering.ranked_within(table, group, [F.desc("k")], "place")
    by_group = {}
    for row in got.collect():
        by_group.setdefault(tuple(row[name] for name in group), []).append((row.place, row.k))
    assert sum(map(len, by_group.values())) == len(rows)
    for found in by_group.values():
        found.sort()
        assert [place for place, _ in found] == list(range(1, len(found) + 1))
        assert [k for _, k in found] == sorted((k for _, k in found), reverse=True)


def tagged(spark, count=3000):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = [("t", "x", rng.choice([None] + [start + dt.timedelta(minutes=rng.randint(0, 9000))] * 6), f"u{k}", "s",
             rng.choice(["A", "A", "A", "B"])) for k in range(count)]
    rows += [("t", "x", start + dt.timedelta(days=9), f"same{k}", "s", "A") for k in range(500)]
    rows += [("t", "x", None, f"old{k}", "s", "undated") for k in range(30)]
    return spark.createDataFrame(rows, "title string, text string, published timestamp, url string, source string, ticker string")


@pytest.mark.parametrize("count", [5, 20, 300, 2500, 90000])
def test_latest_of_any_count(spark, many_ranges, count):
    table = tagged(spark)
    wanted = sorted(map(tuple, art.latest_per_ticker(table, count).select("ticker", "url", "position").collect()))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "4")
    try:
        got = art.latest_per_ticker(table, count)
        assert got.schema["position"].dataType.simpleString() == "int"
        assert sorted(map(tuple, got.select("ticker", "url", "position").collect())) == wanted
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_old_articles_go_before_the_exchange(spark, new_path):
    tagged(spark).write.parquet(new_path)
    table = spark.read.parquet(new_path)
    recent = art.recent_enough(table, 600)
    assert recent.where("ticker = 'A'").count() < 700 and recent.where("ticker = 'undated'").count() == 30
    plan = plan_of(recent)
    assert "Exchange hashpartitioning" not in plan and "since" in plan
    assert schemas.ARTICLE.fieldNames()[0] in recent.columns
