"""The store against sorting everything."""

import datetime as dt

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.sources import store

RUN = dt.datetime(2024, 3, 2, 19, 0, tzinfo=dt.timezone.utc)
SCORED = "source string, title string, sentiment_score double, ticker string"
DAY = dt.timedelta(days=1)


def scored(spark, count, score=None):
    return spark.createDataFrame(
        [(f"s{k % 3}", f"T{k % 17}", 0.5 if score else k % 7 / 7, "A") for k in range(count)], SCORED)


@pytest.fixture
def filled(spark, new_path):
    """Four runs on three days, in files of at most 10 rows."""
    for run_at, count in ((RUN, 95), (RUN - DAY, 40), (RUN + dt.timedelta(hours=2), 33), (RUN - 3 * DAY, 7)):
        store.store_sentiment(scored(spark, count), new_path, run_at, rows_per_file=10)
    return new_path


def in_order(spark, path):
    rows = store.read_sentiment(spark, path).collect()
    return sorted(((r.created_at, r.id) for r in rows), key=lambda k: (-k[0].timestamp(), k[1]))


def test_ids_are_distinct_without_gaps_and_stable(spark, new_path):
    rows = scored(spark, 200, 0.5)
    store.store_sentiment(rows, new_path, RUN)
    ids = sorted(values(store.read_sentiment(spark, new_path), "id"))
    assert ids == [f"20240302T190000.000000Z-{k:012d}" for k in range(1, 201)]
    before = sorted(map(tuple, store.read_sentiment(spark, new_path).collect()))
    store.store_sentiment(rows.repartition(5), new_path, RUN, replace_run=True)
    assert sorted(map(tuple, store.read_sentiment(spark, new_path).collect())) == before
    store.store_sentiment(rows, new_path, RUN)
    ids = values(store.read_sentiment(spark, new_path), "id")
    assert len(ids) == len(set(ids)) == 400 and max(ids).endswith("-000000000400")
    assert "Window" not in plan_of(store.stored_sentiment(rows, RUN))


def test_pages_equal_sorting_everything(spark, filled):
    wanted = in_order(spark, filled)
    assert len(wanted) == 175
    for offset, limit in ((0, 5), (0, 1), (28, 10), (33, 7), (120, 20), (125, 10), (160, 100), (174, 1), (0, 1000)):
        page = store.stored_page(spark, filled, limit, offset)
        got = values(page, "created_at", "id")
        assert got == wanted[offset:offset + limit]
        if limit <= 10:  # the page at 28 goes over a last file of three rows into the next run
            assert len(page.inputFiles()) == 3 if offset == 28 else len(page.inputFiles()) <= 2
    assert store.stored_page(spark, filled, 10, 175).collect() == []
    assert store.stored_page(spark, filled, 10, 9999).columns == ["id", *store.PAGE_COLUMNS]


def test_paging_by_the_last_row(spark, filled):
    wanted, seen = in_order(spark, filled), []
    last = (RUN + 10 * DAY, "")
    while page := values(store.page_after(spark, filled, *last, 25), "created_at", "id"):
        seen += page
        last = (page[-1][0].replace(tzinfo=dt.timezone.utc), page[-1][1])
    assert seen == wanted
    one = store.page_after(spark, filled, RUN, "20240302T190000.000000Z-000000000050", 10)
    assert [r.id[-3:] for r in one.collect()] == [f"{k:03d}" for k in range(51, 61)]
    assert len(one.inputFiles()) <= 2
    gone = store.page_after(spark, filled, RUN, "20240302T190000.000000Z-000000000050x", 1).first()
    assert gone.id.endswith("051")
    assert store.page_after(spark, filled, RUN - 9 * DAY, "", 5).collect() == []


def test_overlapping_files_are_read_together(spark, new_path):
    """Two writers that gave equal ids to one run."""
    for _ in range(2):
        rows = store.stored_sentiment(scored(spark, 30), RUN)
        rows.repartition(3).write.partitionBy("run_date").mode("append").parquet(new_path)
    store.write_index(spark, new_path, RUN.date())
    wanted = in_order(spark, new_path)
    assert values(store.stored_page(spark, new_path, 9, 25), "created_at", "id") == wanted[25:34]


def test_replacing_a_day_replaces_its_index(spark, filled):
    store.store_sentiment(scored(spark, 3), filled, RUN, replace_run=True)
    index = store.read_index(spark, filled)
    assert index.agg(F.sum("rows")).first()[0] == store.read_sentiment(spark, filled).count() == 50
    assert values(store.stored_page(spark, filled, 50, 0), "created_at", "id") == in_order(spark, filled)


def test_dates_prune_folders(spark, filled):
    day = (RUN - DAY).date()
    rows = store.read_sentiment(spark, filled, first_date=day, last_date=day, with_run_date=True)
    assert rows.columns == [*schemas.STORED_SENTIMENT.fieldNames(), "run_date"]
    assert set(values(rows, "run_date")) == {day} and rows.count() == 40
    assert "PartitionFilters: [isnotnull(run_date" in plan_of(rows)
    assert store.read_sentiment(spark, filled, first_date=RUN.date()).count() == 128
    assert store.read_sentiment(spark, filled).count() == 175


def test_store_of_nothing(spark, new_path):
    assert store.rows_of_run(spark, new_path, RUN) == 0
    assert store.stored_page(spark, new_path).collect() == []
    store.store_sentiment(scored(spark, 4), new_path, RUN)
    store.store_sentiment(scored(spark, 0), new_path, RUN - DAY)
    assert len(store.stored_page(spark, new_path).collect()) == 4
