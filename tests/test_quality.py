import datetime as dt
import logging

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom.operators import quality
from tallyloom.sources import results

RATED = "movie_id int, rating double"


@pytest.mark.parametrize("rows, nulls, ranged, unique", [
    ([(1, 0.0), (2, 5.0)], True, True, True),
    ([(1, -0.1), (2, 5.0)], True, False, True),
    ([(1, 5.1)], True, False, True),
    ([(1, None)], False, True, True),
    ([(None, 1.0)], False, True, True),
    ([(None, 1.0), (None, 2.0)], False, True, False),
    ([(1, 1.0), (1, 2.0)], True, True, False),
    ([], True, True, True)])
def test_rules(spark, rows, nulls, ranged, unique):
    verdict, checks = quality.check_rules(spark.createDataFrame(rows, RATED))
    assert checks == {"null_check": nulls, "rating_range": ranged, "unique_movies": unique}
    assert verdict == all(checks.values())


def test_profile_reads_the_table_once(spark, new_path):
    table = spark.createDataFrame([(1, "a"), (1, None), (None, None)], "k int, v string")
    table.write.parquet(new_path)
    profile = quality.table_profile(spark.read.parquet(new_path), ("k",))
    assert values(profile, "column_name", "row_count", "null_count", "distinct_count", "duplicates") == [
        ("k", 3, 1, 2, 1), ("v", 3, 2, None, None)]
    assert plan_of(profile).count("FileScan") == 1


def test_validation(spark, caplog):
    table = spark.createDataFrame([(1, None), (1, 2)], "k int, v int")
    with caplog.at_level(logging.WARNING):
        assert quality.validate_table(table, "t", ["k"], unique_columns=["k"])
    assert "column k has 1 duplicate" in caplog.text and "column v has 1 null" in caplog.text
    with pytest.raises(ValueError, match="t: 0 rows, at least 1"):
        quality.validate_table(table.where("false"), "t", ["k"])
    with pytest.raises(ValueError, match="t: 2 rows, at least 3"):
        quality.validate_table(table, "t", ["nowhere"], min_rows=3)
    with pytest.raises(ValueError, match="t: no columns \\['nowhere'\\]"):
        quality.validate_table(table, "t", ["k", "nowhere"])
    assert quality.validate_table(table.where("false"), "t", ["k"], min_rows=0)


def test_run_metrics(spark, new_path):
    start = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("a", start, start + dt.timedelta(seconds=90, milliseconds=250), "failed", "boom")],
        "task_id string, start_time timestamp, end_time timestamp, status string, error string")
    metrics = quality.run_metrics(runs)
    assert values(metrics, "task_id", "duration", "status", "error") == [("a", 90.25, "failed", "boom")]
    bare = quality.run_metrics(runs.drop("status", "error"))
    assert values(bare, "status", "error") == [("success", None)]
    results.append_run_metrics(metrics, new_path)
    results.append_run_metrics(bare, new_path)
    assert results.read_run_metrics(spark, new_path).count() == 2


NAN = float("nan")


@pytest.mark.parametrize("rows, nulls, ranged, unique", [
    ([(1, NAN)], False, True, True),
    ([(1, NAN), (2, 6.0)], False, False, True),
    ([(1, 1.0), (2, NAN), (2, 2.0)], False, True, False)])
def test_nan_is_missing(spark, rows, nulls, ranged, unique):
    _, checks = quality.check_rules(spark.createDataFrame(rows, RATED))
    assert checks == {"null_check": nulls, "rating_range": ranged, "unique_movies": unique}


MIXED = "a int, b double, `c.d` string, e binary, f array<int>, g timestamp"


def mixed_rows():
    day = dt.datetime(2024, 1, 1)
    return [(1, 0.0, "x", b"a", [1], day), (1, -0.0, "x", b"\xff", [1], day), (2, NAN, "", b"a", [2, 1], None),
            (None, NAN, None, None, None, day), (None, None, "", b"", [], day + dt.timedelta(seconds=1))]


@pytest.mark.parametrize("unique", [("a",), ("a", "b"), ("a", "b", "c.d", "e", "f", "g")])
def test_profiles_of_any_number_of_columns_agree(spark, unique):
    table = spark.createDataFrame(mixed_rows(), MIXED)
    wanted = {"a": (5, 2, 3, 2), "b": (5, 3, 2, 3), "c.d": (5, 1, 3, 2), "e": (5, 1, 4, 1), "f": (5, 1, 4, 1),
              "g": (5, 1, 3, 2)}
    for profile in (quality.table_profile(table, unique), quality.profile_by_pairs(table, unique)):
        got = {row.column_name: tuple(row)[1:] for row in profile.collect()}
        assert got == {name: line if name in unique else (*line[:2], None, None) for name, line in wanted.items()}
    nothing = quality.table_profile(table.where("false"), unique).collect()
    assert {tuple(row)[1:3] for row in nothing} == {(0, 0)} and len(nothing) == 6


def test_many_unique_columns_need_no_expand(spark, new_path):
    names = [f"c{k}" for k in range(50)]
    spark.range(40).select(*[(F.col("id") % (k + 1)).alias(name) for k, name in enumerate(names)]).write.parquet(new_path)
    profile = quality.table_profile(spark.read.parquet(new_path), names)
    plan = plan_of(profile)
    assert "Expand" not in plan and plan.count("FileScan") == 1
    assert dict(values(profile, "column_name", "distinct_count")) == {
        name: min(k + 1, 40) for k, name in enumerate(names)}


def test_unknown_columns_raise(spark):
    table = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="no columns \\['kk'\\]"):
        quality.table_profile(table, ["kk"])
    with pytest.raises(ValueError, match="kk"):
        quality.validate_table(table, "t", ["k"], unique_columns=["k", "kk"])


def test_runs_are_recorded_whether_they_succeed_or_fail(spark, new_path):
    table = spark.range(30).withColumn("half", F.col("id") / 2)

    def record(row):
        results.append_run_metrics(row, f"{new_path}/runs")

    run = quality.recorded_run("good", table, lambda t: t.write.parquet(f"{new_path}/out"), record)
    assert (run.status, run.rows, run.error) == ("success", 30, None)
    broken = table.withColumn("bad", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        quality.recorded_run("bad", broken, lambda t: t.write.parquet(f"{new_path}/bad"), record)
    runs = {row.task_id: row for row in results.read_run_metrics(spark, f"{new_path}/runs").collect()}
    assert runs["good"].rows == 30 and runs["good"].duration > 0 and runs["good"].error is None
    assert runs["bad"].status == "failed" and "boom" in runs["bad"].error and runs["bad"].rows is None
    assert runs["good"].end_time <= runs["bad"].start_time
