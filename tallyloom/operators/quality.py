"""Data checks and run metrics, each from one aggregation over the table."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)


FLOATING = (T.FloatType, T.DoubleType)
# How many groups the values of a column are counted in before their numbers are added up.
SALTS = 64


def is_missing(table: DataFrame, name: str) -> Column:
    """NULL, or in a column of floating numbers no number."""
    column = F.col(quoted(name))
    floating = isinstance(table.schema[name].dataType, FLOATING)
    return column.isNull() | F.isnan(column) if floating else column.isNull()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def distinct_values(table: DataFrame, name: str) -> Column:
    """Number of different values, a missing one being one of them."""
    missing = is_missing(table, name)
    return F.count_distinct(F.when(~missing, F.col(quoted(name)))) + F.coalesce(
        F.max(missing.cast("int")), F.lit(0))


def rule_checks(rated_items: DataFrame) -> DataFrame:
    """One row of booleans: nothing missing in any column, every rating within 0 and 5,
    every ``movie_id`` once, and all three together. NaN is missing, and so within no
    range."""
    any_missing = reduce(or_, (is_missing(rated_items, name) for name in rated_items.columns))
    rating = F.col("rating")
    outside = ~is_missing(rated_items, "rating") & ((rating < 0) | (rating > 5))
    checks = rated_items.agg(
        (F.count_if(any_missing) == 0).alias("null_check"),
        (F.count_if(outside) == 0).alias("rating_range"),
        (distinct_values(rated_items, "movie_id") == F.count("*")).alias("unique_movies"))
    return checks.select(
        (F.col("null_check") & F.col("rating_range") & F.col("unique_movies")).alias("all_ok"),
        "*")


def check_rules(rated_items: DataFrame) -> tuple[bool, dict[str, bool]]:
    """The verdict and the single checks as values."""
    checks = rule_checks(rated_items).first().asDict()
    return checks.pop("all_ok"), checks


def table_profile(table: DataFrame, unique_columns: Sequence[str] = ()) -> DataFrame:
    """One row per column: rows, missing values, and for columns that should be unique the
    number of different values and of surplus rows. The table is read once.

    Several distinct counts in one aggregation would make Spark copy each row once per
    column and shuffle the copies. So beyond one such column, values are counted as
    (column, value) pairs, which tasks add up before they shuffle; the pairs are then
    counted in two steps, so that no column is counted in one task. Both ways give the
    same rows.
    """
    unknown = [name for name in unique_columns if name not in table.columns]
    if unknown:
        raise ValueError(f"no columns {unknown}")
    return profile_by_pairs(table, unique_columns) if len(set(unique_columns)) > 1 else profile_at_once(
        table, unique_columns)


def profile_at_once(table: DataFrame, unique_columns: Sequence[str]) -> DataFrame:
    counted = [F.count("*").alias("rows")]
    for position, name in enumerate(table.columns):
        counted.append(F.count_if(is_missing(table, name)).alias(f"nulls_{position}"))
        if name in unique_columns:
            counted.append(distinct_values(table, name).alias(f"distinct_{position}"))
    lines = []
    for position, name in enumerate(table.columns):
        different = (F.col(f"distinct_{position}") if name in unique_columns
                     else F.lit(None).cast("bigint"))
        lines.append(F.struct(
            F.lit(name).alias("column_name"), F.col("rows").alias("row_count"),
            F.col(f"nulls_{position}").alias("null_count"),
            different.alias("distinct_count"),
            (F.col("rows") - different).alias("duplicates")))
    return table.agg(*counted).select(F.inline(F.array(*lines)))


def value_as_text(table: DataFrame, name: str) -> Column:
    """Equal values have equal texts: both zeros are one."""
    column, kind = F.col(quoted(name)), table.schema[name].dataType
    if isinstance(kind, FLOATING):
        return (column + F.lit(0.0).cast(kind)).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    return column.cast("string") if isinstance(kind, T.AtomicType) else F.to_json(F.struct(column))


def profile_by_pairs(table: DataFrame, unique_columns: Sequence[str]) -> DataFrame:
    pairs = []
    for position, name in enumerate(table.columns):
        missing = is_missing(table, name)
        value = value_as_text(table, name) if name in unique_columns else F.lit("")
        pairs.append(F.struct(
            F.lit(position).alias("position"), missing.alias("missing"), F.when(~missing, value).alias("value")))
    c = F.col
    values = table.select(F.inline(F.array(*pairs))).groupBy("position", "missing", "value").agg(
        F.count("*").alias("rows"))
    counts = [F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("values").alias("values")]
    salted = (values.groupBy("position", F.pmod(F.xxhash64("value"), F.lit(SALTS)).alias("salt")).agg(
        F.sum("rows").alias("rows"), F.sum(F.when(c("missing"), c("rows")).otherwise(0)).alias("nulls"),
        F.count("*").alias("values")).groupBy("position").agg(*counts))
    columns = table.sparkSession.createDataFrame(
        [(position, name, name in unique_columns) for position, name in enumerate(table.columns)],
        "position int, column_name string, is_unique boolean")
    rows, different = F.coalesce("rows", F.lit(0)), F.when(c("is_unique"), F.coalesce("values", F.lit(0)))
    return columns.join(salted, "position", "left").select(
        "column_name", rows.alias("row_count"), F.coalesce("nulls", F.lit(0)).alias("null_count"),
        different.alias("distinct_count"), (rows - different).alias("duplicates"))


def validate_table(
    table: DataFrame, name: str, required_columns: Sequence[str], min_rows: int = 1,
    unique_columns: Sequence[str] | None = None,
) -> bool:
    """Raise ``ValueError`` for too few rows, missing columns and unknown ``unique_columns``;
    log duplicates in columns that should be unique and missing values in any column. Runs
    one job."""
    missing = [column for column in required_columns if column not in table.columns]
    profile = table_profile(table, unique_columns or ()).collect()  # one row per column
    rows = profile[0]["row_count"] if profile else table.count()
    if rows < min_rows:
        raise ValueError(f"{name}: {rows} rows, at least {min_rows} expected")
    if missing:
        raise ValueError(f"{name}: no columns {missing}")
    for line in profile:
        if line["duplicates"]:
            logger.warning("%s: column %s has %d duplicate values",
                           name, line["column_name"], line["duplicates"])
        if line["null_count"]:
            logger.warning("%s: column %s has %d null values",
                           name, line["column_name"], line["null_count"])
    return True


def run_metrics(runs: DataFrame) -> DataFrame:
    """Runs with their duration in seconds. ``status``, ``error`` and ``rows`` are kept
    where given."""
    given = set(runs.columns)
    micros = F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(
        F.col("start_time").cast("timestamp"))
    status = F.col("status") if "status" in given else F.lit("success")
    error = F.col("error") if "error" in given else F.lit(None).cast("string")
    return runs.select(
        "task_id", "start_time", "end_time", (micros / F.lit(1e6)).alias("duration"),
        status.alias("status"), error.alias("error"), *(["rows"] if "rows" in given else []))


@dataclass
class RunRecord:
    """What is known of a run once it is over; one row of the table of runs."""

    task_id: str
    start_time: dt.datetime
    end_time: dt.datetime
    status: str
    error: str | None
    rows: int | None


def recorded_run(
    task_id: str, table: DataFrame, write: Callable[[DataFrame], None],
    record: Callable[[DataFrame], None],
) -> RunRecord:
    """Runs ``write`` on a table and hands one row of metrics to ``record``, whether it
    succeeds or fails; an error goes on to the caller. The rows are counted by the job that
    writes them, not by another one."""
    spark, counted = table.sparkSession, Observation(f"rows of {task_id}")
    start, status, error, rows = now(), "success", None, None
    try:
        write(table.observe(counted, F.count(F.lit(1)).alias("rows")))
        rows = counted.get["rows"]
    except Exception as problem:
        status, error = "failed", f"{type(problem).__name__}: {problem}"[:2000]
        raise
    finally:
        run = RunRecord(task_id, start, now(), status, error, rows)
        record(run_metrics(spark.createDataFrame(
            [tuple(asdict(run).values())],
            "task_id string, start_time timestamp, end_time timestamp, status string, error string, rows long")))
    return run


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)
