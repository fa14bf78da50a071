"""The table of sentiment scores: appended by run, paged by an index of its files.

Rows lie in one folder per ``run_date``, sorted by their page order (newest run first,
then id) and dealt to files by ranges of it, ROWS_PER_FILE at most. For each file the index
holds its number of rows and its first and last row in page order. A page asks the index
which files it needs, so an offset costs the same at any depth, and paging by the last row
seen does not count at all.

A store is written by one writer at a time. If a run fails, writing it again with
``replace_run`` puts data and index of that day right.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import schemas
from tallyloom.functions.dates import timestamp_literal
from tallyloom.operators.ordering import numbered

ROWS_PER_FILE = 1_000_000
ID_DIGITS = 12
INDEX = "_index"
INDEX_SCHEMA = ("file string, rows long, first_newest long, first_id string, last_newest long,"
                " last_id string, run_date date")
PAGE_COLUMNS = ("source", "ticker", "title", "sentiment_score", "created_at")


def utc(moment: dt.datetime) -> dt.datetime:
    """Moments without a zone are meant in UTC."""
    return moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment.astimezone(dt.timezone.utc)


def micros(moment: dt.datetime) -> int:
    return (utc(moment) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def stored_sentiment(scored: DataFrame, run_at: dt.datetime, start: int = 1) -> DataFrame:
    """Scored articles in the layout of the stored table, plus the partition column.

    The id is the moment of the run and a number without gaps in the order of source,
    ticker, title, score and, where the articles carry one, url. It is the same whenever the
    same articles are stored for the same run, and no two rows share one, however much they
    are alike.
    """
    tie = [F.asc("url")] if "url" in scored.columns else []
    order = [F.asc("source"), F.asc("ticker"), F.asc("title"), F.asc("sentiment_score"), *tie]
    created = timestamp_literal(run_at)
    run = f"{utc(run_at):%Y%m%dT%H%M%S.%fZ}-"
    rows = numbered(scored, order, "number", start, "scores")
    key = F.concat(F.lit(run), F.lpad(F.col("number").cast("string"), ID_DIGITS, "0"))
    return rows.select(
        key.alias("id"), "source", "ticker", "title",
        F.col("sentiment_score").cast("double").alias("sentiment_score"),
        created.alias("created_at"), F.to_date(created).alias("run_date"))


def store_sentiment(
    scored: DataFrame, path: str, run_at: dt.datetime, replace_run: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Append the scores of a run. With ``replace_run`` they take the place of whatever
    that day already holds, so a retry does not store rows twice (a run without articles
    replaces nothing); otherwise a run stored twice gets ids that go on after those of the
    first time."""
    spark = scored.sparkSession
    run_date = utc(run_at).date()
    before = 0 if replace_run else rows_of_run(spark, path, run_at)
    rows = stored_sentiment(scored, run_at, before + 1)
    (rows.repartitionByRange("id").sortWithinPartitions("run_date", "id")
     .write.partitionBy("run_date").option("maxRecordsPerFile", rows_per_file)
     .mode("overwrite" if replace_run else "append").option("partitionOverwriteMode", "dynamic")
     .parquet(path))
    write_index(spark, path, run_date)


# --- the index ---------------------------------------------------------------------

def page_key() -> list[Column]:
    return [(-F.unix_micros("created_at")).alias("newest"), F.col("id")]


def write_index(spark: SparkSession, path: str, run_date: dt.date) -> None:
    """Index the files of one day anew; the scan reads two columns of that day."""
    day = found(spark, f"{path}/run_date={run_date}", schemas.STORED_SENTIMENT)
    if not day.inputFiles():
        return  # a first run without articles
    key = F.struct(*page_key())
    index = (day.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
        .select("file", "rows", F.col("first.newest").alias("first_newest"), F.col("first.id").alias("first_id"),
                F.col("last.newest").alias("last_newest"), F.col("last.id").alias("last_id"),
                F.lit(run_date).alias("run_date")))
    (index.write.partitionBy("run_date").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{INDEX}"))


def found(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table, empty where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return found(spark, f"{path}/{INDEX}", INDEX_SCHEMA)


def rows_of_run(spark: SparkSession, path: str, run_at: dt.datetime) -> int:
    """How many rows the store holds of a run, by the index; a file holds rows of one."""
    newest = -micros(run_at)
    day = read_index(spark, path).where(F.col("run_date") == F.lit(utc(run_at).date()))
    return day.where(F.col("first_newest") == newest).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]


def clusters(files: DataFrame) -> DataFrame:
    """Files with the rows that come before them on their day. Files whose ranges overlap,
    as those of one run stored twice do not, but those of equal moments may, count as one."""
    first = F.struct(F.col("first_newest").alias("newest"), F.col("first_id").alias("id"))
    last = F.struct(F.col("last_newest").alias("newest"), F.col("last_id").alias("id"))
    in_order = Window.partitionBy("run_date").orderBy("first_newest", "first_id", "file")
    reached = F.max(last).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (first > reached), 1).otherwise(0)
    marked = files.withColumn("opens", opens).withColumn("cluster", F.sum("opens").over(in_order))
    whole = Window.partitionBy("run_date", "cluster")
    by_cluster = Window.partitionBy("run_date").orderBy("cluster")
    return (marked.withColumn("cluster_rows", F.sum("rows").over(whole))
            .withColumn("before", F.sum("rows").over(by_cluster) - F.col("cluster_rows")))


@dataclass(frozen=True)
class Pages:
    """Files that hold a page, and how many of their rows come before it."""

    files: list[str]
    skip: int


def files_of_page(spark: SparkSession, path: str, limit: int, offset: int) -> Pages:
    """Days are counted on the driver, one number each; files inside of Spark."""
    index, wanted, passed = read_index(spark, path), [], 0
    days = index.groupBy("run_date").agg(F.sum("rows").alias("rows")).orderBy(F.desc("run_date")).collect()
    for day in days:
        if passed < offset + limit and passed + day["rows"] > offset:
            wanted.append((day["run_date"], passed, max(offset - passed, 0), offset + limit - passed))
        passed += day["rows"]
    if not wanted:
        return Pages([], 0)
    parts = spark.createDataFrame(wanted, "run_date date, passed long, low long, high long")
    chosen = index.where(F.col("run_date").between(wanted[-1][0], wanted[0][0]))
    found = (clusters(chosen).join(parts, "run_date")
             .where((F.col("before") < F.col("high")) & (F.col("before") + F.col("cluster_rows") > F.col("low")))
             .select("run_date", "file", (F.col("passed") + F.col("before")).alias("earlier")).collect())
    return Pages(sorted(f"{path}/run_date={row['run_date']}/{row['file']}" for row in found),
                 offset - min(row["earlier"] for row in found))


def files_after(spark: SparkSession, path: str, created_at: dt.datetime, row_id: str, limit: int) -> list[str]:
    """Files that hold the ``limit`` rows after a row in page order."""
    newest = -micros(created_at)
    key = F.struct(F.lit(newest).cast("long").alias("newest"), F.lit(row_id).alias("id"))
    last = F.struct(F.col("last_newest").alias("newest"), F.col("last_id").alias("id"))
    first = F.struct(F.col("first_newest").alias("newest"), F.col("first_id").alias("id"))
    index = read_index(spark, path).where(F.col("run_date") <= F.lit(utc(created_at).date()))
    rest = index.where(last > key).withColumn("rows", F.when(first > key, F.col("rows")).otherwise(0))
    wanted, passed = [], 0
    for day in rest.groupBy("run_date").agg(F.sum("rows").alias("rows")).orderBy(F.desc("run_date")).collect():
        if passed < limit:
            wanted.append((day["run_date"], limit - passed))
        passed += day["rows"]
    if not wanted:
        return []
    parts = spark.createDataFrame(wanted, "run_date date, missing long")
    found = (clusters(rest.where(F.col("run_date").between(wanted[-1][0], wanted[0][0]))).join(parts, "run_date")
             .where(F.col("before") < F.col("missing")).select("run_date", "file").collect())
    return sorted(f"{path}/run_date={row['run_date']}/{row['file']}" for row in found)


# --- reading -----------------------------------------------------------------------

def read_sentiment(
    spark: SparkSession, path: str, first_date: dt.date | None = None, last_date: dt.date | None = None,
    with_run_date: bool = False,
) -> DataFrame:
    """The stored scores, of some run dates if given: folders of other dates are not read.
    The partition column stays out of the result unless asked for."""
    names = schemas.STORED_SENTIMENT.fieldNames()
    stored = spark.read.schema(schemas.layout(
        **{field.name: field.dataType for field in schemas.STORED_SENTIMENT}, run_date=schemas.DATE)).parquet(path)
    if first_date is not None:
        stored = stored.where(F.col("run_date") >= F.lit(first_date))
    if last_date is not None:
        stored = stored.where(F.col("run_date") <= F.lit(last_date))
    return stored.select(*names, *(["run_date"] if with_run_date else []))


def read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schemas.STORED_SENTIMENT)
    return spark.read.schema(schemas.STORED_SENTIMENT).parquet(*files)


def stored_page(spark: SparkSession, path: str, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of the stored scores, newest first, then by id, from the files that hold it."""
    page = files_of_page(spark, path, limit, offset)
    return (read_files(spark, page.files).orderBy(F.desc("created_at"), "id")
            .offset(page.skip).limit(limit).select("id", *PAGE_COLUMNS))


def page_after(
    spark: SparkSession, path: str, created_at: dt.datetime, row_id: str, limit: int = 100
) -> DataFrame:
    """The page that follows a row in the same order; the row need not exist any more."""
    created = timestamp_literal(created_at)
    after = (F.col("created_at") < created) | ((F.col("created_at") == created) & (F.col("id") > row_id))
    return (read_files(spark, files_after(spark, path, created_at, row_id, limit)).where(after)
            .orderBy(F.desc("created_at"), "id").limit(limit).select("id", *PAGE_COLUMNS))
