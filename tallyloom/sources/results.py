"""Result tables: sentiment scores, run metrics, and the bundle of the four reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.sources.store import read_sentiment, store_sentiment, stored_sentiment

__all__ = ["read_sentiment", "store_sentiment", "stored_sentiment", "sentiment_page",
           "append_run_metrics", "read_run_metrics", "write_jdbc", "read_jdbc", "write_bundle"]


def sentiment_page(stored: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of any table of scores, newest first, then by id. Pages of a store come from
    its index (``store.stored_page``), which does not sort what lies before them."""
    return (
        stored.orderBy(F.desc("created_at"), "id").offset(offset).limit(limit)
        .select("source", "ticker", "title", "sentiment_score", "created_at"))


def append_run_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_METRICS).parquet(path)


def write_jdbc(table: DataFrame, url: str, name: str, properties: dict[str, str]) -> None:
    """Append to a database table, for deployments that carry a driver. Each task inserts
    in batches in its own transaction."""
    table.write.jdbc(url, name, mode="append", properties=properties)


def read_jdbc(spark: SparkSession, url: str, name: str, properties: dict[str, str]) -> DataFrame:
    """A database table as a source, for example the stored scores."""
    return spark.read.jdbc(url, name, properties=properties)


def write_bundle(bundle: DataFrame, path: str) -> None:
    """Write a one-row document as text."""
    bundle.select("document").write.mode("overwrite").text(path)
