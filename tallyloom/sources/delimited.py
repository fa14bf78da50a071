"""The three header-less delimited files. A cell that does not fit its type reads as NULL,
and so do the missing cells of a short row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom import schemas

# Column separators.
RATINGS_SEPARATOR = "\t"
DIMENSION_SEPARATOR = "|"


def read_delimited(
    spark: SparkSession, path: str, separator: str, schema: T.StructType,
    encoding: str = "UTF-8",
) -> DataFrame:
    return spark.read.csv(path, sep=separator, schema=schema, encoding=encoding)


def read_ratings(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    return read_delimited(spark, path, RATINGS_SEPARATOR, schemas.RATINGS, encoding)


def read_items(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    return read_delimited(spark, path, DIMENSION_SEPARATOR, schemas.ITEMS, encoding)


def read_users(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    return read_delimited(spark, path, DIMENSION_SEPARATOR, schemas.USERS, encoding)
