"""Ratings reports: age by occupation, top-rated items, genres by demographic.

No join carries a broadcast hint. Spark compares the size of each side with
``spark.sql.autoBroadcastJoinThreshold``, before and during the run, and shuffles (with
adaptive skew splitting) what is larger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.ages import age_group


def mean_age_by_occupation(users: DataFrame) -> DataFrame:
    """Mean age per occupation, in order of occupation. Users without an age count in no
    mean; users without an occupation form a group."""
    return (users.groupBy("occupation").agg(F.avg("age").alias("mean_age"))
            .orderBy("occupation"))


def item_rating_stats(ratings: DataFrame) -> DataFrame:
    """Number of ratings and mean rating of every rated item."""
    return ratings.groupBy("item_id").agg(
        F.count("*").alias("rating_count"), F.avg("rating").alias("avg_rating"))


def top_rated_items(
    ratings: DataFrame, items: DataFrame, min_ratings: int = 35, top_n: int = 20
) -> DataFrame:
    """The ``top_n`` best rated items with at least ``min_ratings`` ratings.

    Ratings are reduced to one row per item before the titles are joined. Equal means
    are ordered by count, then by item.
    """
    rated_often = item_rating_stats(ratings).where(F.col("rating_count") >= min_ratings)
    return (
        rated_often
        .join(items.select(F.col("movie_id").alias("item_id"), "title"), "item_id")
        .orderBy(F.desc("avg_rating"), F.desc("rating_count"), "item_id", "title")
        .limit(top_n)
        .select("title", "avg_rating", "rating_count")
    )


def with_age_group(users: DataFrame, under_20: str | None = None) -> DataFrame:
    """Users of known age with their ``age_group``."""
    return users.where(F.col("age").isNotNull()).withColumn(
        "age_group", age_group(F.col("age"), under_20))


def item_genres(items: DataFrame) -> DataFrame:
    """One row per item and genre whose flag is set."""
    flagged = [F.when(F.col(name) == 1, F.lit(name)) for name in schemas.genre_columns(items)]
    return items.select(
        "movie_id", F.explode(F.array_compact(F.array(*flagged))).alias("genre"))


def genre_stats(
    ratings: DataFrame, items: DataFrame, users: DataFrame, under_20: str | None = None
) -> DataFrame:
    """Mean and number of ratings per occupation, age group and genre; a rating counts
    once for every genre of its item.

    Ratings are summed per item and user group first, so that the genre fan-out and the
    second join work on sums instead of single ratings.
    """
    groups = with_age_group(users, under_20).select("user_id", "occupation", "age_group")
    by_item = (
        ratings.select("user_id", "item_id", "rating").join(groups, "user_id")
        .groupBy("item_id", "occupation", "age_group")
        .agg(F.sum("rating").alias("total"), F.count("rating").alias("rated"),
             F.count("*").alias("lines"))
    )
    genres = item_genres(items).withColumnRenamed("movie_id", "item_id")
    return (
        by_item.join(genres, "item_id")
        .groupBy("occupation", "age_group", "genre")
        .agg(F.try_divide(F.sum("total"), F.sum("rated")).alias("avg_rating"),
             F.sum("lines").alias("rating_count"))
    )


def genre_ranking(
    ratings: DataFrame, items: DataFrame, users: DataFrame,
    top_k: int = 1, under_20: str | None = None,
) -> DataFrame:
    """The ``top_k`` genres of every occupation and age group, by mean rating, then by
    number of ratings, then by name. A group has at most one row per genre column."""
    best_first = Window.partitionBy("occupation", "age_group").orderBy(
        F.desc("avg_rating"), F.desc("rating_count"), "genre")
    return (
        genre_stats(ratings, items, users, under_20)
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= top_k)
        .orderBy("occupation", "age_group", "rank")
    )
