"""Item-to-item similarity over the users who rated both items.

Adaptive execution splits a hot key of a join only where both sides come straight from a
shuffle of that join. A side that was grouped by the join key itself would skip the
shuffle, so such sides are grouped by one more column or read back from a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.correlation import SUMS_OF, metric as metric_named
from tallyloom.operators.allpairs import pair_sums, sums_of_pairs
from tallyloom.settings import written_table


def search_titles(items: DataFrame, text: str, like: bool = False) -> DataFrame:
    """Items whose title contains the text in any case. With ``like``, ``%`` and ``_`` of
    the text are wildcards."""
    title = F.lower(F.col("title"))
    found = title.like(f"%{text.lower()}%") if like else title.contains(text.lower())
    return items.where(found).select("movie_id", "title")


def title_lookup(items: DataFrame, title: str) -> DataFrame:
    """The item of exactly this title, the smallest id if several share it."""
    return (items.where(F.col("title") == title)
            .groupBy("title").agg(F.min("movie_id").alias("movie_id"))
            .select("movie_id", "title"))


def find_item_id(items: DataFrame, title: str) -> int:
    """The id as a value: a literal item filter reaches the scan of the ratings."""
    found = title_lookup(items, title).first()
    if found is None:
        raise ValueError(f"no item is titled {title!r}")
    return found["movie_id"]


def one_rating_per_item(ratings: DataFrame) -> DataFrame:
    """Repeated ratings of an item by a user become their mean."""
    return ratings.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))


def paired_ratings(ratings: DataFrame, item_id: int) -> DataFrame:
    """Every rating of the target next to every rating of another item by that user."""
    target = ratings.where(F.col("item_id") == item_id).select(
        "user_id", F.col("rating").alias("target_rating"))
    other = ratings.where(F.col("item_id") != item_id).select(
        "user_id", F.col("item_id").alias("other_item_id"),
        F.col("rating").alias("other_rating"))
    return target.join(other, "user_id")


def pair_metrics(ratings: DataFrame, item_id: int, metric: str = "pearson") -> DataFrame:
    """Score and strength (number of rating pairs) of every item co-rated with the target.

    These are the figures of ``paired_ratings`` grouped by the other item, without
    building the pairs: the target's ratings are summed per user, and each rating of
    another item is weighted with those sums. The join thus gives at most one row per
    rating, however often a user repeats a rating.
    """
    score_of = metric_named(metric)
    x = F.col("rating").cast("double")
    target = ratings.where(F.col("item_id") == item_id).groupBy("user_id", "item_id").agg(
        F.count("*").alias("t_lines"), F.count(x).alias("t_n"), F.sum(x).alias("t_x"),
        F.sum(x * x).alias("t_xx"), F.min(x).alias("t_min"), F.max(x).alias("t_max")).drop("item_id")
    other = ratings.where(F.col("item_id") != item_id).select(
        "user_id", F.col("item_id").alias("other_item_id"), x.alias("y"))
    y = F.col("y")
    both = y.isNotNull() & (F.col("t_n") > 0)

    def over_pairs(aggregate, value: Column) -> Column:
        return aggregate(F.when(both, value))

    sums = other.join(target, "user_id").groupBy("other_item_id").agg(
        F.sum("t_lines").alias("strength"),
        over_pairs(F.sum, F.col("t_n")).alias("n"),
        over_pairs(F.sum, F.col("t_x")).alias("x"),
        over_pairs(F.sum, F.col("t_xx")).alias("xx"),
        over_pairs(F.sum, F.col("t_n") * y).alias("y"),
        over_pairs(F.sum, F.col("t_n") * y * y).alias("yy"),
        over_pairs(F.sum, F.col("t_x") * y).alias("xy"),
        over_pairs(F.min, F.col("t_min")).alias("min_x"),
        over_pairs(F.max, F.col("t_max")).alias("max_x"),
        over_pairs(F.min, y).alias("min_y"),
        over_pairs(F.max, y).alias("max_y"),
    )
    return sums.select("other_item_id", score_of(pair_sums()).alias("score"), "strength")


def similarity_stats(metrics: DataFrame) -> DataFrame:
    """One row about the distribution of scores and strengths."""
    return metrics.agg(
        F.coalesce(F.sum("strength"), F.lit(0)).alias("total_pairs"),
        F.count("*").alias("total_compared"),
        F.count("score").alias("valid_comparisons"),
        F.avg("score").alias("avg_similarity"),
        F.min("strength").alias("min_common_users"),
        F.max("strength").alias("max_common_users"))


def item_similarity(
    ratings: DataFrame, items: DataFrame, title: str | None = None, *,
    item_id: int | None = None, metric: str = "pearson", threshold: float = 0.5,
    min_common: int = 50, top_n: int = 10, digits: int = 16, dedupe: str | None = None,
) -> DataFrame:
    """The ``top_n`` items most similar to a target, given by title or by id.

    Repeated ratings multiply the pairs unless ``dedupe="avg"``. A missing score never
    passes the threshold. Equal scores are ordered by strength, then by item.
    """
    if (title is None) == (item_id is None):
        raise ValueError("give either a title or an item_id")
    if dedupe not in (None, "avg"):
        raise ValueError(f"dedupe is None or 'avg', not {dedupe!r}")
    if item_id is None:
        item_id = find_item_id(items, title)
    if dedupe == "avg":
        ratings = one_rating_per_item(ratings)
    similar = pair_metrics(ratings, item_id, metric).where(
        (F.col("strength") >= min_common) & (F.col("score") >= threshold))
    titles = items.select(F.col("movie_id").alias("other_item_id"), "title")
    return (
        similar.join(titles, "other_item_id")
        .select("other_item_id", "title", F.round("score", digits).alias("score"), "strength")
        .orderBy(F.desc("score"), F.desc("strength"), "other_item_id", "title")
        .limit(top_n)
        .select("title", "score", "strength")
    )


def all_pairs_similarity(
    ratings: DataFrame, *, metric: str = "cosine", threshold: float = 0.95,
    min_common: int = 50, top_n: int | None = None, digits: int = 16,
    busy_degree: int = 5000, plan: str = "auto",
) -> DataFrame:
    """Every pair of items (``item_a < item_b``) that at least ``min_common`` users rated
    and that scores at least ``threshold``. Repeated ratings count as their mean, rows
    without a rating do not count. A pair without a common user is never a result, so
    ``min_common=0`` is the same as 1.

    Work is kept in bounds without leaving out results: an item with fewer than
    ``min_common`` raters is in no result pair and is dropped; lists are cut into blocks by
    groups of items, more of them if lists have more than ``busy_degree`` items; pairs are
    summed where they are made; and where that is less work, pairs that cannot reach
    ``min_common`` are told before all of their ratings are summed (``allpairs``).
    ``plan="pairs"`` and ``plan="prefix"`` choose one of the two ways.

    The collapsed ratings and what is known of items and users are written to the scratch
    folder first, as the joins read them several times; the rest is lazy.
    """
    score_of, common = metric_named(metric), max(min_common, 1)
    rated = written_table(one_rating_per_item(ratings.where(
        F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
        & F.col("rating").isNotNull())), "rated")
    total = sums_of_pairs(rated, common, busy_degree, plan, SUMS_OF[metric])
    out = (
        total.where(F.col("n") >= common)
        .select("item_a", "item_b", score_of(pair_sums()).alias("exact"),
                F.col("n").alias("strength"))
        .where(F.col("exact") >= threshold)
        .select("item_a", "item_b", F.round("exact", digits).alias("score"), "strength")
    )
    if top_n is None:
        return out
    return out.orderBy(
        F.desc("score"), F.desc("strength"), "item_a", "item_b").limit(top_n)
