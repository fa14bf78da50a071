"""Sums over the users who rated both items of a pair, for all pairs at once.

Two plans give the same sums. They differ in the ratings that are not ``listed``, which never
make a pair of items a candidate and are only added to candidates (``tiles``).

* ``pairs`` lists all users but the ``common - 1`` busiest ones above ``busy_degree``.
* ``prefix`` asks which pairs can reach ``common`` users at all. Take all users in one order,
  those with few ratings first. If two items share ``common`` users, then at least one of
  these is not among the ``common - 1`` last raters of either item. So all ratings are listed
  but the ``common - 1`` busiest raters of each item; pairs that meet in none of these lists
  are out.

In both, the lists are cut into blocks on both sides by groups of items, and each pair of
groups is a tile of its own. ``listed_pairs`` and ``candidate_pairs`` give single pairs as
rows: their results grow with the pairs, so the sums do not use them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.correlation import PairSums
from tallyloom.operators.tiles import ALL_SUMS, summed
from tallyloom.settings import written_table

PLANS = ("auto", "pairs", "prefix")
# Below this share of ratings that prefixes keep, both plans are weighed by their work.
WORTH_WEIGHING = 0.9
# How many units of the full size a task should work on.
UNITS_PER_TASK = 4


def pair_sums() -> PairSums:
    c = F.col
    return PairSums(
        n=c("n"), x=c("x"), y=c("y"), xx=c("xx"), yy=c("yy"), xy=c("xy"),
        x_varies=c("max_x") > c("min_x"), y_varies=c("max_y") > c("min_y"))


def count_pairs(lists: DataFrame) -> int:
    """How many pairs the lists of all users hold together."""
    degree = F.count("*")
    pairs = lists.groupBy("user_id").agg((degree * (degree - 1) / 2).alias("pairs"))
    return int(pairs.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("pairs")).first()["pairs"])


def block_units(lists: DataFrame, busy_degree: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the units: (user_id, p, q) with the items of block p on the left and
    those of block q on the right, ``p <= q``. A list of up to ``busy_degree`` items is one
    block; others are cut into blocks of about half of that, as hashes do not deal evenly."""
    busy = written_table(
        lists.groupBy("user_id").agg(F.count("*").alias("degree"))
        .where(F.col("degree") > busy_degree)
        .select("user_id", F.ceil(2 * F.col("degree") / busy_degree).cast("int").alias("blocks")), "blocks")
    dealt = lists.join(busy, "user_id", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("item_id"), F.col("blocks")).cast("int")
    left = dealt.select(
        "user_id", F.col("item_id").alias("i"), F.col("rating").alias("of_i"), block.alias("p"),
        F.explode(F.sequence(block, F.col("blocks") - 1)).alias("q"))
    right = dealt.select(
        "user_id", F.col("item_id").alias("j"), F.col("rating").alias("of_j"), block.alias("q"),
        F.explode(F.sequence(F.lit(0), block)).alias("p"))
    return left, right


def listed_pairs(lists: DataFrame, busy_degree: int) -> DataFrame:
    """All pairs of items of each user: item_a, item_b, x, y with ``item_a < item_b``.

    Units are dealt to tasks by hash. There are as many tasks as the number of pairs asks
    for, if that is more than the session's.
    """
    left, right = block_units(lists, busy_degree)
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    needed = count_pairs(lists) // (UNITS_PER_TASK * busy_degree ** 2) + 1
    unit = ["user_id", "p", "q"]
    if needed > parts:
        left, right = left.repartition(needed, *unit), right.repartition(needed, *unit)
    c = F.col
    # The join is spread by key however small its inputs are: the work grows with the pairs.
    met = left.hint("merge").join(right, unit).where((c("p") < c("q")) | (c("i") < c("j")))
    ordered = c("i") < c("j")
    return met.select(
        F.least("i", "j").alias("item_a"), F.greatest("i", "j").alias("item_b"),
        F.when(ordered, c("of_i")).otherwise(c("of_j")).alias("x"),
        F.when(ordered, c("of_j")).otherwise(c("of_i")).alias("y"))


# --- the plan without a filter -----------------------------------------------------

def marked_by_user(rated: DataFrame, common: int, busy_degree: int) -> DataFrame:
    """The ratings, ``listed`` but for those of the busiest ``common - 1`` users (of those
    above ``busy_degree``): together they fall short of ``common``, so each result pair is
    also listed by some other user."""
    busiest = written_table(
        rated.groupBy("user_id").agg(F.count("*").alias("degree"))
        .where(F.col("degree") > busy_degree)
        .orderBy(F.desc("degree"), "user_id").limit(common - 1).select("user_id", F.lit(True).alias("of_busiest")),
        "busiest")
    return rated.join(busiest, "user_id", "left").select(
        "user_id", "item_id", "rating", F.col("of_busiest").isNull().alias("listed"))


# --- the plan with the prefix filter -----------------------------------------------

def busiest_raters(rated: DataFrame, common: int) -> DataFrame:
    """(item_id, user_id) of the ``common - 1`` busiest raters of each item.

    Tasks pass on at most ``common - 1`` rows per item to find those, so an item that holds
    a third of all ratings is no burden.
    """
    degrees = written_table(rated.groupBy("user_id").agg(F.count("*").alias("degree")), "degrees")
    last = Window.partitionBy("item_id").orderBy(F.desc("degree"), F.desc("user_id"))
    return (rated.select("item_id", "user_id").join(degrees, "user_id")
            .withColumn("place", F.row_number().over(last)).where(F.col("place") < common)
            .select("item_id", "user_id"))


def prefix_lists(rated: DataFrame, common: int) -> DataFrame:
    """The ratings without the ``common - 1`` busiest raters of each item. An item with
    fewer raters than ``common`` keeps none."""
    if common == 1:
        return rated
    return rated.join(busiest_raters(rated, common), ["item_id", "user_id"], "left_anti")


def marked_by_prefix(rated: DataFrame, common: int) -> DataFrame:
    """The ratings, ``listed`` if they are in the prefix of their item."""
    if common == 1:
        return rated.select("user_id", "item_id", "rating", F.lit(True).alias("listed"))
    busiest = busiest_raters(rated, common).withColumn("of_busiest", F.lit(True))
    return rated.join(busiest, ["item_id", "user_id"], "left").select(
        "user_id", "item_id", "rating", F.col("of_busiest").isNull().alias("listed"))


def candidate_pairs(rated: DataFrame, common: int, busy_degree: int) -> DataFrame:
    """Pairs (item_a < item_b) that meet in a prefix: all pairs with ``common`` common
    users, and few others."""
    return listed_pairs(prefix_lists(rated, common), busy_degree).select("item_a", "item_b").distinct()


def cheaper_plan(rated: DataFrame, raters: DataFrame, common: int) -> str:
    """The plan with less work, by the number of pairs it lists and the ratings it goes
    through for the sums. Where prefixes keep nearly all ratings, there is nothing to weigh."""
    size = raters.agg(F.count("*").alias("items"), F.coalesce(F.sum("raters"), F.lit(0)).alias("rows")).first()
    if size["rows"] * (1 - WORTH_WEIGHING) > size["items"] * (common - 1):
        return "pairs"
    mean = size["rows"] / max(size["items"], 1)
    with_prefix = count_pairs(prefix_lists(rated, common)) * (1 + mean)
    return "prefix" if with_prefix < count_pairs(rated) else "pairs"


def sums_of_pairs(rated: DataFrame, common: int, busy_degree: int, plan: str = "auto",
                  names: tuple[str, ...] = ALL_SUMS) -> DataFrame:
    """The named sums of all pairs of items with ``common`` common users. ``rated`` has one
    row per (user_id, item_id) and no NULL."""
    if plan not in PLANS:
        raise ValueError(f"unknown plan {plan!r}, expected one of {PLANS}")
    raters = written_table(
        rated.groupBy("item_id").agg(F.count("*").alias("raters"))
        .where(F.col("raters") >= common), "raters")
    kept = written_table(rated.join(raters.select("item_id"), "item_id", "left_semi"), "kept")
    if plan == "auto":
        plan = cheaper_plan(kept, raters, common)
    marked = marked_by_user(kept, common, busy_degree) if plan == "pairs" else marked_by_prefix(kept, common)
    return summed(marked, common, busy_degree, names)
