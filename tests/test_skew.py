"""One user, item or text holds a third of all rows, and nothing fits a broadcast."""

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom.operators import articles as art
from tallyloom.operators import ratings as reports
from tallyloom.operators import similarity as sim

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_limits(spark):
    before = {key: spark.conf.get(key) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def ratings(spark, new_path):
    """User 0 and item 0 hold a third of the rows each."""
    row = F.col("id")
    spark.range(0, 60000, 1, 8).select(
        F.when(row % 3 == 0, 0).otherwise(row % 997).alias("user_id"),
        F.when(row % 3 == 1, 0).otherwise(F.floor(row / 3) % 211).alias("item_id"),
        (1 + row % 5).cast("double").alias("rating")).write.parquet(new_path)
    return spark.read.parquet(new_path)


def test_similarity_splits_the_hot_user(spark, small_limits, ratings):
    metrics = sim.pair_metrics(ratings, 7)
    got = {r.other_item_id: r.strength for r in metrics.collect()}
    assert "SortMergeJoin(skew=true)" in plan_of(metrics)
    counted = spark.sql(
        "SELECT b.item_id, sum(a.n * b.n) AS strength FROM {c} a JOIN {c} b USING (user_id) "
        "WHERE a.item_id = 7 AND b.item_id <> 7 GROUP BY 1",
        c=ratings.groupBy("user_id", "item_id").agg(F.count("*").alias("n")))
    assert got == dict(values(counted, "item_id", "strength"))


def test_genre_stats_split_the_hot_user(spark, small_limits, ratings):
    users = spark.range(997).select(F.col("id").alias("user_id")).withColumns({
        "age": (F.col("user_id") % 60).cast("int"), "occupation": F.lit("x")})
    items = spark.range(211).select(F.col("id").alias("movie_id")).withColumns({
        "War": F.lit(1), "Drama": (F.col("movie_id") % 2).cast("int")})
    stats = reports.genre_stats(ratings, items, users)
    rows = stats.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(stats)
    assert sum(r.rating_count for r in rows if r.genre == "War") == 60000
    assert sum(r.rating_count for r in rows if r.genre == "Drama") == ratings.where(
        "item_id % 2 = 1").count()


def test_a_text_repeated_everywhere_is_reduced_before_the_shuffle(spark, small_limits, new_path):
    row = F.col("id")
    spark.range(0, 30000, 1, 8).select(
        F.lit("t").alias("title"),
        F.when(row % 3 == 0, "copy").otherwise(row.cast("string")).alias("text"),
        F.lpad(row.cast("string"), 6, "0").alias("published"),
        F.concat(F.lit("u"), row.cast("string")).alias("url"), F.lit("s").alias("source"),
    ).write.parquet(new_path)
    kept = art.deduplicate(spark.read.parquet(new_path))
    rows = kept.collect()
    assert len(rows) == 20001
    assert [r.url for r in rows if r.text == "copy"] == ["u0"]
    plan = plan_of(kept)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_all_pairs_with_hot_keys(spark, small_limits, ratings):
    pairs = sim.all_pairs_similarity(ratings, threshold=0.0, min_common=2, busy_degree=50)
    got = {(r.item_a, r.item_b): r.strength for r in pairs.collect()}
    assert "CartesianProduct" not in plan_of(pairs) and "NestedLoop" not in plan_of(pairs)
    counted = spark.sql(
        "SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS strength "
        "FROM {c} a JOIN {c} b ON a.user_id = b.user_id AND a.item_id < b.item_id "
        "GROUP BY 1, 2 HAVING count(*) >= 2", c=ratings.select("user_id", "item_id").distinct())
    assert got == {(r.item_a, r.item_b): r.strength for r in counted.collect()}
