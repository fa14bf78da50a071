import math
import random
from collections import defaultdict

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom.operators import similarity as sim

RATINGS = "user_id int, item_id int, rating double"
ITEMS = "movie_id int, title string"


def score(metric, pairs):
    pairs = [(x, y) for x, y in pairs if x is not None and y is not None]
    if not pairs:
        return None
    xs, ys = zip(*pairs)
    if metric == "cosine":
        size = math.sqrt(sum(x * x for x in xs)) * math.sqrt(sum(y * y for y in ys))
        return sum(x * y for x, y in pairs) / size if size else None
    mean_x, mean_y = sum(xs) / len(xs), sum(ys) / len(ys)
    if len(set(xs)) == 1 or len(set(ys)) == 1:
        return None
    cov = sum((x - mean_x) * (y - mean_y) for x, y in pairs)
    return cov / math.sqrt(sum((x - mean_x) ** 2 for x in xs) * sum((y - mean_y) ** 2 for y in ys))


def brute_force_metrics(ratings, target, metric):
    pairs = defaultdict(list)
    for user, item, x in ratings:
        if item == target:
            for other_user, other, y in ratings:
                if other_user == user and other != target:
                    pairs[other].append((x, y))
    return {other: (score(metric, found), len(found)) for other, found in pairs.items()}


def brute_force_pairs(ratings, metric, min_common, threshold):
    repeated = defaultdict(list)
    for user, item, rating in ratings:
        if None not in (user, item, rating):
            repeated[user, item].append(rating)
    by_user = defaultdict(dict)
    for (user, item), found in repeated.items():
        by_user[user][item] = sum(found) / len(found)
    pairs = defaultdict(list)
    for rated in by_user.values():
        for a in rated:
            for b in rated:
                if a < b:
                    pairs[a, b].append((rated[a], rated[b]))
    out = {}
    for key, found in pairs.items():
        value = score(metric, found)
        if len(found) >= min_common and value is not None and value >= threshold:
            out[key] = (round(value, 9), len(found))
    return out


def random_ratings(seed, users, items, share, busy=(), missing=0.0, repeats=1):
    draw = random.Random(seed)
    rows = []
    for user in range(users):
        for item in range(items):
            if draw.random() < (0.9 if user in busy else share):
                for _ in range(draw.randint(1, repeats)):
                    rating = None if draw.random() < missing else float(draw.randint(1, 5))
                    rows.append((user, item, rating))
    return rows


@pytest.mark.parametrize("metric", ["pearson", "cosine"])
@pytest.mark.parametrize("missing, repeats", [(0.0, 1), (0.2, 1), (0.2, 3)])
def test_metrics_equal_the_listed_pairs(spark, metric, missing, repeats):
    rows = random_ratings(7, 25, 12, 0.5, missing=missing, repeats=repeats)
    ratings = spark.createDataFrame(rows, RATINGS)
    got = {r.other_item_id: (r.score, r.strength)
           for r in sim.pair_metrics(ratings, 3, metric).collect()}
    wanted = brute_force_metrics(rows, 3, metric)
    assert got.keys() == wanted.keys()
    for item, (value, strength) in wanted.items():
        assert got[item][1] == strength
        assert got[item][0] == (None if value is None else pytest.approx(value, abs=1e-9))
    assert sim.paired_ratings(ratings, 3).count() == sum(s for _, s in wanted.values())


def test_special_groups_have_no_score(spark):
    rows = [(u, 1, float(u)) for u in (1, 2, 3)]
    rows += [(u, 2, 4.0) for u in (1, 2, 3)]                  # does not vary
    rows += [(1, 3, 5.0)]                                     # one user
    rows += [(u, 4, float(u) / 3) for u in (1, 2, 3)]         # perfect
    rows += [(u, 5, 5.0 - u) for u in (1, 2, 3)]              # opposite
    rows += [(u, 6, 10 / 3) for u in (1, 2, 3)]               # does not vary, no exact sums
    rows += [(u, 7, None) for u in (1, 2, 3)]                 # no rating
    got = {r.other_item_id: r.score for r in
           sim.pair_metrics(spark.createDataFrame(rows, RATINGS), 1).collect()}
    assert [got[i] for i in (2, 3, 6, 7)] == [None] * 4
    assert got[4] == pytest.approx(1.0) and got[5] == pytest.approx(-1.0)


def test_missing_target(spark):
    ratings = spark.createDataFrame([(1, 1, 2.0)], RATINGS)
    items = spark.createDataFrame([(1, "a")], ITEMS)
    with pytest.raises(ValueError):
        sim.item_similarity(ratings, items, "nowhere")
    with pytest.raises(ValueError):
        sim.item_similarity(ratings, items)
    with pytest.raises(ValueError):
        sim.pair_metrics(ratings, 1, "euclid")
    assert sim.item_similarity(ratings, items, item_id=99).count() == 0


def test_default_thresholds(spark):
    rows = [(u, 1, float(u % 5 + 1)) for u in range(50)]
    rows += [(u, 2, float(u % 5 + 1)) for u in range(50)]
    rows += [(u, 3, float(u % 5 + 1)) for u in range(49)]
    rows += [(u, 4, float(5 - u % 5)) for u in range(50)]
    items = spark.createDataFrame([(i, f"t{i}") for i in range(1, 5)], ITEMS)
    found = sim.item_similarity(spark.createDataFrame(rows, RATINGS), items, "t1")
    assert values(found, "title", "strength") == [("t2", 50)]
    assert found.columns == ["title", "score", "strength"]


def test_titles(spark):
    items = spark.createDataFrame(
        [(3, "Heat"), (2, "Heat"), (4, "100% Heated"), (5, "cold")], ITEMS)
    assert sim.find_item_id(items, "Heat") == 2
    assert sorted(values(sim.search_titles(items, "HEAT"), "movie_id")) == [2, 3, 4]
    assert values(sim.search_titles(items, "0%"), "movie_id") == [4]
    assert values(sim.search_titles(items, "c_ld", like=True), "movie_id") == [5]
    assert sim.title_lookup(items, "none").count() == 0


@pytest.mark.parametrize("metric, threshold", [("cosine", 0.8), ("pearson", 0.0123)])
@pytest.mark.parametrize("min_common, busy_degree", [(1, 3), (2, 3), (3, 8), (5, 1000)])
def test_all_pairs_equal_brute_force(spark, metric, threshold, min_common, busy_degree):
    rows = random_ratings(11, 20, 14, 0.3, busy=(0, 1, 5), missing=0.1, repeats=2)
    got = sim.all_pairs_similarity(
        spark.createDataFrame(rows, RATINGS), metric=metric, threshold=threshold,
        min_common=min_common, busy_degree=busy_degree, digits=9)
    assert {(r.item_a, r.item_b): (pytest.approx(r.score, abs=2e-9), r.strength)
            for r in got.collect()} == brute_force_pairs(rows, metric, min_common, threshold)


def test_a_pair_that_mostly_busy_users_rated_is_found(spark):
    # Two busy users and one other rated items 1 and 2: without the busy ones the pair
    # has a single common user.
    rows = [(user, item, float(1 + (user + item) % 5)) for user in (1, 2) for item in range(1, 30)]
    rows += [(3, 1, 2.0), (3, 2, 3.0)]
    got = sim.all_pairs_similarity(spark.createDataFrame(rows, RATINGS), threshold=0.0,
                                   min_common=3, busy_degree=10)
    assert values(got, "item_a", "item_b", "strength") == [(1, 2, 3)]


def test_all_pairs_agree_with_one_target(spark):
    rows = random_ratings(3, 30, 8, 0.6, repeats=2)
    ratings = spark.createDataFrame(rows, RATINGS).cache()
    items = spark.createDataFrame([(i, str(i)) for i in range(8)], ITEMS)
    options = dict(metric="pearson", threshold=-1.1, min_common=2, digits=9)
    pairs = {(r.item_a, r.item_b): (r.score, r.strength)
             for r in sim.all_pairs_similarity(ratings, **options).collect()}
    one = {(min(4, int(r.title)), max(4, int(r.title))): (r.score, r.strength)
           for r in sim.item_similarity(ratings, items, item_id=4, top_n=100, dedupe="avg",
                                        **options).collect()}
    assert one == {key: value for key, value in pairs.items() if 4 in key}


def test_order_of_rows_does_not_matter(spark):
    rows = random_ratings(5, 30, 8, 0.6)
    items = spark.createDataFrame([(i, str(i)) for i in range(8)], ITEMS)
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        found = sim.item_similarity(spark.createDataFrame(rows, RATINGS), items, item_id=2,
                                    threshold=-1.0, min_common=1, digits=9)
        results.append(values(found, "title", "score", "strength"))
    assert results[0] == results[1]


def test_stats_of_nothing(spark):
    metrics = sim.pair_metrics(spark.createDataFrame([], RATINGS), 1)
    assert sim.similarity_stats(metrics).first().asDict() == {
        "total_pairs": 0, "total_compared": 0, "valid_comparisons": 0, "avg_similarity": None,
        "min_common_users": None, "max_common_users": None}


def test_target_filter_reaches_the_scan(spark, new_path):
    spark.createDataFrame([(1, 1, 2.0)], RATINGS).write.parquet(new_path)
    plan = plan_of(sim.pair_metrics(spark.read.parquet(new_path), 1))
    assert "EqualTo(item_id,1)" in plan and "Not(EqualTo(item_id,1))" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bucketed_ratings_are_not_shuffled_again(spark):
    rows = random_ratings(1, 40, 10, 0.5)
    spark.createDataFrame(rows, RATINGS).write.bucketBy(4, "user_id").mode("overwrite").saveAsTable(
        "bucketed_ratings")
    ratings = spark.table("bucketed_ratings")
    with_merge_join = sim.pair_metrics(ratings.hint("merge"), 1)
    assert "hashpartitioning(user_id" not in plan_of(with_merge_join)
    assert {r.other_item_id: r.strength for r in with_merge_join.collect()} == {
        item: strength for item, (_, strength) in brute_force_metrics(rows, 1, "pearson").items()}
