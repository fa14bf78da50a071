"""Plans for all pairs of items: equal results, bounded units, few candidates."""

import random
from itertools import combinations

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom.operators import allpairs as ap
from tallyloom.operators import similarity as sim

RATINGS = "user_id int, item_id int, rating float"


def common_users(rows):
    of_item = {}
    for user, item, _ in rows:
        of_item.setdefault(item, set()).add(user)
    return {(a, b): len(of_item[a] & of_item[b]) for a, b in combinations(sorted(of_item), 2)}


def ratings_with_hot_ones(seed, users=150, items=50):
    """Users 0 to 2 rate all items, item 0 is rated by nearly all users."""
    rng = random.Random(seed)
    rows = [(u, i, float(rng.randint(1, 5))) for u in range(users) for i in range(items)
            if u < 3 or i == 0 and u % 10 or rng.random() < 0.04]
    rows += [(u, i, float(rng.randint(1, 5))) for u in range(60, 130) for i in (7, 8)]
    return list({(u, i): (u, i, r) for u, i, r in rows}.values())


@pytest.mark.parametrize("min_common, busy_degree", [(0, 7), (1, 5000), (4, 7), (50, 5000)])
def test_plans_agree_with_brute_force(spark, min_common, busy_degree):
    rows = ratings_with_hot_ones(min_common)
    ratings = spark.createDataFrame(rows, RATINGS)
    wanted = {pair: n for pair, n in common_users(rows).items() if n >= max(min_common, 1)}
    found = {}
    for plan in ap.PLANS:
        got = sim.all_pairs_similarity(ratings, threshold=-1.0, min_common=min_common, digits=9,
                                       busy_degree=busy_degree, plan=plan).collect()
        assert {(r.item_a, r.item_b): r.strength for r in got} == wanted
        found[plan] = sorted((r.item_a, r.item_b, r.score, r.strength) for r in got)
    assert found["pairs"] == found["prefix"] == found["auto"]
    assert wanted or min_common == 50


@pytest.mark.parametrize("metric", ["cosine", "pearson"])
def test_prefix_scores(spark, metric):
    ratings = spark.createDataFrame(ratings_with_hot_ones(9), RATINGS)
    one, two = (sim.all_pairs_similarity(ratings, metric=metric, threshold=0.2, min_common=3, digits=9, plan=plan)
                for plan in ("pairs", "prefix"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


@pytest.mark.parametrize("common", [1, 2, 4, 50])
def test_candidates_hold_all_results_and_few_others(spark, common):
    rows = ratings_with_hot_ones(2)
    rated = spark.createDataFrame(rows, RATINGS)
    many = {pair for pair, n in common_users(rows).items() if n >= common}
    found = set(map(tuple, ap.candidate_pairs(rated, common, 5000).collect()))
    assert many <= found
    met = sum(n > 0 for n in common_users(rows).values())
    # Three users rated everything, so every pair meets; few meet in a prefix. Three items
    # alone have 50 raters.
    assert met == 50 * 49 // 2
    assert len(found) == met if common == 1 else len(found) < {2: met + 1, 4: met / 2, 50: 4}[common]


def test_prefix_leaves_out_the_busiest_raters(spark):
    rated = spark.createDataFrame(ratings_with_hot_ones(2), RATINGS)
    kept = ap.prefix_lists(rated, 4)
    assert kept.where("user_id < 3").count() == 0
    sizes = dict(values(rated.groupBy("item_id").agg(F.count("*").alias("n")), "item_id", "n"))
    left = dict(values(kept.groupBy("item_id").agg(F.count("*").alias("n")), "item_id", "n"))
    assert left == {item: n - 3 for item, n in sizes.items() if n > 3}


def test_few_rows_per_item_are_passed_on_to_find_the_busiest(spark):
    rated = spark.createDataFrame(ratings_with_hot_ones(2), RATINGS)
    assert "WindowGroupLimit" in plan_of(ap.prefix_lists(rated, 4))


def test_no_unit_is_above_the_square(spark):
    rows = [(user, item, 1.0) for user, size in ((1, 900), (2, 60), (3, 10)) for item in range(size)]
    lists = spark.createDataFrame(rows, RATINGS)
    left, right = ap.block_units(lists, 50)
    unit = ["user_id", "p", "q"]
    work = left.groupBy(unit).agg(F.count("*").alias("l")).join(
        right.groupBy(unit).agg(F.count("*").alias("r")), unit, "full")
    rows = work.collect()
    assert max(row.l * row.r for row in rows) <= 50 ** 2
    assert all(row.p <= row.q for row in rows)
    pairs = ap.listed_pairs(lists, 50)
    assert pairs.count() == pairs.distinct().count() + 60 * 59 // 2 + 10 * 9 // 2 == ap.count_pairs(lists)
    assert pairs.where("item_a >= item_b").count() == 0


def test_more_pairs_get_more_tasks(spark, monkeypatch):
    lists = spark.createDataFrame([(1, item, 1.0) for item in range(400)], RATINGS)
    monkeypatch.setattr(ap, "UNITS_PER_TASK", 1)
    assert "hashpartitioning(user_id" in plan_of(ap.listed_pairs(lists, 50))
    assert ap.listed_pairs(lists, 50).rdd.getNumPartitions() == 400 * 399 // 2 // 2500 + 1


def test_the_plan_with_less_work_is_taken(spark):
    rows = [(user, item, 1.0) for user in range(3) for item in range(300)]
    rows += [(10 + item, item, 2.0) for item in range(300)] + [(1000, 1, 3.0), (1000, 2, 3.0), (1001, 1, 1.0), (1001, 2, 2.0)]
    rated = spark.createDataFrame(rows, RATINGS)

    def plan(rated, common):
        raters = rated.groupBy("item_id").agg(F.count("*").alias("raters")).where(F.col("raters") >= common)
        return ap.cheaper_plan(rated, raters, common)

    assert plan(rated, 4) == "prefix" and plan(rated, 1) == "pairs"
    assert plan(spark.createDataFrame([], RATINGS), 3) in ap.PLANS
    with pytest.raises(ValueError):
        ap.sums_of_pairs(rated, 2, 10, plan="fast")


def test_scores_stay_in_range(spark):
    rows = [(u, i, 0.1 * (u + 1)) for u in range(200) for i in (1, 2)]
    for metric in ("cosine", "pearson"):
        got = sim.all_pairs_similarity(spark.createDataFrame(rows, RATINGS), metric=metric, threshold=0.9, min_common=2)
        assert [r.score <= 1.0 for r in got.collect()] == [True]
