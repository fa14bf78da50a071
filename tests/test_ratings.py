from collections import defaultdict
from itertools import product

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import ratings as reports
from tallyloom.plans import reports as lines

RATINGS = "user_id int, item_id int, rating double"
USERS = "user_id int, age int, occupation string"


def test_mean_age_ignores_missing_ages_and_keeps_missing_occupations(spark):
    users = spark.createDataFrame(
        [(1, 20, "b"), (2, 31, "b"), (3, None, "b"), (4, 50, None), (5, None, "a")], USERS)
    assert values(reports.mean_age_by_occupation(users), "occupation", "mean_age") == [
        (None, 50.0), ("a", None), ("b", 25.5)]
    line = lines.mean_age_lines(
        reports.mean_age_by_occupation(users.where("occupation = 'b'"))).first()["line"]
    assert line == "b: 25.5"


def rated(spark, counts):
    rows = [(user, item, float(rating)) for item, (count, rating) in counts.items()
            for user in range(count)]
    return spark.createDataFrame(rows, RATINGS)


def test_top_items_threshold_and_ties(spark):
    ratings = rated(spark, {1: (34, 5), 2: (35, 4), 3: (35, 4), 4: (36, 4), 5: (50, 3)})
    items = spark.createDataFrame(
        [(i, title) for i, title in enumerate(["z", "few", "same", "same", "most", "low"])],
        "movie_id int, title string")
    top = reports.top_rated_items(ratings, items)
    assert values(top, "title", "rating_count") == [
        ("most", 36), ("same", 35), ("same", 35), ("low", 50)]
    assert top.columns == ["title", "avg_rating", "rating_count"]
    cut = reports.top_rated_items(ratings, items.withColumn("title", F.col("movie_id").cast("string")), top_n=2)
    assert values(cut, "title") == ["4", "2"]


def test_top_items_leaves_out_items_without_title_before_the_limit(spark):
    ratings = rated(spark, {1: (35, 5), 2: (35, 4)})
    items = spark.createDataFrame([(2, "known")], "movie_id int, title string")
    assert values(reports.top_rated_items(ratings, items, top_n=1), "title") == ["known"]


@pytest.mark.parametrize("age, group", [
    (19, "45 and older"), (20, "20-25"), (24, "20-25"), (25, "25-35"), (34, "25-35"),
    (35, "35-45"), (44, "35-45"), (45, "45 and older")])
def test_age_groups(spark, age, group):
    users = spark.createDataFrame([(1, age, "x"), (2, None, "x")], USERS)
    assert values(reports.with_age_group(users), "age_group") == [group]
    strict = "under 20" if age == 19 else group
    assert values(reports.with_age_group(users, under_20="under 20"), "age_group") == [strict]


def test_lines(spark):
    means = [3.125, 3.375, 2.675, 3.725, 0.0, 4.999]
    top = spark.createDataFrame([("t", mean, 35) for mean in means],
                                "title string, avg_rating double, rating_count long")
    assert values(lines.top_rated_lines(top), "line") == [
        f"t: {mean:.2f} (35 ratings)" for mean in means]
    ranking = spark.createDataFrame([("o", "20-25", "War", 4.5, 2)],
                                    "occupation string, age_group string, genre string, "
                                    "avg_rating double, rating_count long")
    assert values(lines.genre_lines(ranking), "line") == [
        "  Age Group 20-25        : War          (Avg Rating: 4.50, Count: 2)"]
    similar = spark.createDataFrame([("t", 0.9819256006071412, 56)],
                                    "title string, score double, strength long")
    assert values(lines.similar_lines(similar), "line") == [
        f"{'t':<50} score: {0.9819256006071412:<50} strength: 56"]


def flagged_items(spark, flags):
    rows = [tuple([movie_id, "t", None, None, None] + [int(name in names) for name in
                   ("unknown", *schemas.GENRES)]) for movie_id, names in flags.items()]
    return spark.createDataFrame(rows, schemas.ITEMS)


def test_genres_of_items(spark):
    items = flagged_items(spark, {1: (), 2: ("unknown",), 3: ("War", "Action"), 4: schemas.GENRES})
    found = defaultdict(list)
    for movie_id, genre in values(reports.item_genres(items), "movie_id", "genre"):
        found[movie_id].append(genre)
    assert dict(found) == {3: ["Action", "War"], 4: list(schemas.GENRES)}


def test_genre_columns_follow_the_table(spark):
    items = spark.createDataFrame([(1, "t", 1, 0)], "movie_id int, title string, New int, unknown int")
    assert schemas.genre_columns(items) == ["New"]


def test_genre_stats_equal_the_joined_rows(spark):
    flags = {1: ("Drama",), 2: ("Drama", "War"), 3: ("unknown",), 4: ("Comedy", "War")}
    users = [(1, 22, "a"), (2, 22, "a"), (3, 50, "b"), (4, None, "a"), (5, 30, None)]
    ratings = [(u, i, None if (u + i) % 5 == 0 else float((u * i) % 5 + 1))
               for u, i in product(range(1, 6), range(1, 5)) for _ in range(1 + (u + i) % 2)]
    got = reports.genre_stats(
        spark.createDataFrame(ratings, RATINGS), flagged_items(spark, flags),
        spark.createDataFrame(users, USERS))
    label = {1: "20-25", 2: "20-25", 3: "45 and older", 5: "25-35"}
    wanted = defaultdict(list)
    for user, item, rating in ratings:
        if user in label:
            occupation = next(o for u, _, o in users if u == user)
            for genre in set(flags[item]) - {"unknown"}:
                wanted[occupation, label[user], genre].append(rating)
    expected = {}
    for key, found in wanted.items():
        known = [rating for rating in found if rating is not None]
        expected[key] = (sum(known) / len(known) if known else None, len(found))
    assert {(r.occupation, r.age_group, r.genre): (r.avg_rating, r.rating_count)
            for r in got.collect()} == expected


def test_genre_ranking_breaks_ties_by_count_then_name(spark):
    flags = {1: ("War",), 2: ("Drama",), 3: ("Comedy",)}
    ratings = [(1, 1, 4.0), (1, 2, 4.0), (1, 2, 4.0), (1, 3, 4.0)]
    ranking = reports.genre_ranking(
        spark.createDataFrame(ratings, RATINGS), flagged_items(spark, flags),
        spark.createDataFrame([(1, 22, "a")], USERS), top_k=3)
    assert values(ranking, "rank", "genre") == [(1, "Drama"), (2, "Comedy"), (3, "War")]


def test_plans(spark):
    ratings = rated(spark, {1: (40, 5)})
    items = flagged_items(spark, {1: ("War",)})
    users = spark.createDataFrame([(1, 22, "a")], USERS)
    assert "WindowGroupLimit" in plan_of(reports.genre_ranking(ratings, items, users))
    assert "TakeOrderedAndProject" in plan_of(reports.top_rated_items(ratings, items))


def test_empty_inputs(spark):
    ratings = spark.createDataFrame([], RATINGS)
    items = flagged_items(spark, {})
    users = spark.createDataFrame([], USERS)
    for frame in (reports.top_rated_items(ratings, items), reports.mean_age_by_occupation(users),
                  reports.genre_ranking(ratings, items, users)):
        assert frame.count() == 0
