import json
import os

import pytest
from conftest import values

from tallyloom import schemas, settings
from tallyloom.plans.reports import ratings_bundle
from tallyloom.sources import delimited, results


def file_of(path, content: bytes):
    os.makedirs(path)
    with open(f"{path}/part", "wb") as file:
        file.write(content)
    return path


def test_ratings_file(spark, new_path):
    path = file_of(new_path, b"1\t2\t3.5\t881250949\nx\t2\t4\t5\n7\t8\n")
    assert [tuple(row) for row in delimited.read_ratings(spark, path).collect()] == [
        (1, 2, 3.5, 881250949), (None, 2, 4.0, 5), (7, 8, None, None)]


def test_users_file(spark, new_path):
    path = file_of(new_path, b"1|24|M|technician|85711\n2|old|F|other|T8H1N\n")
    assert [tuple(row) for row in delimited.read_users(spark, path).collect()] == [
        (1, 24, "M", "technician", "85711"), (2, None, "F", "other", "T8H1N")]


@pytest.mark.parametrize("encoding, title", [("UTF-8", "Caf� \"x\""), ("ISO-8859-1", "Café \"x\"")])
def test_items_file(spark, new_path, encoding, title):
    flags = b"|".join(b"01"[i % 2:i % 2 + 1] for i in range(19))
    path = file_of(new_path, b"1|Caf\xe9 \"x\"|01-Jan-1995||http://x|" + flags + b"\n")
    row = delimited.read_items(spark, path, encoding=encoding).first()
    assert row["title"] == title and row["video_release_date"] is None
    assert (row["unknown"], row["Action"], row["Western"]) == (0, 1, 0)
    assert list(row.asDict()) == schemas.ITEMS.fieldNames()


def test_object_store_settings():
    conf = settings.object_store_conf("store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings.object_store_conf("s", "k", "p", secure=True)[
        "spark.hadoop.fs.s3a.endpoint"] == "https://s"


def test_scratch_paths_lie_in_the_shared_folder(spark):
    first, second = (settings.scratch_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_bundle(spark, new_path):
    ratings = spark.createDataFrame(
        [(u, i, float(1 + (u * i) % 5)) for u in range(1, 41) for i in (1, 2)],
        "user_id int, item_id int, rating double")
    items = spark.createDataFrame([(1, "a", 1), (2, "b", 0)], "movie_id int, title string, War int")
    users = spark.createDataFrame([(u, 20 + u, None if u % 2 else "x") for u in range(1, 41)],
                                  "user_id int, age int, occupation string")
    bundle = ratings_bundle(ratings, items, users, "a", similar={"threshold": -1.0, "min_common": 9})
    results.write_bundle(bundle, new_path)
    document = json.loads(spark.read.text(new_path).first()["value"])
    assert list(document) == [
        "top_movies", "genre_analysis", "occupation_age_analysis", "movie_similarity"]
    assert [row["title"] for row in document["top_movies"]] == ["a", "b"]
    assert [row["occupation"] for row in document["occupation_age_analysis"]["occupation_stats"]] == [
        None, "x"]
    assert document["genre_analysis"][0] == {
        "occupation": None, "age_group": "20-25", "genre": "War", "avg_rating": 3.0,
        "rating_count": 2, "rank": 1}
    assert [row["title"] for row in document["movie_similarity"]] == ["b"]
    nothing = ratings_bundle(ratings, items, users, "a", min_ratings=99).first()["document"]
    assert json.loads(nothing)["top_movies"] == [] == json.loads(nothing)["movie_similarity"]


def test_report_tables(spark, new_path):
    from tallyloom.plans import reports

    ratings = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(1, 41) for i in (1, 2)],
                                    "user_id int, item_id int, rating double")
    items = spark.createDataFrame([(1, "a", 1), (2, "b", 0)], "movie_id int, title string, War int")
    users = spark.createDataFrame([(u, 20 + u, "x") for u in range(1, 41)], "user_id int, age int, occupation string")
    tables = reports.report_tables(ratings, items, users, "a", similar={"threshold": -1.0, "min_common": 9})
    for _ in range(2):
        reports.write_reports(tables, new_path)
    again = reports.read_reports(spark, new_path, tables)
    assert values(again["top_movies"], "title") == ["a", "b"]
    for name, table in tables.items():
        assert again[name].dtypes == table.dtypes and sorted(again[name].collect()) == sorted(table.collect())
    assert reports.bundle(again).first() == reports.bundle(tables).first()
