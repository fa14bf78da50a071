"""Keyword tables against ``contains``."""

import random

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom.operators import keywords as kw

TEXTS = "id int, text string"


def contained(texts, words):
    return sorted((k, word) for k, text in texts for word in set(words) if text is not None and word is not None and word in text)


@pytest.mark.parametrize("group_bytes", [kw.GROUP_BYTES, 40, 1])
def test_tags_equal_contains(spark, group_bytes):
    rng = random.Random(1)
    letters = "abé ß.x"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(60)] + [None, "", "ab", "ab", "%", "a\nb"]
    texts = [(k, "".join(rng.choice(letters + "%\n") for _ in range(rng.randint(0, 80)))) for k in range(40)]
    texts += [(100, None), (101, ""), (102, "ab"), (102, "ab")]
    table = spark.createDataFrame([(word,) for word in words], "ticker string")
    articles = spark.createDataFrame(texts, TEXTS)
    got = kw.tag_keywords(articles, table, group_bytes=group_bytes)
    assert got.columns == ["id", "text", "ticker"]
    wanted = contained(texts, words)
    assert sorted(values(got, "id", "ticker")) == wanted


def test_a_hundred_thousand_keywords(spark):
    rng = random.Random(2)
    words = list({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(100_000)})
    texts = [(k, "".join(rng.choice("abcdefgh") for _ in range(300))) for k in range(60)]
    articles = spark.createDataFrame(texts, TEXTS).repartition(4)
    table = spark.createDataFrame([(word,) for word in words], "ticker string")
    got = kw.tag_keywords(articles, table)
    by_length = {}
    for word in words:
        by_length.setdefault(len(word), set()).add(word)
    wanted = sorted({(k, text[at:at + n]) for k, text in texts for n, some in by_length.items()
                     for at in range(len(text) - n + 1) if text[at:at + n] in some})
    assert sorted(values(got, "id", "ticker")) == wanted
    assert "Join" not in plan_of(got)


def test_groups_are_bounded(spark):
    table = spark.range(500).select(F.concat(F.lit("word"), F.col("id")).alias("ticker"))
    sizes = kw.keyword_groups(table, "ticker", 100).groupBy("part").agg(F.sum(F.octet_length("word")).alias("n"))
    assert max(values(sizes, "n")) <= 100
    assert kw.tag_keywords(spark.createDataFrame([(1, "x")], TEXTS), table.where("false")).collect() == []
