"""Keywords of a table found in texts, all in one pass over each text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.settings import written_table

# The most a group of keywords may take as text; an automaton takes some fifty times that.
GROUP_BYTES = 4 << 20


def automaton(keywords: list[str]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for keyword in keywords:
        machine.add_word(keyword, keyword)
    machine.make_automaton()
    return machine


def keyword_groups(keywords: DataFrame, name: str, group_bytes: int) -> DataFrame:
    """The different keywords with the number of their group. Groups are made smaller until
    all of them hold at most ``group_bytes``, or a single keyword."""
    words = written_table(keywords.select(F.col(name).alias("word")).where(
        F.col(name).isNotNull()).distinct(), "keywords")
    size = F.octet_length("word")
    groups = -(-words.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"] // group_bytes) or 1
    while True:
        dealt = words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(groups)))
        crowded = dealt.groupBy("part").agg(F.sum(size).alias("bytes"), F.count("*").alias("words")).where(
            (F.col("bytes") > group_bytes) & (F.col("words") > 1))
        if crowded.isEmpty():
            return dealt
        groups *= 2


def tag_keywords(
    articles: DataFrame, keywords: DataFrame, column: str = "text", name: str = "ticker",
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """One row per article and keyword its text contains, like ``tag_tickers`` but for a
    table of keywords of any size.

    The keywords of a group become one automaton that is broadcast and finds all of them
    in one pass. Keywords beyond ``group_bytes`` make more groups, and the articles are read
    once per group; the size is checked before anything is collected. NULL keywords and
    texts match nothing, an empty keyword matches every text.
    """
    spark = articles.sparkSession
    dealt = keyword_groups(keywords, name, group_bytes)
    parts = sorted(row["part"] for row in dealt.select("part").distinct().collect())
    if not parts:
        return articles.select("*", F.lit(None).cast("string").alias(name)).where("false")
    return reduce(DataFrame.unionByName, [
        tagged_with(articles, spark.sparkContext.broadcast(
            [row["word"] for row in dealt.where(F.col("part") == part).collect()]), column, name)
        for part in parts])


def tagged_with(articles: DataFrame, keywords, column: str, name: str) -> DataFrame:

    @F.pandas_udf("array<string>")
    def contained(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        everywhere = [word for word in keywords.value if not word]
        machine = automaton([word for word in keywords.value if word])
        for texts in batches:
            yield pd.Series([
                None if text is None else everywhere + sorted({word for _, word in machine.iter(text)})
                if len(machine) else everywhere for text in texts], index=texts.index)

    return articles.select("*", F.explode(contained(F.col(column))).alias(name))
