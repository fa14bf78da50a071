"""Benchmark decontamination: size-partitioned MinHash containment search, DataFrame only.

An item is found in a document if the document contains at least 75 of 100 of the item's
distinct 5-word shingles. Documents are far longer than items, so signatures of whole
documents say nothing about containment. Instead each item is sketched by its smallest shingle
hashes (a bottom-k MinHash), with as many of them as it may miss, and one more: a document that
contains enough of the item contains at least one of them, so no item is lost. How many that
are depends on the size of the item; items are partitioned by size, and each partition has its
own largest sketch value, above which no shingle of a document needs to be looked up.

Documents with such a hit are few. They are read again and checked with all shingles of the
items. A text with fewer than five words is one shingle.

The item side is broadcast where its counted rows are at most ``BROADCAST_ROWS``; beyond, both
steps are joins by hash.

Defined cases: NULL or blank texts have no shingles and match nothing; rows that repeat a
doc_id are searched as one document; a NULL id of either side is a value like others; items
that repeat an id count with the text that is contained best.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.settings import written_table

WORDS_PER_SHINGLE = 5
FOUND, OF = 75, 100
BROADCAST_ROWS = 500_000  # rows of 32 bytes: 16 MB
NULL_ID = -(1 << 63)
BLANKS = " \t\n\u000b\f\r"


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>"))


def shingles_of(words: Column) -> Column:
    """Hashes of the shingles; repeated ones are repeated."""
    count = F.size(words)
    many = F.transform(
        F.sequence(F.lit(0), count - WORDS_PER_SHINGLE),
        lambda at: F.xxhash64(*[F.get(words, at + step) for step in range(WORDS_PER_SHINGLE)]))
    return (F.when(count >= WORDS_PER_SHINGLE, many)
            .when(count > 0, F.array(F.xxhash64(F.array_join(words, " "))))
            .otherwise(F.array().cast("array<bigint>")))


def shingled(table: DataFrame, key: str) -> DataFrame:
    """(key, shingles) of a table (key, text). The words are bound to a lambda variable: as a
    column of their own they would be pulled into it and split anew for every shingle."""
    node = F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias(key)
    bound = F.transform(F.array(words_of(F.col("text"))), shingles_of)
    return table.select(node, F.get(bound, F.lit(0)).alias("shingles"))


def item_sketches(items: DataFrame) -> DataFrame:
    """(item_id, version, n_item, partition, shingles, sketch): sorted distinct shingles and
    the smallest of them; the partition is the power of two below the size."""
    sets = shingled(items.select("item_id", "text"), "item_id").select(
        "item_id", F.array_sort(F.array_distinct("shingles")).alias("shingles"))
    sets = sets.where(F.size("shingles") > 0).distinct()
    size = F.size("shingles")
    needed = F.ceil(size * FOUND / OF).cast("int")
    return sets.select(
        "item_id", F.xxhash64("shingles").alias("version"), size.alias("n_item"),
        F.floor(F.log2(size)).cast("int").alias("partition"), "shingles",
        F.slice("shingles", 1, size - needed + 1).alias("sketch"))


def looked_up(rows: DataFrame, side: DataFrame) -> DataFrame:
    """Join by hash; the item side is broadcast if its counted size allows it."""
    small = side.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(side) if small else side, "hash")


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item, n_found) of documents (doc_id, text) that contain items
    (item_id, text)."""
    sketches = written_table(item_sketches(items), "sketches")
    keys = sketches.select("partition", "item_id", "version", F.explode("sketch").alias("hash"))
    limits = keys.groupBy("partition").agg(F.max("hash").alias("limit"))  # a row per power of two
    highest = limits.agg(F.max("limit")).first()[0]
    docs = documents.select("doc_id", "text")
    probes = shingled(docs, "doc_id").select("doc_id", F.explode("shingles").alias("hash"))
    # Above the largest sketch value of all partitions there is nothing to look up.
    probes = probes.where(F.col("hash") <= F.lit(highest if highest is not None else NULL_ID))
    hits = written_table(
        looked_up(probes, keys.select("hash").distinct()).select("doc_id").distinct(), "hits")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    chosen = docs.withColumn("node", key).join(hits.withColumnRenamed("doc_id", "node"), "node", "left_semi")
    shingles = shingled(chosen.select("doc_id", "text"), "doc_id").select(
        "doc_id", F.explode(F.array_distinct("shingles")).alias("hash"))
    full = sketches.select("item_id", "version", "n_item", F.explode("shingles").alias("hash"))
    found = looked_up(shingles, full).groupBy("doc_id", "item_id", "version", "n_item").agg(
        F.count_distinct("hash").alias("n_found"))
    best = (found.where(F.col("n_found") * OF >= F.col("n_item") * FOUND)
            .groupBy("doc_id", "item_id")
            .agg(F.max(F.struct(F.col("n_found") / F.col("n_item"), "n_item", "n_found")).alias("best")))
    return best.select(
        F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.nullif("item_id", F.lit(NULL_ID)).alias("item_id"),
        F.col("best.n_item").cast("long").alias("n_item"), F.col("best.n_found").alias("n_found"))


def without_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    bad = written_table(contaminated(documents, items).select(F.col("doc_id").alias("bad_id")).distinct(), "bad")
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")
