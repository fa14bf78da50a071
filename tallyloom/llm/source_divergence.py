"""How far the sources of a language differ in their words.

Each (language, source) group and each language gets a segment tree over the ids of the
kept terms, whose leaves are counts. Trees are hash-consed: equal subtrees, above all
those of rare terms that a group does not use, are one node, whichever group they belong
to. Two trees are compared by walking both at once; a pair of nodes that comes up several
times is followed once and its price multiplied, so the work depends on the number of
different node pairs, not on the number of terms.

Term ids follow the frequency in the language, so that equal counts lie side by side. The
ids are cut into blocks of 2^BLOCK_BITS terms, and the sources of a language into tiles of about
TILE: one row holds one block of one pair of tiles, which bounds what a task holds however
large a vocabulary, a source or the number of sources is. Block prices are added up by a
grouping. All arithmetic is exact: shares are taken with integers of any size.

Defined cases: NULL text, language or source reads as ''. Rows are documents, whether ids
repeat or not. A group without kept terms has the count 0 for each; a language without
kept terms gives its pairs of sources the value 0. A language with one source has no
pairs, and no terms either, as its source does not differ from it. An empty table gives no
rows; further columns of the input are not read. Texts of any length are read in pieces.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import text_batches
from tallyloom.settings import written_table

MIN_DOCUMENTS = 10
TOP_TERMS = 10
BLOCK_BITS = 12
TILE = 64
SCALE = 10 ** 9
CHUNK_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
HELD_TERMS = 300_000

# Letters and characters beyond ASCII make up terms; A-Z becomes a-z, all else a blank.
TO_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
NO_LETTER = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


# --- counting ----------------------------------------------------------------------

def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """All terms, in pieces cut between terms."""
    begin = 0
    while begin < len(data):
        end = begin + CHUNK_BYTES
        cut = NO_LETTER.search(data, end) if end < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[begin:end].translate(TO_TERMS).split()
        begin = end


COUNTS = "lang string, source string, term string, n long, docs long"


def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and numbers of documents by (lang, source, term), added up per task as long
    as few enough terms are held; an empty group gives a row without a term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flushed() -> pa.RecordBatch:
        langs, sources, terms, counts, docs = [], [], [], [], []
        for (lang, source), (n, d) in held.items():
            rows = max(len(n), 1)
            langs += [lang] * rows
            sources += [source] * rows
            terms += list(n) or [None]
            counts += list(n.values()) or [0]
            docs += [d[term] for term in n] or [0]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()),
             pa.array(terms, pa.binary()).view(pa.string()), pa.array(counts, pa.int64()),
             pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in text_batches(batches, BATCH_BYTES):
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for terms in terms_of(text):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            size += len(n) - before
            if size > HELD_TERMS or len(held) > HELD_TERMS:
                yield flushed()
                held.clear()
                size = 0
    if held:
        yield flushed()


# --- trees -------------------------------------------------------------------------

@dataclass
class Forest:
    """Trees over one block. ``counts`` holds the count of each leaf id, ``children`` the
    left and right nodes of each node from the lowest level up, ``empty`` whether nothing
    but zeros lies below a node, leaves first, ``roots`` the root of each tree."""

    counts: np.ndarray
    children: list[tuple[np.ndarray, np.ndarray]]
    empty: list[np.ndarray]
    roots: np.ndarray


NO_TERM = -1


def grow(counts: np.ndarray) -> Forest:
    """Hash-consed trees, one per row of ``counts``; its width is a power of two and
    NO_TERM fills up what is missing."""
    leaves, nodes = np.unique(counts, return_inverse=True)
    nodes = nodes.reshape(counts.shape)
    children, empty = [], [leaves <= 0]
    while nodes.shape[1] > 1:
        width = np.int64(len(empty[-1]))
        pairs, number = np.unique(nodes[:, 0::2] * width + nodes[:, 1::2], return_inverse=True)
        nodes = number.reshape(nodes.shape[0], nodes.shape[1] // 2)
        left, right = pairs // width, pairs % width
        children.append((left, right))
        empty.append(empty[-1][left] & empty[-1][right])
    return Forest(leaves, children, empty, nodes[:, 0])


def leaf_pairs(forest: Forest, one: int, two: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of leaves below two trees and how often each occurs. Pairs of
    nodes that come up several times go down once, with their number."""
    left, right, times = forest.roots[[one]], forest.roots[[two]], np.ones(1, dtype=np.int64)
    for level in range(len(forest.children) - 1, -1, -1):
        first, second = forest.children[level]
        width = np.int64(len(forest.empty[level]))
        pairs = np.concatenate((first[left] * width + first[right], second[left] * width + second[right]))
        order = np.argsort(pairs, kind="stable")
        pairs, twice = pairs[order], np.concatenate((times, times))[order]
        heads = np.flatnonzero(np.diff(pairs, prepend=-1))
        times = np.add.reduceat(twice, heads)
        left, right = pairs[heads] // width, pairs[heads] % width
    return left, right, times


def used_leaves(forest: Forest, one: int, two: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves of both trees and their positions, where the first has a count. Subtrees
    that are empty in the first are not entered."""
    left, right, at = forest.roots[[one]], forest.roots[[two]], np.zeros(1, dtype=np.int64)
    for level in range(len(forest.children) - 1, -1, -1):
        first, second = forest.children[level]
        inside = ~forest.empty[level + 1][left]
        left, right, at = left[inside], right[inside], at[inside] * 2
        left, right, at = (np.concatenate((first[left], second[left])),
                           np.concatenate((first[right], second[right])), np.concatenate((at, at + 1)))
    inside = ~forest.empty[0][left]
    order = np.argsort(at[inside])
    return left[inside][order], right[inside][order], at[inside][order]


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The smoothed share of each count; 1 for what is no term, so that it prices as 0."""
    divisor = total + 2 * terms
    return np.array([1 if n == NO_TERM else 1 + SCALE * (n + 2) // divisor for n in counts.tolist()],
                    dtype=np.int64)


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def top_leaves(forest: Forest, group: int, whole: int, p: np.ndarray, q: np.ndarray,
               count: int) -> list[tuple[int, int]]:
    """(position, price) of the terms of a group that stand out most from the language. Of
    terms equal in both counts the first ``count`` suffice, as ids order them by name;
    equal prices of other terms all stay, for the final ranking."""
    left, right, at = used_leaves(forest, group, whole)
    above = p[left] > q[right]
    left, right, at = left[above], right[above], at[above]
    if not len(at):
        return []
    pairs = left * np.int64(len(forest.counts)) + right
    order = np.argsort(pairs, kind="stable")
    heads = np.flatnonzero(np.diff(pairs[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    few = order[place < count]
    value = prices(p[left[few]], q[right[few]])
    least = np.sort(value)[-min(count, len(value))]
    return [(int(at[k]), int(v)) for k, v in zip(few[value >= least], value[value >= least])]


PRICES = "lang string, source string, other string, tid long, value long"


def price_task(top: int, block_bits: int):
    """Prices of one block of two tiles per row: pairs of sources (the smaller name first),
    and in rows of one tile also candidates for the top terms (``other`` is NULL)."""

    def priced(row: dict) -> Iterator[tuple]:
        same = row["tile"] == row["other_tile"]
        groups = row["members"] + ([] if same else row["other_members"])
        names = [group["source"] for group in groups]
        number = {name: k for k, name in enumerate(names)}
        if row["block"] < 0:  # no terms, but every pair gets its row
            width, forest = 0, None
        else:
            width = 1 << max(row["width"] - 1, 0).bit_length()
            counts = np.full((len(names) + 1, width), NO_TERM, dtype=np.int64)
            counts[:, :row["width"]] = 0
            for cell in (row["cells"] or []) + ([] if same else row["other_cells"] or []):
                counts[number[cell["source"]], cell["at"]] = cell["n"]
            for cell in row["lang_cells"]:
                counts[-1, cell["at"]] = cell["n"]
            forest = grow(counts)
            share = [shares(forest.counts, group["total"], row["terms"]) for group in groups]
            whole = shares(forest.counts, row["lang_total"], row["terms"])
        own = len(row["members"])
        for a in range(own):
            for b in range(a + 1 if same else own, len(names)):
                value = 0
                if forest is not None:
                    left, right, times = leaf_pairs(forest, a, b)
                    value = int((prices(share[a][left], share[b][right]) * times).sum())
                yield (row["lang"], *sorted((names[a], names[b])), None, value)
            if same and forest is not None:
                for at, value in top_leaves(forest, a, len(names), share[a], whole, top):
                    yield (row["lang"], names[a], None, (row["block"] << block_bits) + at, value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()),
                            ("tid", pa.int64()), ("value", pa.int64())])
        for batch in batches:
            for k in range(batch.num_rows):
                rows = list(priced(batch.slice(k, 1).to_pylist()[0]))
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


# --- the whole ---------------------------------------------------------------------

def count_terms(documents: DataFrame) -> DataFrame:
    """Counts by (lang, source, term); a row without a term for each group."""
    text, lang, source = (F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("text", "lang", "source"))
    return (documents.select(lang, source, text).mapInArrow(count_task, COUNTS)
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def tiled(groups: DataFrame, tile: int) -> DataFrame:
    """Deals the sources of each language to tiles of about ``tile``."""
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    return groups.join(tiles, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), "tiles").cast("int"))


def ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        out = out.where(F.col("rank") <= most)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def source_divergence(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS,
                      tile: int = TILE, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Of ``documents`` (text, lang, source): for each group the other sources of its
    language by divergence (part ``pair``), and the terms it uses more than its language
    does (part ``term``, the first ``top``): lang, source, part, item, value, rank."""
    c = F.col
    counted = written_table(count_terms(documents), "term_counts")
    kept = (counted.where(c("term").isNotNull()).groupBy("lang", "term")
            .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
            .where(c("docs") >= min_documents).select("lang", "term", "total"))
    order = ["lang", F.desc("total"), "term"]
    terms = written_table(kept.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "tid", F.monotonically_increasing_id()), "terms")
    block, at = F.shiftright("tid", block_bits), c("tid").bitwiseAND((1 << block_bits) - 1).cast("int")

    by_lang = terms.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("terms"))
    counts = written_table(counted.where(c("term").isNotNull()).join(
        terms.select("lang", "term", "tid"), ["lang", "term"]).select("lang", "source", "tid", "n"), "counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written_table(tiled(
        counted.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")), tile), "groups")

    # One row per block of terms and tile of sources. A mixed block is one per language,
    # so positions start at its first term of that language.
    blocks = terms.groupBy("lang", block.alias("block")).agg(
        F.min(at).alias("low"), (F.max(at) - F.min(at) + 1).alias("width"),
        F.collect_list(F.struct(at.alias("at"), c("total").alias("n"))).alias("lang_cells"))
    none = groups.select("lang").distinct().select(
        "lang", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("low"), F.lit(0).alias("width"),
        F.array().cast("array<struct<at:int,n:bigint>>").alias("lang_cells"))
    cells = (counts.join(groups.select("lang", "source", "tile"), ["lang", "source"])
             .groupBy("lang", block.alias("block"), "tile")
             .agg(F.collect_list(F.struct("source", at.alias("at"), "n")).alias("cells")))
    members = groups.groupBy("lang", "tile").agg(F.collect_list(F.struct("source", "total")).alias("members"))
    tiles = (blocks.unionByName(none).join(members, "lang")
             .join(cells, ["lang", "block", "tile"], "left")
             .join(by_lang, "lang", "left"))
    tiles = written_table(tiles, "tiles")
    other = tiles.select("lang", "block", c("tile").alias("other_tile"), c("members").alias("other_members"),
                         c("cells").alias("other_cells"))
    paired = tiles.join(other, ["lang", "block"]).where(c("tile") < c("other_tile")).unionByName(
        tiles.withColumns({"other_tile": c("tile"), "other_members": F.array().cast(other.schema["other_members"].dataType),
                           "other_cells": F.lit(None).cast(other.schema["other_cells"].dataType)}))
    names = ["lang", "block", "width", "lang_cells", "tile", "members", "cells", "lang_total", "terms",
             "other_tile", "other_members", "other_cells"]
    moved = paired.withColumns({name: shifted(name) for name in ("lang_cells", "cells", "other_cells")})
    # The rows are few and each is much work, so they are dealt out singly.
    dealt = moved.select("low", *names).repartition(F.xxhash64("lang", "block", "tile", "other_tile"))
    priced = written_table(dealt.drop("low").mapInArrow(price_task(top, block_bits), PRICES), "prices")

    low = terms.groupBy("lang", block.alias("block")).agg(F.min(at).alias("low"))
    stand_out = (priced.where(c("other").isNull()).withColumn("block", block)
                 .join(low, ["lang", "block"]).withColumn("tid", c("tid") + c("low"))
                 .join(terms.select("tid", c("term").alias("item")), "tid"))
    pairs = (priced.where(c("other").isNotNull()).groupBy("lang", "source", "other")
             .agg(F.sum("value").alias("value")))
    sides = F.array(F.struct(c("source").alias("source"), c("other").alias("item")),
                    F.struct(c("other").alias("source"), c("source").alias("item")))
    both = pairs.select("lang", "value", F.inline(sides))
    return ranked(both, "pair").unionByName(ranked(stand_out, "term", top))


def shifted(name: str) -> Column:
    """Cells with positions from the first term of the language in the block."""
    return F.transform(name, lambda cell: cell.withField("at", cell["at"] - F.col("low")))
