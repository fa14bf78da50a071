"""Exact top-k search by BM25: inverted index shards with block-max pruning.

*Index.* Each task turns the documents it reads into shards: sorted terms with their postings
and frequencies. Nothing is shuffled for that. A term is a run of letters or digits, A-Z
lower-cased, held as a 64-bit hash. The documents of a shard are put in the order of their most
widespread terms, so that the blocks of documents below differ in what they can score.

*Global statistics.* Document frequencies of the query terms, the number of documents and their
mean length come from all shards, so scores do not depend on how documents fell into shards.

*Search.* A task holds some shards and takes the queries from a table in the shared folder,
in batches of like queries. Rare terms are scored from their postings. What the frequent ones
could add is bounded by block maxima, for all queries of a batch and all blocks at once, and a
block whose bound stays below a query's k-th best score so far, also that of the shards before,
is never scored further for it (the pruning of block-max WAND, for whole blocks at once). The
frequent terms of the other blocks are added as a product of matrices: the idf of the queries
that still ask for the block times the weights in the block. The bests of all tasks are merged
per query. Every query meets every shard, so the work grows with queries times documents.

Defined cases: NULL or empty texts match nothing and as queries give no rows; a query term
counts once; equal scores (after rounding to four digits) are ordered by doc_id; rows that
repeat a doc_id are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import text_batches
from tallyloom.llm.minhash_dedup import LOWER, word_hashes
from tallyloom.settings import scratch_path, written_table

TOP = 10
K1, B = 1.2, 0.75
DIGITS = 4
SHARD_BYTES, SHARD_DOCS = 12 << 20, 4096
SHARDS_PER_TASK = 6
BLOCK = 256
RARE, LEAST = 16, 8  # a term in fewer than one in so many documents of a shard, or in so few, is rare
LIKENESS = 3  # widespread terms that order documents and queries
QUERIES, PAIRS = 512, 1 << 19  # a batch of queries ends at one of them
CELLS, TERMS, STEP = 4 << 20, 4096, 1 << 17  # sizes of scores, of matrices and of rare postings at once
CHUNK_BYTES = 1 << 20

SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
SEPARATORS = SEPARATORS[LOWER]


def distinct_terms(terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(terms, first posting of each, document of each posting, frequency) of documents whose
    terms follow each other."""
    found, numbers = np.unique(terms, return_inverse=True)
    owner = np.repeat(np.arange(len(counts)), counts)
    key, frequency = np.unique(numbers * len(counts) + owner, return_counts=True)
    number, doc = key // max(len(counts), 1), key % max(len(counts), 1)
    return found, np.searchsorted(number, np.arange(len(found) + 1)), doc, frequency


def is_frequent(df: np.ndarray, size: int) -> np.ndarray:
    """Which terms of a shard are scored by blocks."""
    return (df * RARE >= size) & (df >= LEAST)


def likeness_order(first: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Documents in the order of their most widespread terms, so that those of one language or
    kind share blocks."""
    df = np.diff(first)
    frequent = is_frequent(df, size)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    held = np.repeat(frequent, df)
    doc, rank = doc[held], np.repeat(rank, df)[held]
    keys = []
    for _ in range(LIKENESS):
        key = np.full(size, len(df))
        np.minimum.at(key, doc, rank)
        keys.append(key)
        rest = rank > key[doc]
        doc, rank = doc[rest], rank[rest]
    return np.lexsort(keys[::-1])


SHARD = "docs binary, lengths binary, terms binary, first binary, posting binary, frequency binary"
NAMES = ["docs", "lengths", "terms", "first", "posting", "frequency"]
KINDS = [np.int64, np.int64, np.uint64, np.int32, np.int32, np.int32]


def index_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs, terms, counts, size = [], [], [], 0

    def shard() -> pa.RecordBatch:
        lengths = np.concatenate(counts)
        found, first, doc, frequency = distinct_terms(np.concatenate(terms), lengths)
        order = likeness_order(first, doc, len(lengths))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        arrays = [np.concatenate(docs)[order], lengths[order], found, first, place[doc], frequency]
        return pa.RecordBatch.from_arrays(
            [pa.array([np.ascontiguousarray(a, dtype=k).tobytes()], pa.binary()) for a, k in zip(arrays, KINDS)],
            names=NAMES)

    for batch in text_batches(batches, CHUNK_BYTES):
        texts = [text or b"" for text in batch.column(1).to_pylist()]
        words, number = word_hashes(texts, SEPARATORS)
        docs.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        terms.append(words)
        counts.append(number)
        size += sum(map(len, texts))
        if size >= SHARD_BYTES or sum(map(len, counts)) >= SHARD_DOCS:
            yield shard()
            docs, terms, counts, size = [], [], [], 0
    if docs:
        yield shard()


def query_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query_id, term) of queries (id, text)."""
    for batch in text_batches(batches, CHUNK_BYTES):
        words, counts = word_hashes([text or b"" for text in batch.column(1).to_pylist()], SEPARATORS)
        ids, terms, at = [], [], 0
        for number, count in zip(batch.column(0).to_pylist(), counts.tolist()):
            own = np.unique(words[at:at + count]).view(np.int64)
            ids.append(np.full(len(own), number, dtype=np.int64))
            terms.append(own)
            at += count
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(ids)), pa.array(np.concatenate(terms))], names=["query_id", "term"])


def length_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of words of each shard."""
    for batch in batches:
        words = [int(np.frombuffer(lengths, np.int64).sum()) for lengths in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64())], names=["words"])


def frequency_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df) of each shard."""
    for batch in batches:
        for terms, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(terms, np.int64)),
                 pa.array(np.diff(np.frombuffer(first, np.int32)).astype(np.int64))], names=["term", "df"])


class Queries:
    """A batch of queries: (owner, place of the term in the vocabulary, idf) of their terms."""

    def __init__(self, blocks: list[pa.RecordBatch]):
        self.ids = np.concatenate([block["query_id"].to_numpy(zero_copy_only=False) for block in blocks])
        counts = np.concatenate([pc.list_value_length(block["terms"]).to_numpy(zero_copy_only=False) for block in blocks])
        terms, idf = (np.concatenate([block[name].flatten().to_numpy(zero_copy_only=False) for block in blocks])
                      for name in ("terms", "idf"))
        self.owner, self.idf = np.repeat(np.arange(len(counts)), counts), idf
        self.vocabulary, self.place = np.unique(terms.view(np.uint64), return_inverse=True)


class Bests:
    """The best documents of each query of a batch so far; empty places score -1."""

    def __init__(self, size: int, top: int):
        self.docs, self.scores = np.zeros((size, top), np.int64), np.full((size, top), -1.0)

    def take(self, rows: np.ndarray, totals: np.ndarray, docs: np.ndarray) -> None:
        """Merge the scores of the queries ``rows`` (one row each) for ``docs``."""
        top = self.docs.shape[1]
        bar = self.scores[rows, -1]
        for exact in (False, True):
            hit = (totals > 0) & (totals >= bar[:, None] - 10.0 ** -DIGITS)
            if exact or len(docs) <= top or np.count_nonzero(hit) <= 4 * top * len(rows):
                break
            bar = np.maximum(bar, np.partition(totals, -top, axis=1)[:, -top])
        row, column = np.nonzero(hit)
        touched = np.unique(rows[row])
        owner = np.append(np.repeat(touched, top), rows[row])
        docs = np.append(self.docs[touched], docs[column])
        scores = np.append(self.scores[touched], np.round(totals[row, column], DIGITS))
        order = np.lexsort((docs, -scores, owner))
        begin = np.searchsorted(owner[order], touched)
        rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
        order = order[rank < top]
        self.docs[touched] = docs[order].reshape(-1, top)
        self.scores[touched] = scores[order].reshape(-1, top)


class Shard:
    def __init__(self, row: dict, mean: float):
        self.docs, lengths, self.terms, first, posting, frequency = (
            np.frombuffer(row[name], kind) for name, kind in zip(NAMES, KINDS))
        norm = K1 * (1 - B + B * lengths / mean)
        weights = frequency * (K1 + 1) / (frequency + norm[posting])
        self.starts = np.arange(0, len(self.docs), BLOCK)
        self.df = np.diff(first)
        frequent = is_frequent(self.df, len(self.docs))
        self.number = np.where(frequent, np.cumsum(frequent) - 1, -1).astype(np.int32)
        held = np.repeat(frequent, self.df)
        self.first = np.append(0, np.cumsum(np.where(frequent, 0, self.df)))
        self.posting, self.weights = posting[~held], weights[~held]
        # The postings of frequent terms lie block by block, in a block term by term.
        number, posting, weights = np.repeat(self.number, self.df)[held], posting[held], weights[held]
        block = posting // BLOCK
        self.maxima = np.zeros((np.count_nonzero(frequent), len(self.starts)))
        np.maximum.at(self.maxima, (number, block), weights)
        order = np.argsort(block, kind="stable")
        self.begin = np.searchsorted(block[order], np.arange(len(self.starts) + 1))
        self.entries = number[order], (posting % BLOCK)[order].astype(np.int16), weights[order]

    def search(self, queries: Queries, bests: Bests) -> None:
        """Merge all documents that can be among the best of a query."""
        if not len(self.terms):
            return
        at = np.minimum(np.searchsorted(self.terms, queries.vocabulary), len(self.terms) - 1)
        at[self.terms[at] != queries.vocabulary] = -1
        place = at[queries.place]
        here = place >= 0
        owner, place, idf = queries.owner[here], place[here], queries.idf[here]
        number = self.number[place]
        rare = number < 0
        # As many queries at once as their scores, weights and rare postings have cells for.
        cells = len(self.docs) + len(np.unique(number)) + np.bincount(
            owner[rare], self.df[place[rare]], len(queries.ids))
        part = (np.cumsum(cells) // CELLS).astype(np.int64)
        edges = np.append(np.unique(part, return_index=True)[1], len(part))
        cuts = np.searchsorted(owner, edges)
        for a, b, x, y in zip(edges, edges[1:], cuts, cuts[1:]):
            self.search_part(a, b, owner[x:y] - a, place[x:y], number[x:y], idf[x:y], bests)

    def search_part(self, a: int, b: int, owner: np.ndarray, place: np.ndarray, number: np.ndarray, idf: np.ndarray,
                    bests: Bests) -> None:
        """The same for the queries from ``a`` to ``b``, whose owners count from 0."""
        size, rare = len(self.docs), number < 0
        scores = self.rare_scores(b - a, owner[rare], place[rare], idf[rare])
        used, column = np.unique(number[~rare], return_inverse=True)
        gains = np.bincount(owner[~rare] * len(used) + column, idf[~rare], (b - a) * len(used)).reshape(b - a, -1)
        bounds = np.maximum.reduceat(scores, self.starts, axis=1) + gains @ self.maxima[used]
        slot = np.full(len(self.maxima), -1)
        slot[used] = np.arange(len(used))
        for block in np.argsort(-bounds.sum(axis=0)):
            bound = bounds[:, block]
            asked = np.flatnonzero((bound > 0) & (bound >= bests.scores[a:b, -1] - 10.0 ** -DIGITS))
            if len(asked):
                begin = self.starts[block]
                totals = scores[asked, begin:begin + BLOCK]
                self.add_frequent(block, slot, asked, gains, totals)
                bests.take(a + asked, totals, self.docs[begin:begin + BLOCK])

    def rare_scores(self, count: int, owner: np.ndarray, place: np.ndarray, idf: np.ndarray) -> np.ndarray:
        """What rare terms give to each document, a few queries at a time."""
        size = len(self.docs)
        scores = np.empty((count, size))
        lengths = self.df[place]
        work = np.bincount(owner, lengths, count) + size
        part = np.cumsum(work) // STEP
        edges = np.append(np.unique(part, return_index=True)[1], count)
        cuts = np.searchsorted(owner, edges)
        for a, b, x, y in zip(edges, edges[1:], cuts, cuts[1:]):
            times = lengths[x:y]
            ends = np.cumsum(times)
            total = ends[-1] if len(ends) else 0
            at = np.repeat(self.first[place[x:y]] - (ends - times), times) + np.arange(total)
            cell = np.repeat((owner[x:y] - a) * size, times) + self.posting[at]
            gain = np.repeat(idf[x:y], times) * self.weights[at]
            scores[a:b] = np.bincount(cell, gain, (b - a) * size).reshape(b - a, size)
        return scores

    def add_frequent(self, block: int, slot: np.ndarray, asked: np.ndarray, gains: np.ndarray, totals: np.ndarray) -> None:
        """Add what the frequent terms give to the documents of a block."""
        row, doc, weight = (entry[self.begin[block]:self.begin[block + 1]] for entry in self.entries)
        row = slot[row]
        held = row >= 0
        row, doc, weight = row[held], doc[held], weight[held]
        change = np.diff(row, prepend=-1) > 0
        present, local = row[change], np.cumsum(change) - 1
        for k in range(0, len(present), TERMS):
            x, y = np.searchsorted(local, [k, k + TERMS])
            dense = np.zeros((min(TERMS, len(present) - k), totals.shape[1]))
            dense[local[x:y] - k, doc[x:y]] = weight[x:y]
            totals += gains[np.ix_(asked, present[k:k + TERMS])] @ dense


def query_batches(query_path: str) -> Iterator[Queries]:
    """The written queries in their order, in batches across files."""
    store, base = fs.FileSystem.from_uri(query_path)
    held, pairs = [], 0
    for path in sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet")):
        with store.open_input_file(path) as source:
            for block in pq.ParquetFile(source).iter_batches(batch_size=64):
                held.append(block)
                pairs += len(block["terms"].flatten())
                if sum(map(len, held)) >= QUERIES or pairs >= PAIRS:
                    yield Queries(held)
                    held, pairs = [], 0
    if held:
        yield Queries(held)


def search_task(query_path: str, mean: float, top: int):
    """(query_id, doc_id, score) of the best of the shards of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = [Shard(row, mean) for batch in batches for k in range(len(batch)) for row in batch.slice(k, 1).to_pylist()]
        for queries in query_batches(query_path) if shards else ():
            bests = Bests(len(queries.ids), top)
            for shard in shards:
                shard.search(queries, bests)
            row, rank = np.nonzero(bests.scores >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries.ids[row]), pa.array(bests.docs[row, rank]), pa.array(bests.scores[row, rank])],
                names=["query_id", "doc_id", "score"])
    return run


def search(documents: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """(query_id, rank, doc_id, score): the ``top`` documents (doc_id, text) for each query
    (query_id, text)."""
    rows = documents.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("text").cast("binary").alias("text"))
    index = written_table(rows.mapInArrow(index_task, SHARD), "index")
    asked = queries.where(F.col("query_id").isNotNull()).select(
        "query_id", F.col("text").cast("binary").alias("text"))
    terms = written_table(asked.mapInArrow(query_task, "query_id long, term long"), "terms")
    size = index.agg(F.count("*").alias("shards"), F.sum(F.octet_length("docs") / 8).alias("docs")).first()
    mean = index.select("lengths").mapInArrow(length_task, "words long").agg(F.sum("words")).first()[0]
    total = float(size["docs"] or 0)
    df = (index.select("terms", "first").mapInArrow(frequency_task, "term long, df long")
          .join(terms.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.sum("df").alias("df")))
    idf = F.log1p((F.lit(total) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    path = scratch_path(documents.sparkSession, "queries")
    (terms.join(df, "term").groupBy("query_id")
     .agg(F.sort_array(F.collect_list(F.struct("df", "term", idf.alias("idf"))), asc=False).alias("pairs"))
     .select("query_id", F.col("pairs.term").alias("terms"), F.col("pairs.idf").alias("idf"))
     .orderBy(F.slice("terms", 1, LIKENESS), "query_id")
     .write.parquet(path))
    tasks = -(-int(size["shards"]) // SHARDS_PER_TASK) or 1
    mean = (mean or 0) / total if total and mean else 1.0
    found = index.repartition(tasks).mapInArrow(
        search_task(path, mean, top), "query_id long, doc_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("query_id", "rank", "doc_id", "score"))
