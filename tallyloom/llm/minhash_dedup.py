"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find.

*Sets.* Words are split at ASCII white space after lower-casing A-Z; a document is the set of
its 5-word shingles, each a 64-bit hash. With fewer words the whole sequence is the only one.

*Signatures.* In SuperMinHash every element carries a random permutation of the slots and a
uniform number per step: at step ``j`` it offers ``j + u`` to the slot at place ``j`` of its
permutation. Ranks are correlated, which lowers the variance, and once every slot holds less
than ``j + 1`` no later step can change anything: a document of a few hundred shingles stops
after three or four of 128 steps.

*Grouping.* Documents with equal sets form a class, and only its smallest id goes on. Classes
that share a band are tied to the smallest class there; what hangs together by such ties is a
group that may hold links, and nothing outside it can. The members of a group then meet with
their full sets, whether or not they share a band themselves: every link counts, but only a
spanning forest is written. A large group is cut into blocks that meet two by two. Components
come from a union-find inside each task and smallest-label rounds between tasks.

Four slots a band and 32 bands miss a pair at the threshold of 0.75 with a probability of
5e-6, and fewer above it.

Defined cases: no text or no words give an empty set, linked with nothing; rows that repeat
a doc_id are one vertex with the links of all of them; a NULL doc_id counts as the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import mixed, powers, shuffle_parts, text_batches
from tallyloom.settings import written_table

NULL_ID = -(1 << 63)

WORDS_PER_SHINGLE = 5
SLOTS = 128
BAND_SLOTS = 4
BANDS = SLOTS // BAND_SLOTS
SIMILAR, OF = 75, 100  # linked: OF * intersection >= SIMILAR * union
CHUNK_BYTES = 1 << 20
BLOCK_SHINGLES = 300_000
POSTINGS_AT_ONCE = 1 << 17
ELEMENTS_AT_ONCE = 1 << 15

WORD_BASE, WORD_INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
SHINGLE_BASE = 0xD1342543DE82EF95
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64))


# --- shingles ------------------------------------------------------------------------


def word_hashes(texts: list[bytes], separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and the number of words of each; ``separators`` says
    of each byte whether it parts words."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    space = separators[data]
    edge = np.diff(space.astype(np.int8), prepend=1)
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[LOWER[data]] * powers(WORD_BASE, len(data)), out=total[1:])
    down = powers(WORD_INVERSE, len(data))
    hashes = mixed((total[end] - total[begin]) * down[begin])
    counts = np.diff(np.searchsorted(begin, np.append(0, np.cumsum(sizes))))
    return hashes, counts


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(texts)
    sets, at = [], 0
    factors = powers(SHINGLE_BASE, WORDS_PER_SHINGLE)
    if len(words) >= WORDS_PER_SHINGLE:
        long = len(words) - WORDS_PER_SHINGLE + 1
        shingles = np.zeros(long, dtype=np.uint64)
        for step, factor in enumerate(factors):
            shingles += words[step:step + long] * factor
        shingles = mixed(shingles)
    for count in counts.tolist():
        if count >= WORDS_PER_SHINGLE:
            sets.append(np.unique(shingles[at:at + count - WORDS_PER_SHINGLE + 1]))
        elif count:
            whole = (words[at:at + count] * factors[:count]).sum(dtype=np.uint64)
            sets.append(mixed(np.array([whole + np.uint64(count)], dtype=np.uint64)))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
        at += count
    return sets


# --- signatures ----------------------------------------------------------------------


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash signatures of some non-empty sets, one row of SLOTS numbers each."""
    best = np.full((len(sets), SLOTS), np.inf)
    begin, held = 0, 0
    for k, found in enumerate(sets):
        held += len(found)
        if held >= ELEMENTS_AT_ONCE or k == len(sets) - 1:
            offer(best[begin:k + 1], sets[begin:k + 1])
            begin, held = k + 1, 0
    return best


def offer(best: np.ndarray, sets: list[np.ndarray]) -> None:
    for part in range(0, max(map(len, sets)), ELEMENTS_AT_ONCE):
        pieces = [found[part:part + ELEMENTS_AT_ONCE] for found in sets]
        owner = np.repeat(np.arange(len(pieces)), [len(piece) for piece in pieces])
        elements = np.concatenate(pieces)
        offer_steps(best, owner, elements)


def offer_steps(best: np.ndarray, owner: np.ndarray, elements: np.ndarray) -> None:
    places = np.empty((len(elements), SLOTS), dtype=np.uint8)
    places[:] = np.arange(SLOTS, dtype=np.uint8)
    flat_best, flat_places = best.reshape(-1), places.reshape(-1)
    row = np.arange(len(elements)) * SLOTS
    for step in range(SLOTS):
        drawn = mixed(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        swap = step + ((drawn & np.uint64(0xFFFFFF)) * np.uint64(SLOTS - step) >> np.uint64(24)).astype(np.int64)
        value = step + (drawn >> np.uint64(24)).astype(np.float64) / float(1 << 40)
        chosen = flat_places[row + swap]
        flat_places[row + swap] = flat_places[row + step]
        flat_places[row + step] = chosen
        np.minimum.at(flat_best, owner * SLOTS + chosen, value)
        open_ = best.max(axis=1) >= step + 1  # a later step can still improve these
        if not open_.any():
            return
        stay = open_[owner]
        if not stay.all():
            owner, elements, row = owner[stay], elements[stay], row[stay]
            if not len(elements):
                return


def band_hashes(best: np.ndarray) -> np.ndarray:
    bits = np.ascontiguousarray(best).view(np.uint64).reshape(len(best), BANDS, BAND_SLOTS)
    total = np.zeros((len(best), BANDS), dtype=np.uint64)
    for slot in range(BAND_SLOTS):
        total = mixed(total * np.uint64(SHINGLE_BASE) + bits[:, :, slot])
    return mixed(total + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


# --- tasks ---------------------------------------------------------------------------

SIGNED = f"node long, n_shingles long, digest_a long, digest_b long, bands array<long>"


def sign_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the size and a 128-bit digest of its set, and its band hashes."""
    for batch in text_batches(batches, CHUNK_BYTES):
        sets = shingle_sets([text or b"" for text in batch.column(1).to_pylist()])
        lengths = np.array([len(found) for found in sets], dtype=np.int64)
        digests = np.zeros((2, len(sets)), dtype=np.uint64)
        hashes = np.zeros((len(sets), BANDS), dtype=np.int64)
        filled = np.flatnonzero(lengths)
        if len(filled):
            some = [sets[k] for k in filled]
            joined, at = np.concatenate(some), np.cumsum(lengths[filled]) - lengths[filled]
            digests[0, filled] = np.add.reduceat(mixed(joined * np.uint64(3)), at)
            digests[1, filled] = np.bitwise_xor.reduceat(mixed(joined + np.uint64(9)), at)
            hashes[filled] = band_hashes(signatures(some))
        offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(lengths), *[pa.array(row.view(np.int64)) for row in digests],
            pa.ListArray.from_arrays(offsets, pa.array(hashes.reshape(-1))),
        ], names=["node", "n_shingles", "digest_a", "digest_b", "bands"])


class UnionFind:
    """Roots are smallest members."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (above := self.parent.setdefault(root, root)) != root:
            root = above
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, a: int, b: int) -> bool:
        x, y = self.find(a), self.find(b)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def common_shingles(mine: np.ndarray, begin: np.ndarray, posting: np.ndarray, count: int) -> np.ndarray:
    """How many of some shingles each set has, over a part of their postings at a time."""
    common = np.zeros(count, dtype=np.int64)
    total = int((begin[mine + 1] - begin[mine]).sum(dtype=np.int64))
    step = max(len(mine) * POSTINGS_AT_ONCE // max(total, 1), 1)
    for part in range(0, len(mine), step):
        some = mine[part:part + step]
        lengths = begin[some + 1] - begin[some]
        ends = np.cumsum(lengths)
        at = np.repeat(begin[some] - (ends - lengths), lengths) + np.arange(ends[-1])
        common += np.bincount(posting[at], minlength=count)
    return common


def spanning_links(sets: list[np.ndarray], side: np.ndarray, crossing: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links between some sets; with ``crossing`` only links between
    sets of side 0 and side 1 count.

    Intersections of one set with all others are counted at once over an inverted index.
    Any link between two components has an end outside the largest one, so sets inside it are
    passed over, and a group of mutual copies is done after one step. Which component is the
    largest may change, so what was passed over and lies outside the final one is taken up.
    """
    count = len(sets)
    sizes = np.array([len(found) for found in sets], dtype=np.int64)
    _, dims, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[dims] > 1  # what one set has alone is in no intersection
    owner = np.repeat(np.arange(count, dtype=np.int32), sizes)[shared]
    dims = dims[shared].astype(np.int32)
    first = np.searchsorted(owner, np.arange(count + 1))
    posting = owner[np.argsort(dims, kind="stable")]
    begin = np.zeros(len(seen) + 1, dtype=np.int32)
    np.cumsum(np.bincount(dims, minlength=len(seen)), out=begin[1:])
    del owner, shared, seen
    root = np.arange(count)
    members = np.ones(count, dtype=np.int64)
    largest, links = 0, []
    taken = np.zeros(count, dtype=bool)
    waiting = np.argsort(-np.diff(first), kind="stable")
    while len(waiting):
        for k in waiting.tolist():
            if root[k] == root[largest] and members[root[k]] > 1:
                continue
            taken[k] = True
            common = common_shingles(dims[first[k]:first[k + 1]], begin, posting, count)
            near = OF * common >= SIMILAR * (sizes + sizes[k] - common)
            near &= root != root[k]
            if crossing:
                near &= side != side[k]
            for other in np.flatnonzero(near).tolist():
                if root[other] != root[k]:
                    links.append((k, other))
                    old, new = root[other], root[k]
                    root[root == old] = new
                    members[new] += members[old]
                    if members[new] > members[root[largest]]:
                        largest = k
        waiting = waiting[~taken[waiting] & (root[waiting] != root[largest])]
    return links


UNIT = "grp long, low int, high int"


def verify_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each unit: rows (group, low block, high block, own block, node, text) of a unit
    follow each other."""
    unit, nodes, sides, sets = None, [], [], []

    def links() -> pa.RecordBatch:
        found = []
        if len(nodes) > 1:
            side = np.array(sides)
            found = spanning_links(sets, side, unit[1] != unit[2])
        return pa.RecordBatch.from_arrays(
            [pa.array([nodes[a] for a, _ in found], pa.int64()),
             pa.array([nodes[b] for _, b in found], pa.int64())], names=["a", "b"])

    for batch in text_batches(batches, CHUNK_BYTES):
        made = shingle_sets([text or b"" for text in batch.column(5).to_pylist()])
        columns = [batch.column(k).to_pylist() for k in range(5)]
        for group, low, high, block, node, found in zip(*columns, made):
            if (group, low, high) != unit:
                if unit is not None:
                    yield links()
                unit, nodes, sides, sets = (group, low, high), [], [], []
            nodes.append(node)
            sides.append(block)
            sets.append(found)
    if unit is not None:
        yield links()


# --- components ----------------------------------------------------------------------


def contract_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars around the smallest member: a union-find of what the
    task holds, flushed when it has grown."""
    held = UnionFind()

    def stars() -> pa.RecordBatch:
        rows = [(node, root) for node in list(held.parent) if (root := held.find(node)) != node]
        return pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in rows], pa.int64()) for k in (0, 1)], names=["node", "root"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.join(a, b)
        if len(held.parent) > 1_000_000:
            yield stars()
            held = UnionFind()
    yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b) that are not their component's
    smallest. Each round contracts inside tasks, then ties all roots of a node to the
    smallest one; rounds end when each node has a single root that is nobody's node."""
    stars = written_table(edges.mapInArrow(contract_task, "node long, root long"), "stars")
    while True:
        least = stars.groupBy("node").agg(F.min("root").alias("least"))
        # A node's other roots belong to the smallest; a root's own root is followed next round.
        tied = stars.join(least, "node")
        pairs = tied.select(F.col("root").alias("a"), F.col("least").alias("b")).where("a <> b").unionAll(
            least.select(F.col("node").alias("a"), F.col("least").alias("b")))
        up = least.select(F.col("node").alias("root"), F.col("least").alias("above"))
        open_ = stars.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node").unionAll(
            stars.join(up, "root").select("node")).limit(1)
        if not open_.count():
            return stars
        jumped = pairs.join(up.select(F.col("root").alias("b"), "above"), "b", "left").select(
            "a", F.coalesce("above", "b").alias("b"))
        stars = written_table(
            jumped.where("a <> b").mapInArrow(contract_task, "node long, root long").distinct(), "stars")


# --- the operator --------------------------------------------------------------------


def star_pairs(banded: DataFrame) -> DataFrame:
    """Each class next to the smallest class of each of its buckets."""
    centres = (banded.groupBy("hash").agg(F.min("node").alias("a"), F.count("*").alias("n"))
               .where("n > 1").select("hash", "a"))
    return (banded.join(centres, "hash").where(F.col("node") != F.col("a"))
            .select("a", F.col("node").alias("b")).distinct())


def units(groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """(grp, low, high, block, node): the units in which the members of a group meet. A group
    of more than BLOCK_SHINGLES is cut into blocks, and each two blocks meet in a unit."""
    members = groups.join(sizes, "node")
    blocks = members.groupBy("grp").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (members.join(blocks, "grp").withColumn("block", block)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("grp", F.least("block", "other").alias("low"),
                    F.greatest("block", "other").alias("high"), "block", "node"))


def verified(met: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """A spanning forest of the links within each unit, confirmed on the full sets."""
    rows = docs.join(met, "node").select("grp", "low", "high", "block", "node", "text")
    key = ["grp", "low", "high"]
    return (rows.repartition(parts, *key).sortWithinPartitions(*key, "node")
            .mapInArrow(verify_task, "a long, b long"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents`` (doc_id, text)."""
    node = F.coalesce("doc_id", F.lit(NULL_ID)).alias("node")
    docs = documents.select(node, F.col("text").cast("binary").alias("text"))
    signed = written_table(docs.mapInArrow(sign_task, SIGNED), "signatures")
    key = ["n_shingles", "digest_a", "digest_b"]
    classes = written_table(
        signed.where("n_shingles > 0").groupBy(*key)
        .agg(F.min(F.struct("node", "bands")).alias("first")).select(*key, "first.*"), "classes")
    banded = classes.select("node", F.explode("bands").alias("hash"))
    together = components(star_pairs(banded))
    groups = together.select("node", F.col("root").alias("grp"))
    groups = groups.unionAll(together.select(F.col("root").alias("node"), F.col("root").alias("grp")).distinct())
    met = written_table(units(groups, classes.select("node", "n_shingles")), "units")
    roots = components(verified(met, docs, shuffle_parts(documents.sparkSession)))
    grouped = classes.select(*key, "node").join(roots, "node", "left").select(
        *key, F.coalesce("root", "node").alias("component"))
    component = F.coalesce("component", "node")
    return signed.select("node", *key).join(grouped, key, "left").select(
        F.nullif("node", F.lit(NULL_ID)).alias("doc_id"), "n_shingles",
        F.nullif(component, F.lit(NULL_ID)).alias("component_id"),
        (F.col("node") == component).alias("kept"))
