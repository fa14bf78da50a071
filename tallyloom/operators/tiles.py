"""Sums of pairs of items by tiles of items, so that no pair of ratings is ever shuffled.

Items are dealt to groups by hash, and the ratings of each group are written once to the
shared scratch folder. A tile is a pair of groups ``p <= q``. Its task reads the two groups
and holds all common users of their items, so its sums are whole and it gives out only pairs
with ``common`` of them. Every user's list is thereby cut into blocks on both sides.

Ratings are ``listed`` or not; at most ``common - 1`` of an item are not. Pairs of listed
ratings of a user are gone through first, and the pairs of items that meet there are the
candidates: the caller marks ratings so that every pair with ``common`` users is one of them.
What the other ratings add to candidates is either gone through as well or looked up per
candidate, whichever is less.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.settings import scratch_path

GROUP_ROWS = 4_000_000  # ratings of a group; a task holds two groups
TILE_PAIRS = 16_000_000  # pairs of ratings that a tile should go through
BUSY_GROUPS = 32  # lists of busy users ask for at most so many groups
STEP = 1 << 19  # pairs of ratings held at once
DENSE = 8  # cells counted by place are at most so many times the pairs
LOOKUP = 4  # a lookup costs as much as going through so many pairs

ALL_SUMS = ("n", "x", "y", "xx", "yy", "xy", "min_x", "max_x", "min_y", "max_y")
SWAPPED = {"x": "y", "xx": "yy", "min_x": "min_y", "max_x": "max_y"}
SWAPPED |= {b: a for a, b in SWAPPED.items()}


class Ratings(NamedTuple):
    """Ratings in the order of (major, minor); those of ``m`` are ``first[m]:first[m + 1]``."""

    major: np.ndarray
    minor: np.ndarray
    rating: np.ndarray
    first: np.ndarray
    key: np.ndarray
    base: int

    def find(self, major: np.ndarray, minor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which exist, their places)."""
        if not len(self.key):
            return np.zeros(len(major), bool), np.zeros(0, np.int64)
        key = major * self.base + minor
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return hit, at[hit]


def in_order(major: np.ndarray, minor: np.ndarray, rating: np.ndarray, majors: int, minors: int) -> Ratings:
    key = major * max(minors, 1) + minor
    order = np.argsort(key)
    major = major[order]
    first = np.searchsorted(major, np.arange(majors + 1))
    return Ratings(major, minor[order], rating[order], first, key[order], max(minors, 1))


def pieces(starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(k, place) for all places ``starts[k]`` to ``starts[k] + counts[k]``, in pieces."""
    ends = np.cumsum(counts)
    shift = starts - (ends - counts)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, STEP):
        end = min(begin + STEP, total)
        low, high = np.searchsorted(ends, [begin, end - 1], side="right")
        here = np.minimum(ends[low:high + 1], end) - np.maximum((ends - counts)[low:high + 1], begin)
        owner = np.repeat(np.arange(low, high + 1), here)
        yield owner, np.arange(begin, end) + shift[owner]


def codes(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """(sorted distinct values, place of each row's value among them)."""
    found = column.combine_chunks().dictionary_encode()
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
    order = pc.sort_indices(found.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return found.dictionary.take(order), rank[found.indices.to_numpy()]


class Sums:
    """Sums of slots, each of a pair of items."""

    def __init__(self, names: tuple[str, ...], size: int):
        empty = {"n": 0.0, "min": np.nan, "max": -np.inf}
        self.of = {name: np.full(size, empty.get(name[:3], 0.0)) for name in names}
        self.size = size

    def add(self, slot: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        value = {"x": x, "y": y}
        for name, total in self.of.items():
            if name == "n":
                total += np.bincount(slot, minlength=self.size)
            elif name.startswith("min_"):
                np.fmin.at(total, slot, value[name[4:]])
            elif name.startswith("max_"):
                np.maximum.at(total, slot, value[name[4:]])
            else:
                factors = value[name[0]] if len(name) == 1 else value[name[0]] * value[name[1]]
                total += np.bincount(slot, factors, self.size)


class Tile:
    """The items ``i`` of one group against the items ``j`` of another, or of the same."""

    def __init__(self, left: pa.Table, right: pa.Table, same: bool):
        self.same = same
        users, number = codes(pa.chunked_array(left["user_id"].chunks + right["user_id"].chunks, left["user_id"].type))
        self.values, item = codes(pa.chunked_array(left["item_id"].chunks + right["item_id"].chunks, left["item_id"].type))
        self.of_i, i = np.unique(item[:len(left)], return_inverse=True)
        self.of_j, j = np.unique(item[len(left):], return_inverse=True)
        u, v = number[:len(left)], number[len(left):]
        x, y = (side["rating"].to_numpy() for side in (left, right))
        a, b = (side["listed"].to_numpy().astype(bool) for side in (left, right))
        n, width = len(users), len(self.of_j)
        self.width = width
        self.left = {k: in_order(i[a == k], u[a == k], x[a == k], len(self.of_i), n) for k in (True, False)}
        self.right = {k: in_order(v[b == k], j[b == k], y[b == k], n, width) for k in (True, False)}
        self.right_by_item = in_order(j[~b], v[~b], y[~b], width, n)

    def met(self, mine: bool, theirs: bool, begin: int, end: int) -> tuple[np.ndarray, ...]:
        """(place on the left, first place on the right, number) of the pairs of the items
        ``begin`` to ``end``."""
        left, right = self.left[mine], self.right[theirs]
        entries = np.arange(left.first[begin], left.first[end])
        user = left.minor[entries]
        return entries, right.first[user], right.first[user + 1] - right.first[user]

    def pairs(self, mine: bool, theirs: bool, begin: int, end: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(key, x, y) of the pairs of the items ``begin`` to ``end``."""
        left, right = self.left[mine], self.right[theirs]
        entries, starts, counts = self.met(mine, theirs, begin, end)
        for owner, place in pieces(starts, counts):
            entry = entries[owner]
            i, j = left.major[entry], right.minor[place]
            x, y = left.rating[entry], right.rating[place]
            if self.same:
                keep = i < j
                i, j, x, y = i[keep], j[keep], x[keep], y[keep]
            yield i * self.width + j, x, y

    def chunks(self) -> Iterator[tuple[int, int, int]]:
        """(begin, end, pairs) of items whose listed pairs are few enough, or of one item."""
        _, _, counts = self.met(True, True, 0, len(self.of_i))
        of_item = np.bincount(self.left[True].major, counts, len(self.of_i)).astype(np.int64)
        ends = np.cumsum(of_item)
        begin = done = 0
        while begin < len(ends):
            end = max(int(np.searchsorted(ends, done + STEP, side="right")), begin + 1)
            if ends[end - 1] > done:
                yield begin, end, int(ends[end - 1] - done)
            begin, done = end, int(ends[end - 1])

    def sums(self, begin: int, end: int, listed: int, common: int, names: tuple[str, ...]):
        """(i, j, sums) of all pairs with ``common`` users."""
        held = list(self.pairs(True, True, begin, end)) if listed <= STEP else None

        def listed_pairs():
            return held or self.pairs(True, True, begin, end)

        cells, first = (end - begin) * self.width, begin * self.width
        dense = held is None or cells <= DENSE * listed
        if dense:
            met = np.zeros(cells, np.int64)
            for key, _, _ in listed_pairs():
                met += np.bincount(key - first, minlength=cells)
            cell = np.flatnonzero(met)
            keys, met = cell + first, met[cell]
        else:
            keys, met = np.unique(np.concatenate([key for key, _, _ in held]), return_counts=True)
        few = np.diff(self.left[False].first), np.diff(self.right_by_item.first)
        missing = few[0][keys // self.width] + few[1][keys % self.width]
        alive = met + missing >= common
        keys, missing = keys[alive], missing[alive]
        total = Sums(names, len(keys))
        if dense:
            number = np.full(cells, -1, np.int32)
            number[keys - first] = np.arange(len(keys))

        def add(key: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
            if dense:
                slot = number[key - first]
                hit = slot >= 0
            else:
                slot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[slot] == key
            total.add(slot[hit], x[hit], y[hit])

        if len(keys):
            for pairs in listed_pairs():
                add(*pairs)
            others = [(mine, theirs) for mine, theirs in ((True, False), (False, True), (False, False))]
            rest = sum(int(self.met(*kinds, begin, end)[2].sum()) for kinds in others)
            if rest <= LOOKUP * missing.sum():
                for kinds in others:
                    for pairs in self.pairs(*kinds, begin, end):
                        add(*pairs)
            else:
                self.look_up(keys, total)
        found = np.flatnonzero(total.of["n"] >= common)
        return keys[found] // self.width, keys[found] % self.width, {k: v[found] for k, v in total.of.items()}

    def look_up(self, keys: np.ndarray, total: Sums) -> None:
        """Add to the pairs of items what ratings that are not listed give with any other: from
        those of ``i`` first, then from those of ``j`` with the listed ones of ``i``."""
        i, j = keys // self.width, keys % self.width
        mine, theirs = self.left[False], self.right_by_item
        for owner, place in pieces(mine.first[i], np.diff(mine.first)[i]):
            for right in self.right.values():
                hit, at = right.find(mine.minor[place], j[owner])
                total.add(owner[hit], mine.rating[place[hit]], right.rating[at])
        for owner, place in pieces(theirs.first[j], np.diff(theirs.first)[j]):
            hit, at = self.left[True].find(i[owner], theirs.minor[place])
            total.add(owner[hit], self.left[True].rating[at], theirs.rating[place[hit]])

    def batch(self, i: np.ndarray, j: np.ndarray, sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        one, two = self.of_i[i], self.of_j[j]
        turned = one > two
        arrays = [self.values.take(pa.array(np.where(turned, two, one))), self.values.take(pa.array(np.where(turned, one, two)))]
        for name, own in sums.items():
            value = np.where(turned, sums[SWAPPED[name]], own) if name in SWAPPED else own
            arrays.append(pa.array(value.astype(np.int64) if name == "n" else value))
        return pa.RecordBatch.from_arrays(arrays, names=["item_a", "item_b", *sums])


def tile_at(number: int, groups: int) -> tuple[int, int]:
    """Tiles ``p <= q`` in the order of p, then q."""
    p = 0
    while number >= groups - p:
        number -= groups - p
        p += 1
    return p, p + number


def tile_task(path: str, groups: int, common: int, names: tuple[str, ...]):
    def read(group: int) -> pa.Table:
        store, base = fs.FileSystem.from_uri(path)
        found = store.get_file_info(fs.FileSelector(f"{base}/of={group}", allow_not_found=True))
        files = sorted(f.path for f in found if f.path.endswith(".parquet"))
        if not files:
            return None
        return ds.dataset(files, filesystem=store, format="parquet").to_table(use_threads=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_group = left = None
        for batch in batches:
            for number in batch.column(0).to_pylist():
                p, q = tile_at(number, groups)
                if p != left_group:
                    left_group, left = p, read(p)
                right = left if p == q else read(q)
                if left is None or right is None:
                    continue
                tile = Tile(left, right, p == q)
                for chunk in tile.chunks():
                    i, j, sums = tile.sums(*chunk, common, names)
                    if len(i):
                        yield tile.batch(i, j, sums)
    return run


def summed(marked: DataFrame, common: int, busy_degree: int, names: tuple[str, ...] = ALL_SUMS) -> DataFrame:
    """(item_a, item_b, the named sums) of all pairs with ``common`` users that also meet in
    listed ratings. ``marked`` is (user_id, item_id, rating, listed), without NULL."""
    spark = marked.sparkSession
    degree = F.count("*")
    size = (marked.groupBy("user_id").agg(degree.alias("n"))
            .agg(F.sum("n").alias("rows"), F.max("n").alias("most"), F.sum(F.col("n") * (F.col("n") - 1.0) / 2).alias("pairs")).first())
    rows, most, pairs = int(size["rows"] or 0), int(size["most"] or 0), float(size["pairs"] or 0)
    groups = max(-(-rows // GROUP_ROWS), int(np.ceil(np.sqrt(2 * pairs / TILE_PAIRS))), 1,
                 min(-(-2 * most // busy_degree), BUSY_GROUPS) if most > busy_degree else 1)
    path = scratch_path(spark, "groups")
    group = F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int")
    # Four files of a group, so that an item with many ratings is written by several tasks.
    (marked.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"), "listed", group.alias("of"))
     .repartition(4 * groups, "of", F.pmod(F.xxhash64("user_id"), F.lit(4)))
     .write.partitionBy("of").parquet(path))
    tiles = groups * (groups + 1) // 2
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    tasks = min(tiles, max(parts, int(pairs // TILE_PAIRS) + 1))
    item = marked.schema["item_id"].dataType.simpleString()
    kinds = [f"{name} {'long' if name == 'n' else 'double'}" for name in names]
    return spark.range(0, tiles, 1, tasks).mapInArrow(
        tile_task(path, groups, common, names), ", ".join([f"item_a {item}", f"item_b {item}", *kinds]))
