"""Phrases whose words occur together more often than by chance, per language.

Words are counted first. Then, level by level, phrases of one more word are counted:

* **Candidates** are Apriori-safe: both phrases of one word less that a candidate consists
  of must pass a filter that holds all frequent ones, and so must the candidate itself. For
  that its occurrences are counted by hash: tasks add up what they hold, and deal hashes
  with their numbers to parts. A filter by hash may let too much pass, never too little, so
  results do not depend on sizes of filters.
* **Counts.** A task adds up the candidates of its texts and deals them out, with their
  numbers, to parts of all phrases. For each part a trie, a double array over word numbers,
  takes in the phrases of all tasks: the states of all phrases move on at once, one word at
  a time, and accepting states are added up. What no trie of the part accepts is new and
  makes the next one, so that tries have a bounded size. Each phrase goes to one part only,
  and the texts are read twice for each level, however many candidates there are.

Filters are bit sets of at most 2^MOST_BITS bits, and so bounded as well. Everything else
stays distributed. Texts of any length are read in slices that overlap by the words a phrase
may reach beyond them.

Defined cases: a NULL or empty text has no words, a NULL language is "und". Rows with NULL
or repeated ids count like others; an empty table gives no rows; further columns of the
input are not read. A phrase is its words joined by a blank.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import mixed, powers, shuffle_parts, text_batches
from tallyloom.settings import written_table

NO_LANG = "und"
CHUNK_BYTES = 2 << 20
HELD_ROWS = 400_000
# A trie holds about so many phrases and bytes of phrases at most; the tries of a part, which
# take about TRIE_WEIGHT bytes a phrase, hold about GROUP_BYTES.
TRIE_PHRASES = 250_000
TRIE_BYTES = 8 << 20
TRIE_WEIGHT = 24
GROUP_BYTES = 20 << 20
LEAST_PARTS, MOST_PARTS = 64, 1 << 20
# Hashes: how many a task holds and a part gets, the bounds of the parts' number, the largest
# count that is told from others.
HELD_HASHES, PART_HASHES = 2_000_000, 1_000_000
LEAST_PART_BITS, MOST_PART_BITS = 6, 13
MOST_COUNT = 255
# Bit sets: bits per hash, bounds of their number, and a factor for each bit that a hash sets.
HASH_BITS, LEAST_BITS, MOST_BITS = 16, 16, 28
PROBES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)

# Kinds of bytes: part of a word, between words, end of a piece.
WORD, BLANK, CUT = 0, 1, 2
KIND = np.zeros(256, dtype=np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = CUT
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BETWEEN = rb"\x20\x09.,;:!?\x0A-\x0D"


# --- words of texts ----------------------------------------------------------------

@dataclass
class Slice:
    """Words of a slice of text of one language: the different words, the number of each
    word in order, the piece it is in, and how many words the slice owns; those behind are
    there for phrases that begin in the slice."""

    lang: str
    words: pa.Array
    codes: np.ndarray
    piece: np.ndarray
    own: int

    def linked(self) -> np.ndarray:
        """Whether the next word is in the same piece."""
        out = np.zeros(len(self.codes), dtype=bool)
        out[:-1] = self.piece[1:] == self.piece[:-1]
        return out


def split_words(lang: str, data: np.ndarray, texts: np.ndarray, limit: int) -> Slice | None:
    """``texts`` are the places where texts begin; words from ``limit`` on are not owned."""
    kind = KIND[data]
    word = kind == WORD
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    begins[texts] = word[texts]
    ends[:-1] &= ~word[1:]
    ends[texts[1:] - 1] = word[texts[1:] - 1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return None
    offsets = np.concatenate(([0], np.cumsum(np.flatnonzero(ends) + 1 - starts))).astype(np.int32)
    array = pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[word]])])
    encoded = array.dictionary_encode()
    piece = np.cumsum(kind == CUT, dtype=np.int32)[starts] + np.searchsorted(texts, starts, side="right")
    return Slice(lang, encoded.dictionary, encoded.indices.to_numpy(), piece,
                 int(np.searchsorted(starts, limit)))


def slices(batches: Iterator[pa.RecordBatch], ahead: int) -> Iterator[Slice]:
    """Slices of (lang, text) batches, with ``ahead`` words behind a text that is cut."""
    more = re.compile(b"(?:[%b]*[^%b]+){0,%d}" % (BETWEEN, BETWEEN, ahead))
    between = re.compile(b"[%b]" % BETWEEN)
    for batch in text_batches(batches, CHUNK_BYTES):
        langs = batch.column(0).fill_null(NO_LANG)
        texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
        for lang in langs.unique().to_pylist():
            some = texts.filter(pc.equal(langs, lang))
            sizes = pc.binary_length(some).to_numpy(zero_copy_only=False)
            if len(some) == 1 and sizes[0] > CHUNK_BYTES:
                yield from cut_text(lang, some[0].as_py(), between, more)
                continue
            some = some.filter(pa.array(sizes > 0))
            sizes = sizes[sizes > 0]
            if len(some):
                data = np.frombuffer(b"".join(some.to_pylist()), dtype=np.uint8)
                found = split_words(lang, data, np.cumsum(sizes) - sizes, len(data))
                if found:
                    yield found


def cut_text(lang: str, text: bytes, between: re.Pattern, more: re.Pattern) -> Iterator[Slice]:
    begin = 0
    while begin < len(text):
        cut = between.search(text, begin + CHUNK_BYTES)
        end = cut.start() if cut else len(text)
        seen = more.match(text, end).end()
        data = np.frombuffer(text, dtype=np.uint8)[begin:seen]
        found = split_words(lang, data, np.zeros(1, dtype=np.int64), end - begin)
        if found:
            yield found
        begin = end


class Gathered:
    """Rows of a task by (lang, phrase) with their number, added up while they are held; with
    the part each phrase is dealt to, if it is."""

    def __init__(self, dealt: bool = False):
        self.columns = ["lang", "phrase", "n"] + (["part"] if dealt else [])
        self.parts: list[pa.Table] = []
        self.rows, self.least = 0, HELD_ROWS

    def add(self, lang: str, phrases: pa.Array, counts: np.ndarray, dealt: np.ndarray | None = None) -> None:
        columns = [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(phrases), dtype=np.int64))),
                   phrases.view(pa.string()), pa.array(counts, pa.int64())]
        columns += [] if dealt is None else [pa.array(dealt, pa.int32())]
        self.parts.append(pa.table(columns, names=self.columns))
        self.rows += len(phrases)

    def full(self) -> bool:
        """Whether too many rows are held even when added up. Adding up again pays only
        once as much has come in as was left."""
        if self.rows <= self.least:
            return False
        self.merge()
        self.least = self.rows + HELD_ROWS
        return self.rows > HELD_ROWS

    def merge(self) -> None:
        table = pa.concat_tables(self.parts).group_by(["lang", "phrase"], use_threads=False).aggregate(
            [("n", "sum"), *[(name, "max") for name in self.columns[3:]]])
        self.parts = [table.rename_columns({"n_sum": "n", **{f"{name}_max": name for name in self.columns[3:]}})
                      .select(self.columns)]
        self.rows = table.num_rows

    def flush(self, most: int = 50_000) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.merge()
            yield from self.parts[0].combine_chunks().to_batches(max_chunksize=most)
        self.parts, self.rows, self.least = [], 0, HELD_ROWS


def word_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words."""
    held = Gathered()
    for part in slices(batches, 0):
        counts = np.bincount(part.codes[:part.own], minlength=len(part.words))
        held.add(part.lang, part.words, counts)
        if held.full():
            yield from held.flush()
    yield from held.flush()


# --- filters by hash ---------------------------------------------------------------

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    """A hash of each word and the language."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1]
    low = int(offsets[0])
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[low:offsets[-1]] if len(words) else \
        np.zeros(0, dtype=np.uint8)
    offsets = offsets.astype(np.int64) - low
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)))
    back = powers(INVERSE, len(data) + 1)[offsets[:-1]]
    salt = np.uint64(int.from_bytes(lang.encode(), "little") * BASE % (1 << 64))
    return mixed((sums[offsets[1:]] - sums[offsets[:-1]]) * back ^ salt)


def extended(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases that go on by one word."""
    return mixed(hashes * np.uint64(0xD6E8FEB86659FD93) + last)


def phrase_hashes(phrases: pa.Array, langs: pa.Array) -> np.ndarray:
    """The same hashes from phrases in one string."""
    out = np.zeros(len(phrases), dtype=np.uint64)
    for lang in langs.unique().to_pylist():
        here = pc.equal(langs, lang)
        words = pc.split_pattern(phrases.filter(here).cast(pa.string()), " ")
        encoded = words.flatten().cast(pa.binary()).dictionary_encode()
        hashes = word_hashes(encoded.dictionary, lang)[encoded.indices.to_numpy()]
        width = len(hashes) // max(len(words), 1)
        hashes = hashes.reshape(-1, width)
        found = hashes[:, 0]
        for k in range(1, width):
            found = extended(found, hashes[:, k])
        out[here.to_numpy(zero_copy_only=False)] = found
    return out


def part_bits(count: int) -> int:
    """Leading bits of a hash that number its part, for ``count`` hashes."""
    return min(max((count // PART_HASHES).bit_length(), LEAST_PART_BITS), MOST_PART_BITS)


def keys_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits behind those of the part."""
    return (hashes >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)


def probe(keys: np.ndarray, factor: int, width: int) -> np.ndarray:
    """The bit of 2^width that a key sets for a factor."""
    return ((keys * np.uint64(factor)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - width)


@dataclass
class BitSet:
    """Hashes, each by several bits in the range of its part: 2^width bits for each part."""

    bits: int
    width: int
    data: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), dtype=bool)
        part = hashes >> np.uint64(64 - self.bits) << np.uint64(self.width)
        keys = keys_of(hashes, self.bits)
        at = np.arange(len(hashes))
        for factor in PROBES:
            bit = part | probe(keys, factor, self.width)
            on = (self.data[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, part, keys = at[on], part[on], keys[on]
        out[at] = True
        return out


HashSource = Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]
DEALT = "part int, keys binary, counts binary"
KEPT = "part int, n long, keys binary"


def runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return begins, np.append(begins[1:], len(key)) if len(key) else begins


def binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut at ``ends``."""
    offsets = (np.concatenate(([0], ends)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def numbers_in(column: pa.Array, row: int, kind: type) -> np.ndarray:
    return np.frombuffer(column[row].as_buffer(), dtype=kind)


def deal_task(source: HashSource, bits: int, least: int):
    """Different hashes with their number, ``least`` at most, in a row for each part."""

    def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.sort(np.concatenate(held))
        begins, ends = runs(hashes)
        counts = np.minimum(ends - begins, least).astype(np.uint8)
        hashes = hashes[begins]
        part = (hashes >> np.uint64(64 - bits)).astype(np.int32)
        begins, ends = runs(part)
        return pa.RecordBatch.from_arrays(
            [pa.array(part[begins]), binaries(keys_of(hashes, bits).astype(np.uint32), ends), binaries(counts, ends)],
            names=["part", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for hashes in source(batches):
            held.append(hashes)
            rows += len(hashes)
            if rows > HELD_HASHES:
                yield dealt(held)
                held, rows = [], 0
        if rows:
            yield dealt(held)

    return run


def keep_task(least: int):
    """Of rows sorted by part, the hashes that all tasks together have ``least`` times."""

    def kept(part: int, keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate(keys).astype(np.uint64) << np.uint64(8) | np.concatenate(counts).astype(np.uint64)
        both.sort()
        key = both >> np.uint64(8)
        begins, _ = runs(key)
        full = np.add.reduceat((both & np.uint64(255)).astype(np.int64), begins) >= least
        found = key[begins[full]].astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([len(found)], pa.int64()), pa.array([found.tobytes()], pa.binary())],
            names=["part", "n", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, counts = None, [], []
        for batch in batches:
            for row, new in enumerate(batch.column(0).to_pylist()):
                if keys and new != part:
                    yield kept(part, keys, counts)
                    keys, counts = [], []
                part = new
                keys.append(numbers_in(batch.column(1), row, np.uint32))
                counts.append(numbers_in(batch.column(2), row, np.uint8))
        if keys:
            yield kept(part, keys, counts)

    return run


def bits_task(width: int):
    """The bits of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in enumerate(batch.column(0).to_pylist()):
                keys = numbers_in(batch.column(1), row, np.uint32).astype(np.uint64)
                full = np.zeros(1 << width, dtype=bool)
                for factor in PROBES:
                    full[probe(keys, factor, width)] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([np.packbits(full, bitorder="little").tobytes()], pa.binary())],
                    names=["part", "bits"])

    return run


def bit_set(table: DataFrame, source: HashSource, count: int, least: int, label: str) -> tuple[BitSet, int]:
    """A filter that lets all hashes pass which occur ``least`` times (MOST_COUNT at most)
    among some ``count``, and few others; and how many those are. Only its bits come to the
    driver, 2^MOST_BITS of them at most."""
    least, bits = min(least, MOST_COUNT), part_bits(count)
    kept = written_table(table.mapInArrow(deal_task(source, bits, least), DEALT)
                         .repartition("part").sortWithinPartitions("part").mapInArrow(keep_task(least), KEPT), label)
    found = kept.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    width = max(min(max((HASH_BITS * found).bit_length(), LEAST_BITS), MOST_BITS) - bits, 3)
    data = np.zeros(1 << (bits + width - 3), dtype=np.uint8)
    size = 1 << (width - 3)
    full = kept.select("part", "keys").mapInArrow(bits_task(width), "part int, bits binary")
    for row in full.collect():  # bounded by the number of bits
        data[row["part"] * size:(row["part"] + 1) * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return BitSet(bits, width, data), found


def hashes_of_table(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield phrase_hashes(batch.column(1), batch.column(0))


def possible(part: Slice, size: int, prior: BitSet) -> tuple[np.ndarray, np.ndarray]:
    """Positions of owned phrases of ``size`` words whose two parts of one word less pass
    the filter, and the hashes of those phrases."""
    words, linked = word_hashes(part.words, part.lang), part.linked()
    own = words[part.codes]
    hashes, inside = own, np.ones(len(own), dtype=bool)
    for k in range(1, size):
        if k == size - 1:
            passed = (prior.has(words)[part.codes] if k == 1 else prior.has(hashes)) & inside
        inside = inside[:-1] & linked[k - 1:len(linked) - 1]
        hashes = extended(hashes[:-1], own[k:])
    at = np.flatnonzero(inside & passed[:-1] & passed[1:])
    at = at[at < part.own]
    return at, hashes[at]


def hashes_of_texts(prior, size: int) -> HashSource:
    def source(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in slices(batches, size - 1):
            yield possible(part, size, prior.value)[1]

    return source


PACKED = "lang string, part int, sizes binary, phrases binary, counts binary"


def pack_task(prior, sieve, size: int, parts: int):
    """Different phrases of ``size`` words that pass the filter and the sieve, with their
    number, in packs: a row holds what a task has for one language and one part of the
    phrases by hash, the bytes of all phrases one after the other."""

    def packs(held: Gathered) -> Iterator[pa.RecordBatch]:
        for table in held.flush(2 * HELD_ROWS):
            langs = table.column(0)
            key = pc.index_in(langs, value_set=langs.unique()).to_numpy() * np.int64(parts) + table.column(3).to_numpy()
            order = np.argsort(key, kind="stable")
            begins, ends = runs(key[order])
            table = table.take(pa.array(order))
            phrases = table.column(1).cast(pa.binary())
            offsets = np.frombuffer(phrases.buffers()[1], dtype=np.int32)[phrases.offset:phrases.offset + len(order) + 1]
            data = np.frombuffer(phrases.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
            heads = pa.array(begins)
            yield pa.RecordBatch.from_arrays(
                [table.column(0).take(heads), table.column(3).take(heads), binaries(np.diff(offsets), ends),
                 binaries(data, offsets[ends] - offsets[0]), binaries(table.column(2).to_numpy(), ends)],
                names=["lang", "part", "sizes", "phrases", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Gathered(dealt=True)
        for part in slices(batches, size - 1):
            at, hashes = possible(part, size, prior.value)
            passed = sieve.value.has(hashes)
            at, hashes = at[passed], hashes[passed]
            if not len(at):
                continue
            key, most = part.codes[at].astype(np.int64), len(part.words)
            for k in range(1, size):
                if most * len(part.words) >= 1 << 63:  # too large to number: number those there are
                    found, key = np.unique(key, return_inverse=True)
                    most = len(found)
                key = key * np.int64(len(part.words)) + part.codes[at + k]
                most *= len(part.words)
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            dealt = hashes[first] % np.uint64(parts)
            first = at[first]
            words = [part.words.take(pa.array(part.codes[first + k])) for k in range(size)]
            phrases = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary()))
            held.add(part.lang, phrases, counts, dealt.astype(np.int32))
            if held.full():
                yield from packs(held)
        yield from packs(held)

    return run


# --- tries -------------------------------------------------------------------------

@dataclass
class Trie:
    """A double array: from state s, symbol c leads to ``base[s] + c`` if ``check`` there is
    s. State 0 is the root. A word is two symbols, the upper and the lower half of its
    number, so that the children of a state lie close together; frequent words have small
    numbers, so that they lie closer still."""

    lang: str
    words: pa.Array
    half: int
    base: np.ndarray
    check: np.ndarray


def half_bits(words: int) -> int:
    """Bits of one of the two symbols of a word."""
    return max((max(words - 1, 1).bit_length() + 1) // 2, 1)


# Sets of children of at least this share of the symbols get room of their own, and others
# that after some rounds still clash.
LARGE_SHARE = 4
ROUNDS = 8


def place_children(parents: np.ndarray, children: np.ndarray, symbols: int, base: np.ndarray,
                   check: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Finds a base for each parent so that its children fall on free states. ``parents``
    is sorted and goes with ``children``. Large sets are laid side by side behind all
    others. Of smaller ones, parents with up to 2^k children are tried together, those with
    most first; where places clash, one of them wins the round. Single children take the
    states that are left."""
    heads = np.flatnonzero(np.diff(parents, prepend=-1))
    sizes = np.diff(np.append(heads, len(parents)))
    state = np.zeros(len(children), dtype=np.int64)
    large = sizes * LARGE_SHARE >= symbols
    base, check = grown(base, check, 2 * int(sizes[~large].sum()) + 2 * symbols)

    def side_by_side(some: np.ndarray) -> None:
        nonlocal base, check
        begin = len(base)
        base, check = grown(base, check, (len(some) + 1) * symbols)
        base[parents[heads[some]]] = begin + np.arange(len(some)) * symbols
        members = np.repeat(heads[some] - np.cumsum(sizes[some]) + sizes[some], sizes[some]) + np.arange(
            sizes[some].sum())
        state[members] = base[parents[members]] + children[members]
        check[state[members]] = parents[members]

    if large.any():
        side_by_side(np.flatnonzero(large))
    small, most = np.where(large, 0, sizes), 1
    while most < small.max(initial=1):
        most *= 2
    while most > 1:
        still = np.flatnonzero((small > most // 2) & (small <= most))
        for _ in range(ROUNDS):
            if not len(still):
                break
            # Shorter sets repeat their last child.
            members = heads[still][:, None] + np.minimum(np.arange(most), small[still][:, None] - 1)
            guess = rng.integers(1, len(base) - symbols + 1, len(still))
            target = guess[:, None] + children[members]
            fits = (check[target] == -1).all(axis=1)
            members, target, guess, fitting = members[fits], target[fits], guess[fits], still[fits]
            mine = parents[heads[fitting]]
            check[target] = mine[:, None]  # the last one to write a state keeps it
            won = (check[target] == mine[:, None]).all(axis=1)
            lost = target[~won]
            check[lost[check[lost] == mine[~won][:, None]]] = -1
            base[mine[won]] = guess[won]
            state[members[won]] = target[won]
            still = np.concatenate((still[~fits], fitting[~won]))
        if len(still):
            side_by_side(still)
        most //= 2
    single = heads[small == 1]
    free = np.flatnonzero(check[symbols:len(check) - symbols] == -1)[:len(single)] + symbols
    if len(free) < len(single):  # new states follow the others
        more = len(single) - len(free)
        free = np.concatenate((free, len(check) + np.arange(more)))
        base, check = grown(base, check, more + symbols)
    base[parents[single]] = free - children[single]
    check[free] = parents[single]
    state[single] = free
    return state, base, check


def grown(base: np.ndarray, check: np.ndarray, more: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate((base, np.zeros(more, dtype=base.dtype))),
            np.concatenate((check, np.full(more, -1, dtype=check.dtype))))


def build_trie(lang: str, phrases: pa.Array) -> tuple[Trie, np.ndarray]:
    """A trie of different phrases of equally many words, and the state of each phrase."""
    split = pc.split_pattern(phrases, " ")
    encoded = split.flatten().cast(pa.binary()).dictionary_encode()
    codes = encoded.indices.to_numpy()
    by_number = np.argsort(-np.bincount(codes, minlength=len(encoded.dictionary)), kind="stable")
    words = encoded.dictionary.take(pa.array(by_number))
    number = np.empty(len(by_number), dtype=np.int64)
    number[by_number] = np.arange(len(by_number))
    half = half_bits(len(words))
    numbers = number[codes].reshape(len(phrases), -1)
    path = np.stack((numbers >> half, numbers & ((1 << half) - 1)), axis=2).reshape(len(phrases), -1)
    order = np.lexsort(path.T[::-1])
    path = path[order]
    symbols = 1 << half
    base, check = np.zeros(2 * symbols, dtype=np.int32), np.full(2 * symbols, -1, dtype=np.int32)
    check[0] = -2
    rng = np.random.default_rng(len(phrases))
    state = np.zeros(len(path), dtype=np.int64)
    for level in range(path.shape[1]):
        new = np.ones(len(path), dtype=bool)
        new[1:] = (np.diff(state) != 0) | (np.diff(path[:, level]) != 0)
        by_parent = np.flatnonzero(new)
        by_parent = by_parent[np.argsort(state[by_parent], kind="stable")]
        placed, base, check = place_children(
            state[by_parent], path[by_parent, level], symbols, base, check, rng)
        found = np.zeros(len(path), dtype=np.int64)
        found[by_parent] = placed
        state = found[np.flatnonzero(new)[np.cumsum(new) - 1]]
    # A lookup may go up to the largest symbol beyond the last base.
    needed = max(int(np.flatnonzero(check != -1)[-1]) + 1, int(base.max()) + symbols)
    out = np.zeros(len(path), dtype=np.int64)
    out[order] = state
    return Trie(lang, words, half, base[:needed], check[:needed]), out


def walk(trie: Trie, words: pa.Array, codes: np.ndarray, at: np.ndarray, size: int,
         linked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Those of the positions ``at`` of phrases that the trie accepts, and their states:
    states of all positions move on by one word at a time."""
    number = pc.index_in(words, value_set=trie.words).fill_null(-1).to_numpy(zero_copy_only=False)
    word = number[codes]
    state = np.zeros(len(at), dtype=np.int32)
    for k in range(size):
        on = word[at + k] >= 0 if linked is None or not k else linked[at + k - 1]
        at, state = at[on], state[on]
        if k and linked is not None:
            on = word[at + k] >= 0
            at, state = at[on], state[on]
        for upper in (True, False):
            here = word[at + k]
            target = trie.base[state] + (here >> trie.half if upper else here & ((1 << trie.half) - 1))
            on = trie.check[target] == state
            at, state = at[on], target[on]
    return at, state


def advance(trie: Trie, part: Slice, size: int) -> np.ndarray:
    """The accepting states of all owned positions."""
    return walk(trie, part.words, part.codes, np.arange(part.own), size, part.linked())[1]


class Counted:
    """The tries of one language and one part of the phrases, with visits of their states."""

    def __init__(self, lang: str, size: int):
        self.lang, self.size = lang, size
        self.tries: list[tuple[Trie, pa.Array, np.ndarray, np.ndarray]] = []
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = self.bytes = 0

    def add(self, sizes: np.ndarray, data: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((sizes, data, counts))
        self.rows += len(sizes)
        self.bytes += len(data)
        if self.rows > TRIE_PHRASES or self.bytes > TRIE_BYTES:
            self.count()

    def count(self) -> None:
        """Adds what is held to the states of the tries. What none of them accepts makes
        another trie."""
        if not self.held:
            return
        sizes, data, counts = map(np.concatenate, zip(*self.held))
        self.held, self.rows, self.bytes = [], 0, 0
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        phrases = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        encoded = pc.split_pattern(phrases, " ").flatten().cast(pa.binary()).dictionary_encode()
        words, codes = encoded.dictionary, encoded.indices.to_numpy()
        at = np.arange(len(phrases)) * self.size
        for trie, _, _, visits in self.tries:
            at = self.visit(trie, visits, words, codes, at, counts)
        if len(at):
            new = pc.unique(phrases.take(pa.array(at // self.size)))
            trie, states = build_trie(self.lang, new)
            self.tries.append((trie, new, states, np.zeros(len(trie.base), dtype=np.int64)))
            self.visit(trie, self.tries[-1][3], words, codes, at, counts)

    def visit(self, trie: Trie, visits: np.ndarray, words: pa.Array, codes: np.ndarray, at: np.ndarray,
              counts: np.ndarray) -> np.ndarray:
        """Adds to the visits of a trie; the positions that it does not accept."""
        found, state = walk(trie, words, codes, at, self.size)
        visits += np.bincount(state, counts[found // self.size], len(visits)).astype(np.int64)
        return np.setdiff1d(at, found, assume_unique=True)

    def frequent(self, least: int) -> Iterator[pa.RecordBatch]:
        self.count()
        for _, phrases, states, visits in self.tries:
            times = visits[states]
            full = np.flatnonzero(times >= least)
            for begin in range(0, len(full), 50_000):
                some = full[begin:begin + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([self.lang] * len(some), pa.string()), phrases.take(pa.array(some)), pa.array(times[some])],
                    names=["lang", "phrase", "n"])


def trie_task(size: int, least: int):
    """Phrases of packs sorted by language and part that occur at least ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part = None, None
        for batch in batches:
            for row, new in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if new != key:
                    if part:
                        yield from part.frequent(least)
                    key, part = new, Counted(new[0], size)
                sizes, data, counts = (numbers_in(batch.column(2 + k), row, kind)
                                       for k, kind in enumerate((np.int32, np.uint8, np.int64)))
                part.add(sizes, data, counts)
        if part:
            yield from part.frequent(least)

    return run


def counted_phrases(texts: DataFrame, prior, sieve, size: int, least: int, parts: int, label: str) -> DataFrame:
    """Phrases (lang, phrase) of ``size`` words that occur at least ``least`` times, with
    their number."""
    packed = texts.mapInArrow(pack_task(prior, sieve, size, parts), PACKED)
    return written_table(packed.repartition("lang", "part").sortWithinPartitions("lang", "part")
                         .mapInArrow(trie_task(size, least), "lang string, phrase string, n long"), label)


# --- scores ------------------------------------------------------------------------

def words_between(first: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def scored(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """Each phrase with its lowest-scoring cut, the first of several. Products have up to
    38 digits."""
    c = F.col
    size = F.size(F.split("phrase", " "))
    cuts = (phrases.select("lang", "phrase", c("n").alias("a"), size.alias("size"),
                           F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
            .withColumns({"first": words_between(F.lit(1), c("cut")),
                          "rest": words_between(c("cut") + 1, c("size") - c("cut"))}))
    left = parts.select("lang", c("phrase").alias("first"), c("n").alias("l"))
    right = parts.select("lang", c("phrase").alias("rest"), c("n").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("CAST(1000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0))"
                   " DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    return both.groupBy("lang", "phrase", "a").agg(lowest).select(
        "lang", "phrase", "a", c("lowest.l").alias("l"), c("lowest.r").alias("r"), c("lowest.score").alias("score"))


def covered(longer: DataFrame, most_words: int, share: int) -> DataFrame:
    """Parts of two words or more of longer phrases, with the count up to which a part is
    covered by the most frequent of them."""
    size = F.size(F.split("phrase", " "))
    width = F.explode(F.sequence(F.lit(2), F.greatest(size - 1, F.lit(2)))).alias("width")
    parts = (longer.where(size > 2).select("lang", "phrase", "n", size.alias("size"), width)
             .select("lang", "phrase", "n", "width",
                     F.explode(F.sequence(F.lit(1), F.col("size") - F.col("width") + 1)).alias("begin"))
             .select("lang", words_between(F.col("begin"), F.col("width")).alias("phrase"), "n"))
    return parts.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(documents: DataFrame, min_count: int = 10, max_words: int = 3, share: int = 50,
                 top: int = 2000, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Of ``documents`` (text, lang), per language the ``top`` phrases of two to
    ``max_words`` words: lang, rank, phrase, a, l, r, n, score.

    ``a``, ``l`` and ``r`` count the phrase and the two parts of its lowest-scoring cut, n
    all words of the language; the score is a^2 / (l r) in millionths. Phrases with fewer
    than ``min_count`` occurrences do not count; phrases that mostly (``share`` percent)
    occur inside one longer phrase are left out. A Python worker holds about
    ``group_bytes`` of tries at a time.
    """
    c = F.col
    spark: SparkSession = documents.sparkSession
    texts = documents.select("lang", "text")
    words = written_table(texts.mapInArrow(word_task, "lang string, phrase string, n long")
                          .groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    positions = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    levels = [words.where(c("n") >= min_count)]
    frequent = levels[0].select("lang", "phrase")
    prior = spark.sparkContext.broadcast(bit_set(frequent, hashes_of_table, frequent.count(), 1, "passed_1")[0])
    for size in range(2, max_words + 1):
        passed, count = bit_set(texts, hashes_of_texts(prior, size), positions, min_count, f"passed_{size}")
        sieve = spark.sparkContext.broadcast(passed)
        parts = min(max(LEAST_PARTS, shuffle_parts(spark), count * TRIE_WEIGHT // group_bytes), MOST_PARTS)
        levels.append(counted_phrases(texts, prior, sieve, size, min_count, parts, f"phrases_{size}"))
        prior.destroy()
        prior = sieve
    prior.destroy()
    phrases, parts = levels[1], levels[0]
    for level in levels[2:]:
        phrases = phrases.unionByName(level)
    for level in levels[1:-1]:
        parts = parts.unionByName(level)
    found = scored(phrases, parts)
    inside = covered(phrases, max_words, share)
    kept = found.join(inside, ["lang", "phrase"], "left").where(
        c("longer").isNull() | (100 * c("longer") < share * c("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(c("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", c("total").alias("n"), "score")
