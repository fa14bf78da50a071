"""Repeated passages: every byte that a 100-byte string covers which also starts earlier.

The answer is exact and needs no text to be compared with all others:

1. *Anchors.* The anchor of a window (a 100-byte string) is the smallest hash among its
   24-byte grams. It depends on the window alone, so equal windows have equal anchors.
   Neighbouring windows share their anchor, which cuts a text into segments of about 40
   windows. Segments are collapsed by (anchor, hash of the whole segment) in the task that
   made them and shuffled by anchor.
2. *Equal segments.* Per anchor, the first of each set of equal segments stays. Where one
   anchor has a single kind of segment, nothing is left to do.
3. *Run-length index.* Where an anchor has several kinds (the edges of repeated passages),
   the bytes of one segment per kind are fetched. Their suffixes are sorted, the
   Burrows-Wheeler transform is cut into runs, and suffix array values and match lengths
   are kept at the ends of the runs only. The matching statistics of all other positions
   are streamed from these samples: one position further, a match is one shorter. Windows
   whose match is long enough are chained to equal ones; the first of each chain stays.
4. *Crowded anchors* (the edge of a passage in very many texts) have no bound on their kinds
   of segments. They are split into single windows, which collapse by their 128-bit hash
   wherever they meet.
5. Whatever is not the first of its kind is marked, and the marks come back to the texts.

Texts cross the network packed and compressed, by a hash of their id.

Defined cases: a NULL text is an empty one; texts under 100 bytes keep all bytes; rows that
repeat both id and text are one document and get the same result; rows that repeat an id
with another text are ordered by a hash of the text; NULL ids come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import mixed, powers, shuffle_parts, text_batches
from tallyloom.settings import written_table

WINDOW = 100
GRAM = 24
SPAN = WINDOW - GRAM + 1  # grams of a window
# A flush of a task holds this much text; one anchor with more kinds of segments in a flush
# (or in all flushes together) is crowded.
FLUSH_BYTES = 24 << 20
CHUNK_BYTES = 1 << 20
CROWDED_IN_FLUSH = 64
CROWDED = 4096
INDEX_BYTES = 1 << 20

NULL_ID = -(1 << 63)
SEGMENT = np.dtype([("h", "u8"), ("c", "u8"), ("doc", "i8"), ("tie", "u4"), ("at", "u4"), ("n", "u1")])
SINGLE = np.dtype([("h", "u8"), ("c", "u8"), ("doc", "i8"), ("tie", "u4"), ("at", "u4")])
GONE = np.dtype([("doc", "i8"), ("tie", "u4"), ("at", "u4"), ("n", "u1")])
ASKED = np.dtype([("h", "u8"), ("doc", "i8"), ("tie", "u4"), ("at", "u4"), ("n", "u1"), ("crowded", "u1")])
MARKER = np.dtype([("h", "u8")])

PACKED = "shard int, kind int, body binary"
PACKED_ARROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("body", pa.binary())])
SEGMENTS, SINGLES, MARKERS, MARKS, ASK, TEXTS, CONTEXTS = range(7)
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)


# --- packing of rows -----------------------------------------------------------------


def packed(rows: np.ndarray) -> bytes:
    """The columns of the rows one after the other, which compresses better than rows."""
    return b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)


def unpacked(body: bytes, dtype: np.dtype) -> np.ndarray:
    count, start = len(body) // dtype.itemsize, 0
    rows = np.empty(count, dtype=dtype)
    for name in dtype.names:
        kind = dtype[name]
        rows[name] = np.frombuffer(body, dtype=kind, count=count, offset=start)
        start += count * kind.itemsize
    return rows


def all_unpacked(bodies: list[bytes], dtype: np.dtype) -> np.ndarray:
    return np.concatenate([unpacked(body, dtype) for body in bodies]) if bodies else np.empty(0, dtype)


def dealt(rows: np.ndarray, shard: np.ndarray, kind: int) -> Iterator[tuple[int, int, bytes]]:
    """The rows of each shard as one packed body."""
    order = np.argsort(shard, kind="stable")
    rows, shard = rows[order], shard[order]
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for part, number in zip(np.split(rows, cuts), shard[np.concatenate(([0], cuts))] if len(rows) else []):
        yield int(number), kind, packed(part)


def record_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    shards, kinds, bodies = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int32()), pa.array(kinds, pa.int32()), pa.array(bodies, pa.binary())],
        schema=PACKED_ARROW)


def batches_of(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size > 4 << 20:
            yield record_batch(held)
            held, size = [], 0
    yield record_batch(held)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys) % np.uint64(shards)).astype(np.int64)


def doc_shard(docs: np.ndarray, shards: int) -> np.ndarray:
    return shard_of(docs.astype(np.int64).view(np.uint64) + np.uint64(77), doc_shards(shards))


def doc_shards(shards: int) -> int:
    """Rows for documents are fewer than segments; half the shards keep their packs large."""
    return max(1, shards // 2)


def text_tie(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) & 0xFFFFFFFF


def documents_of(batch: pa.RecordBatch) -> list[tuple[int, int, bytes]]:
    """(id, hash of the text, text in UTF-8) of the rows."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    rows = []
    for number, text in zip(ids, texts):
        data = b"" if text is None else bytes(text)
        rows.append((NULL_ID if number is None else number, text_tie(data), data))
    return rows


# --- step 1: segments ----------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each position on."""
    words = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    mixed_words = words * np.uint64(0x9E3779B97F4A7C15)
    mixed_words ^= mixed_words >> np.uint64(32)
    grams = mixed_words[:-16] * np.uint64(0xD6E8FEB86659FD93)
    grams += mixed_words[8:-8]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams += mixed_words[16:]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    return grams


def window_minima(grams: np.ndarray) -> np.ndarray:
    """The smallest of the SPAN grams from each position on."""
    least, width = grams, 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN - width
    return np.minimum(least[:len(least) - rest], least[rest:])


def segments_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, hash, number of the text, first window and number of windows of all segments."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    grams = gram_hashes(data)
    anchors = window_minima(grams)
    windows = len(anchors)
    edge = np.zeros(windows + 1, dtype=np.int8)
    fits = sizes >= WINDOW
    np.add.at(edge, starts[fits], 1)
    np.add.at(edge, (starts + sizes - WINDOW + 1)[fits], -1)
    valid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    cut = np.ones(windows, dtype=bool)
    cut[1:] = (grams[:windows - 1] == anchors[:-1]) | (anchors[1:] < anchors[:-1]) | ~valid[:-1] | ~valid[1:]
    cut[starts[fits]] = True
    breaks = np.flatnonzero(cut)
    ends = np.append(breaks[1:], windows)
    used = valid[breaks]
    begin, end = breaks[used], ends[used]
    up, down = powers(BASE, len(grams)), powers(INVERSE, windows)
    total = np.zeros(len(grams) + 1, dtype=np.uint64)
    np.cumsum(grams * up, out=total[1:])
    content = mixed((total[end - 1 + SPAN] - total[begin]) * down[begin])
    owner = np.searchsorted(starts, begin, side="right") - 1
    # Empty texts share their start with the next one; the last of equal starts is meant.
    return anchors[begin], content, owner, begin - starts[owner], end - begin


def chunks_of(rows: list[tuple[int, int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    held, size = [], 0
    for row in rows:
        if held and size + len(row[2]) > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[2])
    if held:
        yield held


def flushed(rows: list[tuple[int, int, bytes]], shards: int) -> Iterator[tuple[int, int, bytes]]:
    """The packed segments of some documents, equal ones collapsed to the first. Rows that
    repeat id and text count once, as they are one document."""
    rows = sorted({row for row in rows if len(row[2]) >= WINDOW}, key=lambda row: row[:2])
    parts = []
    for base, chunk in numbered(chunks_of(rows)):
        h, c, owner, at, n = segments_of([row[2] for row in chunk])
        part = np.empty(len(h), dtype=SEGMENT)
        numbers = np.array([row[0] for row in chunk], dtype=np.int64)
        ties = np.array([row[1] for row in chunk], dtype=np.uint32)
        part["h"], part["c"], part["at"], part["n"] = h, c, at, n
        part["doc"], part["tie"] = numbers[owner], ties[owner]
        parts.append((part, owner + base))
    if not parts:
        return
    found = np.concatenate([part for part, _ in parts])
    owner = np.concatenate([row for _, row in parts])
    _, first = np.unique(found["h"] ^ (found["c"] * np.uint64(3)), return_index=True)
    again = np.ones(len(found), dtype=bool)
    again[first] = False
    yield from marks_of(found[again], shards)
    found, owner = found[first], owner[first]
    anchors, inverse, counts = np.unique(found["h"], return_inverse=True, return_counts=True)
    crowded = counts > CROWDED_IN_FLUSH
    split = crowded[inverse]
    yield from dealt(found[~split], shard_of(found["h"][~split], shards), SEGMENTS)
    if crowded.any():
        marks = anchors[crowded].astype(MARKER)
        yield from dealt(marks, shard_of(marks["h"], shards), MARKERS)
        asked = found[split]
        yield from singles(
            ((row["doc"], row["tie"], row["at"], row["n"], rows[number][2][row["at"]:])
             for row, number in zip(asked, owner[split])), shards)


def numbered(chunks):
    base = 0
    for chunk in chunks:
        yield base, chunk
        base += len(chunk)


def singles(segments, shards: int) -> Iterator[tuple[int, int, bytes]]:
    """The windows of crowded segments, each by its own hash, equal ones collapsed."""
    rows = []
    for doc, tie, at, n, text in segments:
        for step in range(int(n)):
            digest = xxhash.xxh3_128_intdigest(text[step:step + WINDOW])
            rows.append((digest >> 64, digest & 0xFFFFFFFFFFFFFFFF, int(doc), int(tie), int(at) + step))
    found, again = first_and_rest(np.array(rows, dtype=SINGLE))
    yield from marks_of(again, shards)
    yield from dealt(found, shard_of(found["h"], shards), SINGLES)


def first_and_rest(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first in document order of each group of rows with equal (h, c), and the others.
    A position that comes more than once (of a repeated row) is no other."""
    rows = rows[np.lexsort((rows["at"], rows["tie"], rows["doc"], rows["c"], rows["h"]))]
    new, moved = np.ones(len(rows), dtype=bool), np.ones(len(rows), dtype=bool)
    new[1:] = (rows["h"][1:] != rows["h"][:-1]) | (rows["c"][1:] != rows["c"][:-1])
    for name in ("doc", "tie", "at"):
        moved[1:] &= rows[name][1:] == rows[name][:-1]
    moved[1:] = ~moved[1:]
    return rows[new], rows[~new & moved]


def marks_of(rows: np.ndarray, shards: int) -> Iterator[tuple[int, int, bytes]]:
    """Windows that also start earlier, packed by document."""
    out = np.empty(len(rows), dtype=GONE)
    for name in GONE.names:
        out[name] = rows[name] if name in rows.dtype.names else 1
    yield from dealt(out, doc_shard(out["doc"], shards), MARKS)


def segment_task(shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in text_batches(batches, FLUSH_BYTES // 4):
            rows = documents_of(batch)
            held += rows
            size += sum(len(row[2]) for row in rows)
            if size > FLUSH_BYTES:
                yield from batches_of(flushed(held, shards))
                held, size = [], 0
        yield from batches_of(flushed(held, shards))
    return run


# --- step 2: equal segments ----------------------------------------------------------


def per_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[bytes]]]]:
    """The bodies of each shard by kind; the rows of a shard follow each other."""
    current, bodies = None, {}
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(3)]
        for shard, kind, body in zip(*columns):
            if shard != current:
                if bodies:
                    yield current, bodies
                current, bodies = shard, {}
            bodies.setdefault(kind, []).append(body)
    if bodies:
        yield current, bodies


def collapse_task(shards: int) -> Callable:
    def resolved(shard: int, bodies: dict[int, list[bytes]]) -> Iterator[tuple[int, int, bytes]]:
        for kind in (SINGLES, MARKS):  # these wait for a later step
            for body in bodies.get(kind, ()):
                yield shard, kind, body
        rows, again = first_and_rest(all_unpacked(bodies.get(SEGMENTS, []), SEGMENT))
        yield from marks_of(again, shards)
        marks = all_unpacked(bodies.get(MARKERS, []), MARKER)["h"]
        _, inverse, kinds = np.unique(rows["h"], return_inverse=True, return_counts=True)
        kinds = kinds[inverse]
        crowded = np.isin(rows["h"], marks) | (kinds > CROWDED)
        asks = crowded | (kinds > 1)
        asked = np.empty(int(asks.sum()), dtype=ASKED)
        for name in ("h", "doc", "tie", "at", "n"):
            asked[name] = rows[name][asks]
        asked["crowded"] = crowded[asks]
        yield from dealt(asked, doc_shard(asked["doc"], shards), ASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, bodies in per_shard(batches):
            yield from batches_of(resolved(shard, bodies))
    return run


# --- step 3: the run-length index ----------------------------------------------------


def text_task(shards: int) -> Callable:
    """Documents as compressed packs, one for each shard and flush."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows):
            numbers = np.array([row[0] for row in rows], dtype=np.int64)
            packs: dict[int, list] = {}
            for shard, row in zip(doc_shard(numbers, shards).tolist(), rows):
                packs.setdefault(shard, []).append(row)
            squeeze = zstandard.ZstdCompressor(level=1)
            for shard, pack in packs.items():
                head = np.array([(doc, tie, len(text)) for doc, tie, text in pack], dtype="i8")
                body = np.int64(len(pack)).tobytes() + head.tobytes() + b"".join(row[2] for row in pack)
                yield shard, TEXTS, squeeze.compress(body)

        held, size = [], 0
        for batch in text_batches(batches, FLUSH_BYTES // 4):
            rows = documents_of(batch)
            held += rows
            size += sum(len(row[2]) for row in rows)
            if size > FLUSH_BYTES:
                yield from batches_of(flush(held))
                held, size = [], 0
        yield from batches_of(flush(held))
    return run


def texts_of(body: bytes) -> Iterator[tuple[int, int, bytes]]:
    data = zstandard.ZstdDecompressor().decompress(body)
    count = int(np.frombuffer(data, "i8", 1)[0])
    head = np.frombuffer(data, "i8", 3 * count, offset=8).reshape(count, 3)
    at = 8 + head.nbytes
    for doc, tie, size in head.tolist():
        yield doc, tie, data[at:at + size]
        at += size


class ByDocument:
    """Rows of a shard, looked up by document."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows[np.lexsort((rows["at"], rows["tie"], rows["doc"]))]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (np.diff(self.rows["doc"]) != 0) | (np.diff(self.rows["tie"].astype(np.int64)) != 0)
        first = np.flatnonzero(new)
        self.spans = {
            (int(self.rows["doc"][a]), int(self.rows["tie"][a])): (a, b)
            for a, b in zip(first.tolist(), np.append(first[1:], len(rows)).tolist())}

    def of(self, doc: int, tie: int) -> np.ndarray:
        a, b = self.spans.get((doc, tie), (0, 0))
        return self.rows[a:b]


def fetch_task(shards: int) -> Callable:
    """The bytes of the segments that were asked for; crowded ones as single windows."""
    def fetched(bodies: dict[int, list[bytes]]) -> Iterator[tuple[int, int, bytes]]:
        asked = ByDocument(all_unpacked(bodies.get(ASK, []), ASKED))
        seen, rows, contexts, crowded, held = set(), [], [], [], 0
        for body in bodies.get(TEXTS, ()) if len(asked.rows) else ():
            for doc, tie, text in texts_of(body):
                if (doc, tie) in seen or (doc, tie) not in asked.spans:
                    continue
                seen.add((doc, tie))
                for row in asked.of(doc, tie):
                    piece = text[row["at"]:int(row["at"]) + int(row["n"]) + WINDOW - 1]
                    held += len(piece)
                    if row["crowded"]:
                        crowded.append((doc, tie, row["at"], row["n"], piece))
                    else:
                        rows.append(row)
                        contexts.append(piece)
            if held > FLUSH_BYTES:
                yield from sent(rows, contexts, crowded)
                rows, contexts, crowded, held = [], [], [], 0
        yield from sent(rows, contexts, crowded)

    def sent(rows: list, contexts: list[bytes], crowded: list) -> Iterator[tuple[int, int, bytes]]:
        if crowded:
            yield from singles(crowded, shards)
        if rows:
            rows = np.array(rows, dtype=ASKED)
            shard = shard_of(rows["h"], shards)
            for number in np.unique(shard).tolist():
                chosen = np.flatnonzero(shard == number)
                text = b"".join(contexts[k] for k in chosen.tolist())
                body = np.int64(len(chosen)).tobytes() + packed(rows[chosen]) + text
                yield number, CONTEXTS, zstandard.ZstdCompressor(level=1).compress(body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bodies in per_shard(batches):
            yield from batches_of(fetched(bodies))
    return run


class RunLengthIndex:
    """A run-compressed Burrows-Wheeler transform of some texts.

    Kept are the symbol and start of each run, and at the start of each run the suffix
    array value, that of the suffix before it, and the length of their match. The suffix
    array itself is not kept. Every text ends with a separator of its own.
    """

    def __init__(self, data: bytes, sizes: np.ndarray):
        count = len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        symbols = np.empty(len(data) + count, dtype=np.int64)
        inside = np.ones(len(symbols), dtype=bool)
        inside[ends] = False
        symbols[inside] = np.frombuffer(data, dtype=np.uint8).astype(np.int64) + count
        symbols[ends] = np.arange(count)
        self.size = len(symbols)
        order, ranks = self.suffix_order(symbols, int(sizes.max()) + 1 if count else 1)
        before = symbols[order - 1]  # the text is circular
        heads = np.ones(self.size, dtype=bool)
        heads[1:] = before[1:] != before[:-1]
        self.run_starts = np.flatnonzero(heads)
        self.run_symbols = before[self.run_starts]
        self.head_suffix = order[self.run_starts]
        self.head_above = np.where(self.run_starts > 0, order[self.run_starts - 1], -1)
        self.tail_suffix = order[np.append(self.run_starts[1:], self.size) - 1]
        self.head_match = self.match_lengths(ranks, self.head_suffix, self.head_above)

    def suffix_order(self, symbols: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The suffix array by prefix doubling, and the ranks by the first 1, 2, 4, ... symbols."""
        size = len(symbols)
        order = np.argsort(symbols)
        ranks = [self.ranked(symbols, order)]
        width = 1
        while width < longest and ranks[-1].max(initial=0) < size - 1:
            rank = ranks[-1].astype(np.int64)
            key = rank << 32
            key[:size - width] |= rank[width:] + 1
            order = np.argsort(key)  # ties share a rank, in any order
            ranks.append(self.ranked(key, order))
            width *= 2
        return order, ranks

    @staticmethod
    def ranked(key: np.ndarray, order: np.ndarray) -> np.ndarray:
        sorted_key = key[order]
        new = np.zeros(len(key), dtype=np.int32)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(len(key), dtype=np.int32)
        rank[order] = np.cumsum(new, dtype=np.int32)
        return rank

    def match_lengths(self, ranks: list[np.ndarray], one: np.ndarray, other: np.ndarray) -> np.ndarray:
        length = np.zeros(len(one), dtype=np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            p, q = one + length, other + length
            fits = (other >= 0) & (p < self.size) & (q < self.size)
            same = np.zeros(len(one), dtype=bool)
            same[fits] = ranks[level][p[fits]] == ranks[level][q[fits]]
            length[same] += 1 << level
        return length

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each position the length of its match with the suffix before it in suffix
        order, and where that starts. Only the run heads were compared: the next position
        on continues the match of the sample before it."""
        order = np.argsort(self.head_suffix)
        at = self.head_suffix[order]
        steps = np.diff(np.append(at, self.size))
        sample = np.repeat(order, steps)
        gone = np.arange(self.size) - np.repeat(at, steps)
        return self.head_match[sample] - gone, self.head_above[sample] + gone


def first_windows(data: bytes, sizes: np.ndarray) -> np.ndarray:
    """Of all windows of some texts, whether no earlier window is equal: true or false for
    the windows of the texts, one text after the other."""
    index = RunLengthIndex(data, sizes)
    length, above = index.matching_statistics()
    where = np.arange(index.size)
    long = length >= WINDOW
    head = np.where(long, above, where)
    while True:  # follow the chains of equal windows to their heads
        further = head[head]
        if np.array_equal(further, head):
            break
        head = further
    first = where.copy()
    np.minimum.at(first, head[long], where[long])
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    windows = sizes - WINDOW + 1
    base = np.repeat(begins - (np.cumsum(windows) - windows), windows)
    positions = base + np.arange(int(windows.sum()))
    return first[head[positions]] == positions


def index_task(shards: int) -> Callable:
    def repeated(rows: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        sizes = rows["n"].astype(np.int64) + WINDOW - 1
        again = ~first_windows(b"".join(pieces), sizes)
        out = np.empty(int(again.sum()), dtype=GONE)
        owner = np.repeat(np.arange(len(rows)), rows["n"])
        step = np.arange(len(owner)) - np.repeat(np.cumsum(rows["n"], dtype=np.int64) - rows["n"], rows["n"])
        out["doc"], out["tie"] = rows["doc"][owner[again]], rows["tie"][owner[again]]
        out["at"], out["n"] = rows["at"][owner[again]] + step[again], 1
        return out

    def resolved(shard: int, bodies: dict[int, list[bytes]]) -> Iterator[tuple[int, int, bytes]]:
        for body in bodies.get(MARKS, ()):
            yield shard, MARKS, body
        yield from marks_of(first_and_rest(all_unpacked(bodies.get(SINGLES, []), SINGLE))[1], shards)
        parts, pieces = [], []
        for body in bodies.get(CONTEXTS, ()):
            data = zstandard.ZstdDecompressor().decompress(body)
            count = int(np.frombuffer(data, "i8", 1)[0])
            part = unpacked(data[8:8 + count * ASKED.itemsize], ASKED)
            at = 8 + count * ASKED.itemsize
            for size in (part["n"].astype(int) + WINDOW - 1).tolist():
                pieces.append(data[at:at + size])
                at += size
            parts.append(part)
        if not parts:
            return
        rows = np.concatenate(parts)
        order = np.lexsort((rows["at"], rows["tie"], rows["doc"], rows["h"]))
        rows = rows[order]
        # Whole anchors, as many as an index takes; an anchor has a bounded number of rows.
        total = np.cumsum(rows["n"].astype(np.int64) + WINDOW)
        new = np.flatnonzero(np.append(True, rows["h"][1:] != rows["h"][:-1]))
        begin = 0
        while begin < len(rows):
            limit = (total[begin - 1] if begin else 0) + INDEX_BYTES
            ends = np.append(new[new > begin], len(rows))
            fits = ends[total[ends - 1] <= limit]
            end = int(fits[-1]) if len(fits) else int(ends[0])
            # Windows of different anchors are never equal, so document order across the
            # anchors of one index does not matter.
            yield from marks_of(repeated(rows[begin:end], [pieces[k] for k in order[begin:end].tolist()]), shards)
            begin = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, bodies in per_shard(batches):
            yield from batches_of(resolved(shard, bodies))
    return run


# --- step 5: back to the texts -------------------------------------------------------


def removed_spans(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal removed runs, given sorted marks (first window, number)."""
    first = marks["at"].astype(np.int64)
    if not len(first):
        return first, first
    last = np.maximum.accumulate(first + marks["n"] - 1 + WINDOW)
    apart = np.append(True, first[1:] > last[:-1])
    return first[apart], last[np.append(np.flatnonzero(apart)[1:], len(first)) - 1]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def result_task(with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bodies in per_shard(batches):
            marks = ByDocument(all_unpacked(bodies.get(MARKS, []), GONE))
            for body in bodies.get(TEXTS, ()):
                columns: list[list] = [[] for _ in range(6)]
                for doc, tie, text in texts_of(body):
                    first, last = removed_spans(marks.of(doc, tie))
                    rest, at = [], 0
                    for a, b in zip(first.tolist(), last.tolist()):
                        rest.append(text[at:a])
                        at = b
                    rest.append(text[at:])
                    left = b"".join(rest)
                    values = (None if doc == NULL_ID else doc, len(text), len(text) - len(left),
                              len(first), hashlib.sha256(left).hexdigest(), left)
                    for column, value in zip(columns, values):
                        column.append(value)
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                kinds = [pa.int64()] * 4 + [pa.string()]
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
                if with_text:
                    names.append("kept")
                    arrays.append(pa.array(columns[5], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def dedup_passages(documents: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): size, removed bytes and runs, and the
    digest of what stays; with ``with_text`` also the bytes that stay as ``kept`` (a cut may
    fall inside a character)."""
    spark = documents.sparkSession
    shards = shuffle_parts(spark)
    docs = documents.select("doc_id", F.col("text").cast("binary").alias("text"))

    def by_shard(rows: DataFrame, parts: int = shards) -> DataFrame:
        return rows.repartition(parts, "shard").sortWithinPartitions("shard", "kind")

    segments = docs.mapInArrow(segment_task(shards), PACKED)
    collapsed = written_table(by_shard(segments).mapInArrow(collapse_task(shards), PACKED), "segments")
    texts = docs.mapInArrow(text_task(shards), PACKED)
    asked = collapsed.where(F.col("kind") == ASK)
    fetched = by_shard(asked.unionAll(texts), doc_shards(shards)).mapInArrow(fetch_task(shards), PACKED)
    # Marks that fetching finds go through the index step, which passes them on.
    edges = by_shard(fetched.unionAll(collapsed.where(F.col("kind") == SINGLES)))
    marks = written_table(edges.mapInArrow(index_task(shards), PACKED), "edges")
    back = by_shard(collapsed.where(F.col("kind") == MARKS).unionAll(marks).unionAll(texts), doc_shards(shards))
    return back.mapInArrow(result_task(with_text), RESULT + (", kept binary" if with_text else ""))
