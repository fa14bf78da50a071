"""Packing of tokenized documents into sequences: bound-certified best-fit repacking.

Documents are tokenized where they are; only piece lengths travel. Each partition of pieces is
packed by best-fit decreasing and certified: dual-feasible functions map lengths so that no
sequence can hold more than 1 in total, so the mapped sum is a lower bound of the number of
sequences. A partition that reaches its bound is proven and left alone. Partitions with a gap
give up the contents of their sequences that are not full; these are exchanged (dealt anew
between partitions) and packed again, until nothing is gained. Bins only hold what one
partition packs, so a partition never sees more than ``PIECES`` pieces.

Defined cases: a NULL or empty text is the end token alone; rows that repeat a doc_id are packed
like others, each with its own pieces.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import text_batches
from tallyloom.settings import written_table

ROOM = 1024
END = 2
PIECES = 100_000  # aimed at per partition
ROUNDS = 4
CHUNK_BYTES = 2 << 20
CACHED_WORDS = 300_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- tokens --------------------------------------------------------------------------


# Fixed value: how the byte-level vocabulary file splits texts before it looks at bytes.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters that a byte-level vocabulary writes for bytes: printable Latin-1 stands for
    itself, all other bytes for the code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids of texts as little-endian bytes, from a byte-level vocabulary file.

    Such a tokenizer never joins what a space before a word parts, so the parts between
    spaces are looked up in a bounded cache; new ones go to a faster encoder over the same
    vocabulary. Texts in which the file's special tokens occur go to the file's own
    tokenizer as they are.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): rank
                 for token, rank in self.tokenizer.get_vocab().items() if token not in special}
        self.special = sorted(special)
        self.words = tiktoken.Encoding(
            "words", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        words = split_words(text)
        found = list(map(self.cache.get, words))
        if None in found:
            encode, cache = self.words.encode_ordinary, self.cache
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = array("I", encode(words[k])).tobytes()
                    if len(cache) < CACHED_WORDS:
                        cache[words[k]] = found[k]
        return b"".join(found)


def split_words(text: str) -> list[str]:
    """Parts of a text, each from a space before a word (or the start) to the next."""
    words = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]
    if any(word == " " or word[1:2].isspace() for word in words[1:]):
        joined = [words[0]]
        for word in words[1:]:
            # A space that white space or the end follows belongs to what is before it.
            if word == " " or word[1:2].isspace():
                joined[-1] += word
            else:
                joined.append(word)
        return joined
    return words


def pieces_of(ids: bytes) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of a document: the first takes what is left over."""
    total = len(ids) // 4
    first = total % ROOM or ROOM
    cuts = [0, *range(first, total + 1, ROOM)]
    return [(a, b - a, zlib.crc32(ids[4 * a:4 * b])) for a, b in zip(cuts, cuts[1:])]


ENCODERS: dict[str, Encoder] = {}  # one for each worker process


def encoder(path: str) -> Encoder:
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def tokenized_pieces(documents: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents (doc_id, text); with ``with_ids`` also the token ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path).ids, array("I", [END]).tobytes()
        for batch in text_batches(batches, CHUNK_BYTES):
            rows = []
            for doc, text in zip(*(column.to_pylist() for column in batch.columns)):
                ids = encode(text or "") + end
                for number, (start, length, crc) in enumerate(pieces_of(ids)):
                    rows.append((doc, number, start, length, crc, ids[4 * start:4 * (start + length)]))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(arrays[:5 + with_ids], names=names[:5 + with_ids])

    return documents.select("doc_id", "text").mapInArrow(
        run, PIECE + (", ids binary" if with_ids else ""))


# --- bins ----------------------------------------------------------------------------


def bin_bound(lengths: np.ndarray, room: int = ROOM) -> int:
    """The best of some lower bounds of the number of bins, from dual-feasible functions:
    the threshold functions (small lengths count nothing, large ones all) for all thresholds,
    and the rounding functions for 1 to 20."""
    count = np.bincount(lengths, minlength=room + 1).astype(np.int64)
    size = np.arange(room + 1)
    number, volume = np.cumsum(count), np.cumsum(count * size)
    best = 0
    for small in range(room // 2 + 1):
        whole = number[room] - number[room - small]
        between = volume[room - small] - (volume[small - 1] if small else 0)
        best = max(best, int(whole + -(-between // room)))
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % room == 0, size * k, scaled // room * room)
        best = max(best, int(-(-(value * count).sum() // (k * room))))
    return best


def best_fit_decreasing(lengths: np.ndarray, room: int = ROOM) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its offset there: pieces by falling length, each into the
    fullest bin that takes it."""
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(room + 1)]
    some, opened = 0, 0  # bit r of ``some``: a bin with r tokens of room is there
    order = np.argsort(-lengths, kind="stable")
    for k, length in zip(order.tolist(), lengths[order].tolist()):
        fits = some >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            chosen = by_room[left].pop()
            if not by_room[left]:
                some &= ~(1 << left)
        else:
            left, chosen = room, opened
            opened += 1
        bins[k], offsets[k] = chosen, room - left
        left -= length
        if left:
            by_room[left].append(chosen)
            some |= 1 << left
    return bins, offsets


PACKED = PIECE + ", sequence_id long, offset long, open boolean"


def pack_task(round_: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        lengths = rows.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(lengths)
        filled = np.bincount(bins, weights=lengths)
        proven = len(filled) == bin_bound(lengths)
        open_ = np.zeros(len(bins), bool) if proven else filled[bins] < ROOM
        base = ((round_ << 24) + TaskContext.get().partitionId()) << 32
        out = rows.append_column("sequence_id", pa.array(bins + base)).append_column(
            "offset", pa.array(offsets)).append_column("open", pa.array(open_))
        yield from out.combine_chunks().to_batches(max_chunksize=10_000)
    return run


def pack_pieces(pieces: DataFrame) -> DataFrame:
    """``pieces`` (as PIECE) with their sequence and offset."""
    columns = pieces.columns
    done, waiting, waiting_bins, current = [], None, None, pieces
    for round_ in range(ROUNDS):
        parts = -(-current.count() // PIECES) or 1
        dealt = F.xxhash64("doc_id", "piece", F.lit(round_))
        packed = written_table(
            current.repartition(parts, dealt).mapInArrow(pack_task(round_), PACKED), "packed")
        numbers = packed.select("sequence_id", "open").distinct().agg(
            F.count("*").alias("all"), F.count_if("open").alias("open")).first()
        if waiting is not None and numbers["all"] >= waiting_bins:
            break  # nothing gained: the packing before stays
        done.append(packed.where(~F.col("open")))
        waiting, waiting_bins, current = packed.where("open"), numbers["open"], packed.where("open").select(*columns)
        if parts == 1 or not numbers["open"]:
            break  # proven, or no other partition to exchange with
    tables = [*done, waiting]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionAll(table)
    return out.select(*columns, "sequence_id", "offset")


def pack_documents(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces."""
    return pack_pieces(written_table(tokenized_pieces(documents, tokenizer_path), "pieces"))
