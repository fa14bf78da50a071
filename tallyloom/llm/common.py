"""Helpers that several of the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MASK = (1 << 64) - 1


def shuffle_parts(spark: SparkSession) -> int:
    """The number of partitions the caller sized shuffles for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a NULL key is fold 0."""
    code = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(F.pmod(code, F.lit(folds)), F.lit(0))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer, so that all bits depend on all bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(count, base, dtype=np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def text_batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches that hold at most ``limit`` bytes, or a single row."""
    for batch in batches:
        begin, held = 0, 0
        sizes = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) \
                    or pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
                lengths = pc.binary_length(column).fill_null(0)
                sizes += lengths.to_numpy(zero_copy_only=False).astype(np.int64)
        for row, size in enumerate(sizes.tolist()):
            if row > begin and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        if batch.num_rows > begin:
            yield batch.slice(begin)


def tokenizer_path() -> str:
    """The installed vocabulary file the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
