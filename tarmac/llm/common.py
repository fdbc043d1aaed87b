"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise

__all__ = ["as_bytes", "bounded_batches", "fold_of", "materialise", "mix", "table", "text_bytes", "window_hashes", "word_hashes", "words"]

# Odd multipliers of the 64-bit hashes.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches hold at most so many rows.

    Rows here are whole texts: the default of 10 000 takes hundreds of megabytes in each task, outside the heap and in Python.
    A smaller setting stays as it is.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(folds), F.lit(0))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column; nulls stay."""
    return column.cast(pa.binary()).to_pylist()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, one text at a time; nulls become empty."""
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


def words(text: bytes, lower: bool = True) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes; only A-Z are lower-cased."""
    return (text.lower() if lower else text).split()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Remembers the 64-bit hash of each word; emptied when it has grown large."""

    LARGEST = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LARGEST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(tokens: list[bytes], memory: WordHashes) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, tokens), np.uint64, len(tokens))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit value for each run of ``size`` words, in order; a shorter text is one run as a whole."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(size, n)
    out = np.full(n - size + 1, np.uint64(size))
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(MULTIPLIERS[i % 5]) + hashes[i : n - size + 1 + i]
    return mix(out)
