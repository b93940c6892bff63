"""Words, shingles and row handling shared by the text operators.

A word is a run of characters other than space and \\x09-\\x0D, in Spark, in SQL and in
Python alike: `bytes.split()` cuts at exactly these six bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def folded_words(raw: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case; other letters stay as they are."""
    return raw.lower().split() if raw else []


def shingle_set(raw: bytes | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; a shorter text is one shingle, no word gives none."""
    parts = folded_words(raw)
    if not parts:
        return np.empty(0, np.uint64)
    line = b" ".join(parts)
    if len(parts) <= size:
        return np.array([xxhash.xxh3_64_intdigest(line)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(line[a:b]) for a, b in zip(starts[: 1 - size].tolist(), ends[size - 1 :].tolist())], np.uint64))


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def over_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a function to every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def settle() -> None:
    """Give memory that is free back to the system, as workers live on and the next job's need comes on top."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def list_column(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column of the given item type from numpy arrays."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
