"""What several operators share: tokens as numpy arrays, bounded slices, the shared folder.

Every helper for tasks works on one Arrow batch at a time, so a worker's memory is bounded by
``SLICE_BYTES`` and the longest single text, not by the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..plans.cut import cut

#: UTF-8 bytes of text that a task turns into arrays at once (one longer text is taken alone).
SLICE_BYTES = 4 << 20

#: Rows and bytes that Spark hands to a Python worker at once.
ARROW_ROWS, ARROW_BYTES = 2000, 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds what one Arrow batch holds when texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df below the shared folder and reads it again: this cuts lineage and survives executors."""
    return cut(df, name)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES):
    """Cuts a batch where the column's bytes pass ``most``; every row comes out once."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()  # workers live on between stages


def split_words(text) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none).

    Returns codes of all words one after the other, the distinct words as binary, and bounds:
    text i has codes[bounds[i]:bounds[i + 1]].
    """
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.fill_null(text, "").cast(pa.large_string()))
    flat, bounds = lists.flatten(), np.zeros(len(lists) + 1, np.int64)
    np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=bounds[1:])
    full = pc.greater(pc.binary_length(flat), 0)
    kept = full.to_numpy(zero_copy_only=False)
    if not kept.all():
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        flat = flat.filter(full)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.large_binary()), bounds


def hashes(values: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each value's bytes."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(v, seed) for v in values.to_pylist()), np.uint64, len(values))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


def windows(values: np.ndarray, bounds: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp: a 64-bit rolling hash of each run of ``width`` values that lies within one text.

    The polynomial is taken modulo 2^64 with an odd base, so a window is a difference of prefix sums
    times a power. Returns the windows' start positions and hashes, in text order.
    """
    n = len(values)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    starts = np.flatnonzero(np.arange(n) + width <= ends)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    up, down = powers(base | 1, n), powers(pow(base | 1, -1, 1 << 64), n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * down, out=sums[1:])
    return starts, mix((sums[starts + width] - sums[starts]) * up[starts])


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values over each text."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def loose(column):
    """A column whose struct fields and list items may be null, as Spark declares the columns of Python functions."""

    def kind(t: pa.DataType) -> pa.DataType:
        if pa.types.is_struct(t):
            return pa.struct([pa.field(f.name, kind(f.type)) for f in t])
        if pa.types.is_list(t):
            return pa.list_(kind(t.value_type))
        return t

    return column.cast(kind(column.type))
