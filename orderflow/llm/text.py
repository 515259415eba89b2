"""Texts as bytes, words and shingles inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# A-Z to a-z, other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blobs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, one value after the other, and the n + 1 offsets. Null is empty."""
    values = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def texts(column: pa.Array) -> list[bytes]:
    """Each value as bytes; null is empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words. ``split`` without argument cuts at exactly the six ASCII white spaces."""
    return text.translate(LOWER).split()


def shingle_slices(text: bytes, k: int) -> tuple[bytes, list[int], list[int]]:
    """The lower-cased text with single spaces, and start and end of each k-word shingle in it, repeats included.

    Fewer than k words make one shingle, the whole sequence; no word makes none.
    """
    flat = b" ".join(words(text))
    if not flat:
        return flat, [], []
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(flat)]))
    if len(starts) < k:
        return flat, [0], [len(flat)]
    return flat, starts[: len(starts) - k + 1].tolist(), ends[k - 1 :].tolist()
