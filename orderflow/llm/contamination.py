"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from orderflow.llm.text import shingle_slices, texts, words

# Bytes of item texts that a task holds at a time; more items go in further blocks, each over all documents.
BLOCK_BYTES = 16 << 20


def shingles(text: bytes, k: int) -> set[bytes]:
    """Distinct k-word shingles; fewer words are one shingle, no word none."""
    flat, starts, ends = shingle_slices(text, k)
    return {flat[s:e] for s, e in zip(starts, ends)}


def hashed(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    flat, starts, ends = shingle_slices(text, k)
    return np.unique(np.array([xxh64_intdigest(flat[s:e]) for s, e in zip(starts, ends)], np.uint64))


def signature(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One-permutation MinHash of sorted hashes: the least in each of 2**bits bins, a bin being the leading bits."""
    if not len(hashes) or bits <= 0:
        return hashes[:1]
    bins = hashes >> np.uint64(64 - min(bits, 63))
    return hashes[np.append(True, bins[1:] != bins[:-1])]


def size_class(n: int) -> int:
    """Documents of up to 2**c distinct shingles and more than half of that are partition c."""
    return max(n - 1, 0).bit_length()


def extra_bits(n_item: int, threshold: float, miss: float) -> int:
    """By how many bits a partition's bins outnumber its shingles, for items of a size.

    An item that is contained shares at least threshold * n_item shingles. One of them meets its like if it is the
    least of its bin on either side, which with m shingles per bin has probability (1 - exp(-m)) / m. Bins are
    added until all of them fail with a probability of at most ``miss``: long items do with few bins, and a
    single shingle gets so many that it is practically alone.
    """
    shared = max(1, int(np.ceil(threshold * n_item - 1e-9)))
    for extra in range(40):
        load = 2.0 * 2.0**-extra
        if (1 + np.expm1(-load) / load) ** shared <= miss:
            break
    return extra


class ItemIndex:
    """Signatures of items, by partition of the documents and number of bins, made as documents need them.

    An item of fewer than k words is one shingle of as many words as it has; such items are looked up among the documents'
    shingles of that length, for lengths that occur.
    """

    def __init__(self, ids: list, bodies: list[bytes], times: list[int], k: int, threshold: float, miss: float):
        self.k, self.threshold = k, threshold
        self.ids, self.times, self.shingles, self.hashes = [], [], [], []
        self.groups: dict[int, list[int]] = {}
        self.short: dict[int, dict[bytes, list[int]]] = {}
        self.made: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for item, text, n in zip(ids, bodies, times):
            own = shingles(text, k)
            if not own:
                continue
            at, n_words = len(self.ids), len(words(text))
            if n_words < k:
                self.short.setdefault(n_words, {}).setdefault(next(iter(own)), []).append(at)
            else:
                self.groups.setdefault(extra_bits(len(own), threshold, miss), []).append(at)
            self.ids.append(item)
            self.times.append(n)
            self.shingles.append(own)
            self.hashes.append(hashed(text, k))

    def _entries(self, size: int, extra: int) -> tuple[np.ndarray, np.ndarray]:
        if (size, extra) not in self.made:
            own = [signature(self.hashes[i], size + extra) for i in self.groups[extra]]
            values, owners = np.concatenate(own), np.repeat(self.groups[extra], [len(x) for x in own])
            order = np.argsort(values, kind="stable")
            self.made[size, extra] = values[order], owners[order]
        return self.made[size, extra]

    def candidates(self, hashes: np.ndarray) -> list[int]:
        """Items that share a bin's least hash with a document."""
        size, found = size_class(len(hashes)), []
        for extra in self.groups:
            values, owners = self._entries(size, extra)
            own = signature(hashes, size + extra)
            low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            for a, b in zip(low[low < high].tolist(), high[low < high].tolist()):
                found.append(owners[a:b])
        return np.unique(np.concatenate(found)).tolist() if found else []

    def matches(self, text: bytes) -> list[tuple[int, int, int]]:
        """(item, shared, of) of the items whose distinct shingles are in a text to the threshold, compared as words."""
        found = [(i, 1, 1) for n, items in self.short.items() for one in items.keys() & shingles(text, n) for i in items[one]]
        hashes = hashed(text, self.k)
        items = self.candidates(hashes) if len(hashes) else []
        own = shingles(text, self.k) if items else set()
        for i in items:
            shared = len(self.shingles[i] & own)
            if shared >= self.threshold * len(self.shingles[i]) - 1e-9:
                found.append((i, shared, len(self.shingles[i])))
        return found


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """Items in blocks by hash of their row, each of about ``block_bytes``: what the driver and a task hold at once. Equal
    items are one with the number of times it is there."""
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("n"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = -(-total // block_bytes) if total else 0
    for b in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).select("item_id", "text", "n").toArrow()
        yield rows.column(0).to_pylist(), [(x or "").encode() for x in rows.column(1).to_pylist()], rows.column(2).to_pylist()


def matches(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8, miss: float = 1e-9, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) for each document that contains an item.

    ``docs`` has doc_id and text, ``items`` item_id and text. An item is contained if at least ``threshold`` of its
    distinct k-word shingles (A-Z lower-cased, white space apart) are among the document's. An item of fewer than k
    words is contained where its words follow each other in the document; null and
    empty texts have none and match nothing. Repeated documents and items give repeated rows; ids may be null.
    An item that is contained is missed with a probability of at most ``miss``. No items or documents: no rows.
    """
    schema = "doc_id long, item_id long, n_shared long, n_item long, containment double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for block in _blocks(items, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, held=held):
            index = ItemIndex(*held.value, k, threshold, miss)
            for batch in batches:
                out = [(doc, index.ids[i], shared, of, shared / of)
                       for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))) for i, shared, of in index.matches(text)
                       for _ in range(index.times[i])]
                columns = zip(*out) if out else [[]] * 5
                types = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["doc_id", "item_id", "n_shared", "n_item", "containment"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionAll(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def decontaminated(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8, miss: float = 1e-9, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that contain no item, as ``matches`` finds them, with all their columns. Nothing is shuffled."""
    at = docs.columns.index("text")
    for block in _blocks(items, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, held=held):
            index = ItemIndex(*held.value, k, threshold, miss)
            for batch in batches:
                yield batch.filter(pa.array([not index.matches(t) for t in texts(batch.column(at))], pa.bool_()))

        docs = docs.mapInArrow(run, T.StructType(docs.schema.fields))
    return docs
