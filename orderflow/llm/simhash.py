"""SimHash near-duplicates: fingerprints that differ in few bits, found by anchor points of a covering code."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderflow.llm.components import components
from orderflow.llm.text import shingle_slices, texts
from orderflow.sources.workdir import stored

# The binary Golay code of length 23 by its generator polynomial; every word is within RADIUS of one codeword.
LENGTH, GENERATOR, RADIUS = 23, 0b101011100011, 3
_PIECE = 65536


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64 bits; a bit is 1 if set in over half of the shingles' XXH64 values. No words: 0."""
    flat, starts, ends = shingle_slices(text, shingle)
    if not starts:
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), _PIECE):
        pieces = [xxh64_intdigest(flat[s:e], seed) for s, e in zip(starts[i : i + _PIECE], ends[i : i + _PIECE])]
        bits = np.unpackbits(np.array(pieces, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) of every row, fp as a signed long."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in texts(batch.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


@lru_cache(1)
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Remainders modulo the generator of the low 12 and the high 11 bits of a word."""

    def rest(x: int) -> int:
        for i in range(LENGTH - 1, 10, -1):
            if x >> i & 1:
                x ^= GENERATOR << (i - 11)
        return x

    return np.array([rest(x) for x in range(1 << 12)]), np.array([rest(x << 12) for x in range(1 << 11)])


@lru_cache(8)
def _offsets(reach: int) -> list[list[np.ndarray]]:
    """For each syndrome and each excess 0..reach over the covering radius: the error patterns that lead to a codeword."""
    low, high = _syndromes()
    found: list[list[list[int]]] = [[[] for _ in range(reach + 1)] for _ in range(1 << 11)]
    for weight in range(RADIUS + reach + 1):
        for bits in combinations(range(LENGTH), weight):
            v = sum(1 << b for b in bits)
            found[low[v & 0xFFF] ^ high[v >> 12]][max(0, weight - RADIUS)].append(v)
    return [[np.array(x, np.int64) for x in per] for per in found]


def anchors(fp: int, reach: int) -> np.ndarray:
    """The codeword pairs of both 23-bit blocks that a fingerprint goes to; the first is its home, the nearest pair.

    The two blocks' codes together cover the first 46 bits with radius 3 + 3; the other 18 bits have one codeword,
    any word. If two fingerprints differ in at most ``reach`` bits, e1 and e2 of them in the blocks, the home of
    one is within 3 + e1 and 3 + e2 of the other, which therefore goes there too.
    """
    low, high = _syndromes()
    offsets, blocks = _offsets(reach), []
    for shift in (0, LENGTH):
        word = fp >> shift & ((1 << LENGTH) - 1)
        blocks.append([word ^ v for v in offsets[low[word & 0xFFF] ^ high[word >> 12]]])
    return np.concatenate([np.add.outer(blocks[0][i], blocks[1][j] << LENGTH).ravel()
                           for i in range(reach + 1) for j in range(reach + 1 - i)])


def dealt(distinct: DataFrame, reach: int) -> DataFrame:
    """(anchor, fp, home) for every anchor of each distinct fingerprint."""

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for i in range(0, len(fps), 2048):
                lists = [anchors(int(x) & (2**64 - 1), reach) for x in fps[i : i + 2048]]
                sizes = np.array([len(x) for x in lists], np.int64)
                if not len(sizes):
                    continue
                home = np.zeros(sizes.sum(), bool)
                home[np.cumsum(sizes) - sizes] = True
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists)), pa.array(np.repeat(fps[i : i + 2048], sizes)), pa.array(home)], ["anchor", "fp", "home"])

    return distinct.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b), a < b, for all distinct fingerprints that differ in at most ``max_bits`` bits.

    A fingerprint at home at an anchor is compared with all that were sent there. The join compares row by row;
    skewed anchors are split by adaptive execution. Each fingerprint has a bounded number of partners (all words
    within ``max_bits``), so links stay linear.
    """
    sent = stored(distinct.transform(dealt, max_bits), "anchors")
    home = sent.where("home").select("anchor", F.col("fp").alias("a"))
    there = sent.select("anchor", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return home.join(there, (home["anchor"] == there["anchor"]) & (F.col("a") < F.col("b")) & near).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, component_id, first) of every row.

    component_id is the smallest doc_id that a row's fingerprint reaches over links; ``first`` says that the row has
    this id and, of texts that share it, the least hash, so it marks one text of each component. Equal fingerprints
    meet before anything is compared, so copies cost one row. Texts without words (null, empty, white space only) have
    fingerprint 0 and link like others. Repeated rows and ids are kept, and repetitions of a first row are first too;
    a null id is larger than any other and gives a null component_id where no row has an id; an empty table gives no
    rows.
    """
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    key = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    distinct = fps.groupBy("fp").agg(F.min(key).alias("least"))
    roots = components(links(distinct, max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("chief"))
    known = rooted.join(least, "root").select("fp", "chief")
    first = F.col("doc_id").eqNullSafe(F.col("chief.id")) & (F.col("text_hash") == F.col("chief.hash"))
    return fps.join(known, "fp").select("doc_id", "text_hash", "fp", F.col("chief.id").alias("component_id"), first.alias("first"))
