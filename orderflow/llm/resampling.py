"""Importance resampling: documents whose word n-grams are as frequent as a target's.

In a batch the n-grams are interned by an open-addressed table in numpy arrays: XXH64 of their bytes says where to look, the bytes
themselves whether it is the same n-gram. A slot holds its n-gram's bucket and count. Counts of a corpus are
sums over slots; a document's weight is the sum of gains gathered through the slots of its occurrences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.text import LOWER, blobs
from orderflow.sources.workdir import stored

BUCKETS = 10_000
ORDER = 3
LEAST_WORDS = 20
# What words are made of, and the primes of XXH64.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_LOWER = np.frombuffer(LOWER, np.uint8)
# Words whose n-grams are interned at a time.
_BLOCK = 1 << 17


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def _round(held: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(held + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """XXH64 of the strings of ``size`` bytes at ``starts``; ``data`` goes on for eight bytes after the last."""
    lanes = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    halves = np.ndarray(len(data) - 3, "<u4", data, strides=(1,))
    at = starts
    if size >= 32:
        first = (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))
        held = [np.full(len(starts), (seed + p) % (1 << 64), np.uint64) for p in first]
        for _ in range(size // 32):
            held = [_round(h, lanes[at + 8 * i]) for i, h in enumerate(held)]
            at = at + 32
        h = _turn(held[0], 1) + _turn(held[1], 7) + _turn(held[2], 12) + _turn(held[3], 18)
        for one in held:
            h = (h ^ _round(np.uint64(0), one)) * _P1 + _P4
    else:
        h = np.full(len(starts), (seed + int(_P5)) % (1 << 64), np.uint64)
    h = h + np.uint64(size)
    for _ in range(size % 32 // 8):
        h = _turn(h ^ _round(np.uint64(0), lanes[at]), 27) * _P1 + _P4
        at = at + 8
    if size % 8 >= 4:
        h = _turn(h ^ halves[at] * _P1, 23) * _P2 + _P3
        at = at + 4
    for _ in range(size % 4):
        h = _turn(h ^ data[at] * _P5, 11) * _P1
        at = at + 1
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    return h ^ h >> np.uint64(32)


def _crc_of_pairs() -> np.ndarray:
    """What two bytes, the first the lower one, do to a CRC-32."""
    pairs = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        pairs = np.where(pairs & 1, pairs >> 1 ^ np.uint32(0xEDB88320), pairs >> 1)
    return pairs


_CRC2 = _crc_of_pairs()
# one byte: what it does as the second of two after a zero
_CRC1 = _CRC2[:: 1 << 8]


def crc32(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """CRC-32 of the strings of ``size`` bytes at ``starts``, two bytes at a time."""
    pairs = np.ndarray(len(data) - 1, "<u2", data, strides=(1,))
    crc, at = np.full(len(starts), 0xFFFFFFFF, np.uint32), starts
    for _ in range(size // 2):
        crc = _CRC2[(crc ^ pairs[at]) & 0xFFFF] ^ crc >> 16
        at = at + 2
    if size % 2:
        crc = _CRC1[(crc ^ data[at]) & 0xFF] ^ crc >> 8
    return ~crc


# Longer strings are hashed and compared one by one.
_SHORT = 256


def _by_size(many, one, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, dtype) -> np.ndarray:
    """A hash of strings of all sizes: ``many`` takes strings of one size, ``one`` takes bytes."""
    out = np.zeros(len(starts), dtype)
    order = np.argsort(np.minimum(sizes, _SHORT + 1).astype(np.uint16), kind="stable")
    by_size = sizes[order]
    n_short = int((sizes <= _SHORT).sum())
    for row in order[n_short:].tolist():
        out[row] = one(memoryview(data)[starts[row] : starts[row] + sizes[row]])
    cuts = np.searchsorted(by_size[:n_short], np.arange(_SHORT + 2)).tolist()
    for size, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        if low < high:
            rows = order[low:high]
            out[rows] = many(data, starts[rows], size)
    return out


@dataclass
class Words:
    """The words of some texts in one buffer, one space after each, and where they are."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    texts: int


def words(column: pa.Array) -> Words:
    data, offsets = blobs(column)
    # a byte that belongs to no word ends each text
    n = len(offsets) - 1
    data = _LOWER[np.insert(data, offsets[1:], 0x20)]
    text_ends = offsets[1:] + np.arange(1, n + 1)
    inside = _WORD[data]
    before = np.append(False, inside[:-1])
    text = np.searchsorted(text_ends, np.flatnonzero(inside & ~before), "right")
    data = np.where(inside, data, 0x20).astype(np.uint8)[inside | before]
    ends = np.flatnonzero(data == 0x20)
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    return Words(np.append(data, np.zeros(8, np.uint8)), starts, ends, text, n)


@dataclass
class Interned:
    """Distinct n-grams as slots (bucket, count), and the slot and text of each occurrence."""

    bucket: np.ndarray
    count: np.ndarray
    slot: np.ndarray
    text: np.ndarray


_TAILS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the strings of ``sizes`` bytes at ``a`` and at ``b`` are equal, eight bytes at a time."""
    lanes = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    same = np.ones(len(a), bool)
    raw = memoryview(data)
    for row in np.flatnonzero(sizes > _SHORT).tolist():
        same[row] = raw[a[row] : a[row] + sizes[row]] == raw[b[row] : b[row] + sizes[row]]
    rows, at = np.flatnonzero(sizes <= _SHORT), 0
    while len(rows):
        left = sizes[rows] - at
        unlike = (lanes[a[rows] + at] ^ lanes[b[rows] + at]) & _TAILS[np.minimum(left, 8)]
        same[rows[unlike != 0]] = False
        rows, at = rows[(unlike == 0) & (left > 8)], at + 8
    return same


def intern(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each string, numbered from 0, and the first string put in each slot.

    All strings look at their place at once: one of those that find it free takes it, those that are equal to its string are done, all
    others go one place on.
    """
    bits = max(4, (2 * len(starts)).bit_length())
    owner = np.full(1 << bits, -1, np.int64)
    place = (keys >> np.uint64(64 - bits)).astype(np.int64)
    slot = np.empty(len(starts), np.int64)
    rows = np.arange(len(starts))
    while len(rows):
        at = place[rows]
        free = owner[at] < 0
        owner[at[free]] = rows[free]
        held = owner[at]
        like = (keys[held] == keys[rows]) & (sizes[held] == sizes[rows])
        near = np.flatnonzero(like)
        like[near] = _same(data, starts[held[near]], starts[rows[near]], sizes[rows[near]])
        slot[rows[like]] = at[like]
        rows = rows[~like]
        place[rows] = place[rows] + 1 & len(owner) - 1
    used = np.flatnonzero(owner >= 0)
    number = np.empty(len(owner), np.int64)
    number[used] = np.arange(len(used))
    return number[slot], owner[used]


def interned(column: pa.Array, order: int, buckets: int) -> Iterator[Interned]:
    """The n-grams of 1 to ``order`` words of some texts, whole texts in blocks of words; an n-gram belongs to its first word's block."""
    found = words(column)
    for low in range(0, len(found.starts), _BLOCK):
        first = np.arange(low, min(low + _BLOCK, len(found.starts)))
        starts, ends, text = [], [], []
        for k in range(order):
            inside = first[first + k < len(found.starts)]
            inside = inside[found.text[inside + k] == found.text[inside]]
            starts.append(found.starts[inside])
            ends.append(found.ends[inside + k])
            text.append(found.text[inside])
        starts, text = np.concatenate(starts), np.concatenate(text)
        sizes = np.concatenate(ends) - starts
        slot, owner = intern(found.data, starts, sizes, _by_size(xxh64, xxhash.xxh64_intdigest, found.data, starts, sizes, np.uint64))
        bucket = _by_size(crc32, zlib.crc32, found.data, starts[owner], sizes[owner], np.int64)
        yield Interned(bucket % buckets, np.bincount(slot, minlength=len(owner)), slot, text)


def counts(texts: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many n-grams of all texts fall into each bucket that has any. A task sends a row for each of its buckets."""

    def run(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for grams in interned(batch.column(0), order, buckets):
                sums += np.bincount(grams.bucket, grams.count, buckets).astype(np.int64)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["bucket", "n"])

    return texts.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What an occurrence in each bucket adds to a weight: 1000 times the logarithm of its share in the target over that in the
    corpus, each count plus one, rounded down. The driver holds a number per bucket."""
    sums = np.zeros((2, buckets), np.int64)
    for which, frame in enumerate((corpus, target)):
        for r in frame.collect():
            sums[which, r["bucket"]] = r["n"]
    s, t = sums.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, text: str = "text", order: int = ORDER) -> DataFrame:
    """``docs`` without its text, with n_words, n_features and weight; columns of these names are replaced."""
    made = {"n_words", "n_features", "weight"}
    rest = [c for c in docs.columns if c.lower() not in made and c != text]
    shape = docs.select(rest).select("*", *[F.lit(0).cast("long").alias(c) for c in sorted(made)]).schema
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            column = batch.column(text)
            features, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for grams in interned(column, order, buckets):
                by_slot = gain[grams.bucket]
                # sums by text: occurrences of one n lie in the order of texts
                np.add.at(weight, grams.text, by_slot[grams.slot])
                features += np.bincount(grams.text, minlength=batch.num_rows)
            found = words(column)
            made = {"n_words": np.bincount(found.text, minlength=batch.num_rows), "n_features": features, "weight": weight}
            columns = [pa.array(made[f.name]) if f.name in made else batch.column(f.name) for f in shape]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in shape])

    return docs.select(*rest, text).mapInArrow(run, shape)


def noise(ident: str = "doc_id", seed: int = 42) -> Column:
    """A document's own Gumbel draw, in thousandths rounded down; null ids share one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(ident).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = LEAST_WORDS, ident: str = "doc_id", text: str = "text",
    target_text: str = "text", order: int = ORDER, buckets: int = BUCKETS, seed: int = 42,
) -> DataFrame:
    """``docs`` without its text, with n_words, n_features, weight, score and rank: the ``percent`` of the documents of at least
    ``least_words`` words with the highest scores, ranked from 1; rank is null for all others.

    Drawing by weight plus Gumbel noise is drawing without replacement by the exponential of the weight. Null texts have no word
    and no feature; an empty target has equal shares. Ties of a score go by id, null last; rows that share both by their weight
    and words, and rows equal in all of these are ranked one after the other. Columns that the result adds are replaced, and
    any of the names ``_spread``, ``_place``, ``_part`` and ``_before`` are left out.

    The ranks come from a sort by ranges, numbered in each task and moved by the sizes of the ranges before: no task sees all rows,
    and rows that are equal may lie in several ranges.
    """
    spark = docs.sparkSession
    docs = docs.drop("score", "rank", "_spread", "_place", "_part", "_before")
    gain = gains(counts(docs, text, order, buckets), counts(target, target_text, order, buckets), buckets)
    scored = stored(weighted(docs, gain, text, order).withColumn("score", F.col("weight") + noise(ident, seed)), "resampling-scores")
    fit = F.col("n_words") >= least_words
    # numbers by file and row, so that a task that runs again deals them alike
    mixed = scored.where(fit).withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    order_by = [F.desc("score"), F.asc_nulls_last(ident), F.desc("weight"), "n_words", "_spread"]
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = mixed.repartitionByRange(n_ranges, *order_by).sortWithinPartitions(*order_by).drop("_spread")
    placed = stored(placed.withColumn("_place", F.monotonically_increasing_id()), "resampling-order")
    part, nth = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    # a row per range
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    drawn = percent * placed.count() // 100
    ranked = placed.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("rank", F.col("_before") + nth + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.select(*scored.columns, "rank").unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))
