"""Mixing sources to target weights with fixed-length token blocks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderflow.llm.text import texts
from orderflow.sources.workdir import stored

# Parts of a source whose running offsets are summed apart, so that a source with a third of all rows is no single task.
CHUNKS = 4096
_GROUPS = 256


def targets(sizes: list[int], weights: list[float], limit: float = 3.0) -> list[float]:
    """Words wanted of each source: all words shared out by weight, none above ``limit`` times its size.

    What a source can't give goes to the others by weight, until none is above.
    """
    caps, want = [limit * s for s in sizes], [0.0] * len(sizes)
    free, left = set(range(len(sizes))), float(sum(sizes))
    while free:
        share = left / sum(weights[i] for i in free)
        full = {i for i in free if share * weights[i] >= caps[i]}
        for i in full or free:
            want[i] = float(caps[i]) if full else share * weights[i]
        if not full:
            break
        left -= sum(caps[i] for i in full)
        free -= full
    return want


def multinomials(quota: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A row of source counts for each shard: multinomial over what remains of each source's quota.

    A draw beyond the rest of a source is drawn anew from the others, so that columns sum to ``quota``.
    """
    left, rows = quota.astype(np.int64).copy(), np.zeros((len(sizes), len(quota)), np.int64)
    for k, size in enumerate(sizes):
        need = int(size)
        while need and left.any():
            got = np.minimum(rng.multinomial(need, left / left.sum()), left)
            rows[k] += got
            left -= got
            need -= int(got.sum())
    return rows


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Image of each index below n under a pseudorandom permutation of 0..n-1: a keyed Feistel network, walked until below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo = index.astype(np.uint64), np.ones(len(index), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for step in range(4):
            x = right + np.uint64((key + step * 0x9E3779B97F4A7C15) & (2**64 - 1))
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def sized(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, text_hash, ``skey`` (the source without null) and ``chunk``; ``keep`` may name the text."""

    def count(batches):
        for batch in batches:
            bodies = texts(batch.column("text"))
            sizes = pa.array([len(t.split()) for t in bodies], pa.int64())
            digests = pa.array(np.array([xxh64_intdigest(t) for t in bodies], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), sizes, digests, *(batch.column(c) for c in keep)],
                                             ["doc_id", "source", "size", "text_hash", *keep])

    schema = "doc_id long, source string, size long, text_hash long" + "".join(f", {c} string" for c in keep)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text").mapInArrow(count, schema)
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    return rows.withColumn("skey", key).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(CHUNKS)).cast("int"))


def chunk_bases(rows: DataFrame) -> DataFrame:
    """skey, chunk, base: the words of a source in the chunks before, of which it has a bounded number."""
    before = Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("skey", "chunk").agg(F.sum("size").alias("words"))
    return totals.select("skey", "chunk", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))


def offsets(rows: DataFrame, bases: DataFrame) -> DataFrame:
    """Adds ``start``, the words of the same source before a row. Rows with words have distinct starts within a source.

    Rows of one id go by their texts' hash, so that whoever computes the starts anew gets the same; rows that share both have one text.
    """
    order = Window.partitionBy("skey", "chunk").orderBy("doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("start", F.coalesce(F.sum("size").over(order), F.lit(0)))
    return inside.join(bases, ["skey", "chunk"]).withColumn("start", F.col("start") + F.col("base")).drop("base", "chunk", "text_hash")


def pieces(packed: DataFrame, block_words: int) -> DataFrame:
    """A row for each part of a document in a block: skey, block, start, doc_id, from_word, n_words."""
    end = F.col("start") + F.col("size")
    block = F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words)))
    cut = packed.where("size > 0").select("*", block.alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(end, (F.col("block") + 1) * block_words)
    return cut.select("skey", "source", "block", "start", "doc_id", (low - F.col("start")).alias("from_word"), (high - low).alias("n_words"))


def plan(rows: DataFrame, weights: tuple[float, ...], limit: float) -> pd.DataFrame:
    """One row per source on the driver, by code point, null last: skey, words, weight, target."""
    per = rows.groupBy("skey").agg(F.sum("size").alias("words")).toPandas()
    per["null"] = per["skey"] == ""
    per = per.sort_values(["null", "skey"], key=lambda c: c if c.name == "null" else c.map(lambda s: s.encode())).reset_index(drop=True)
    per["weight"] = [float(weights[i % len(weights)]) for i in range(len(per))]
    per["target"] = targets([int(x) for x in per["words"]], list(per["weight"]), limit)
    return per[["skey", "words", "weight", "target"]]


def slots(spark, per: pd.DataFrame, block_words: int, shard_blocks: int, seed: int) -> DataFrame:
    """(shard, slot, skey, block, epoch): which block of which source fills each slot of each output shard.

    A source's quota is its target over its mean block length. The driver draws counts for at most 256 groups of
    shards; each group's shards are drawn in a task from a seed of their own. The r-th slot of a source takes the
    block to which the source's permutation of pass r // blocks maps r mod blocks, so a block comes again only
    after all others.
    """
    per = per[per["words"] > 0]
    keys, words = per["skey"].tolist(), per["words"].to_numpy(np.int64)
    blocks = -(-words // block_words)
    quota = np.rint(per["target"].to_numpy() / (words / np.maximum(blocks, 1))).astype(np.int64) if len(per) else blocks
    total = int(quota.sum())
    shards = -(-total // shard_blocks)
    group = max(1, -(-shards // _GROUPS)) * shard_blocks
    room = np.diff(np.append(np.arange(0, total, group), total))
    counts = multinomials(quota, room, np.random.default_rng(seed))
    firsts = np.cumsum(counts, axis=0) - counts
    rows = [(g, int(room[g]), counts[g].tolist(), firsts[g].tolist()) for g in range(len(room))]

    def fill(frames):
        for frame in frames:
            for g, size, count, first in frame.itertuples(index=False):
                rng = np.random.default_rng([seed, 1, int(g)])
                inner = np.diff(np.append(np.arange(0, size, shard_blocks), size))
                count, rank = np.asarray(count, np.int64), np.asarray(first, np.int64).copy()
                for k, drawn in enumerate(multinomials(count, inner, rng)):
                    source = np.repeat(np.arange(len(drawn)), drawn)
                    ranks = np.concatenate([np.arange(r, r + c) for r, c in zip(rank, drawn)])
                    rank += drawn
                    block, epoch = np.zeros(len(ranks), np.int64), ranks // blocks[source]
                    for s, e in {(int(a), int(b)) for a, b in zip(source, epoch)}:
                        mine = (source == s) & (epoch == e)
                        block[mine] = permuted(ranks[mine] % blocks[s], int(blocks[s]), hash((seed, s, e)) & (2**64 - 1))
                    yield pd.DataFrame({"shard": int(g) * (group // shard_blocks) + k, "slot": rng.permutation(len(ranks)),
                                        "skey": np.array(keys, object)[source], "block": block, "epoch": epoch})

    made = spark.createDataFrame(rows, "g int, size long, counts array<long>, firsts array<long>")
    return made.repartition(max(1, len(rows)), "g").mapInPandas(fill, "shard long, slot long, skey string, block long, epoch long")


@dataclass(frozen=True)
class Mix:
    """``packed``: doc_id, source, size, skey, start of every document. ``sources``: skey, words, weight, target.
    ``slots``: shard, slot, skey, block, epoch. ``bases``: words before each chunk of a source."""

    packed: DataFrame
    sources: DataFrame
    slots: DataFrame
    bases: DataFrame
    block_words: int

    def parts(self) -> DataFrame:
        """The parts of documents in each slot: skey, source, block, start, doc_id, from_word, n_words, shard, slot, epoch."""
        return pieces(self.packed, self.block_words).join(self.slots, ["skey", "block"])


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0, block_words: int = 64,
        shard_blocks: int = 8192, seed: int = 10) -> Mix:
    """Documents' words packed into blocks and drawn into shards by source.

    The driver holds one row per source. Null text has size 0 and is in no block; a null source is a source, the
    last; equal rows are packed one after the other; an empty table gives empty results. All that grows is written
    to the shared folder, so joins know its size and lost executors do not repeat it.
    """
    spark = docs.sparkSession
    rows = stored(sized(docs), "sizes")
    bases = chunk_bases(rows)
    packed = stored(offsets(rows, bases), "packed")
    per = plan(packed, weights, limit)
    filled = stored(slots(spark, per, block_words, shard_blocks, seed), "slots")
    return Mix(packed, spark.createDataFrame(per, "skey string, words long, weight double, target double"), filled, bases, block_words)


def with_text(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mix with the words of each part, single-spaced, as column ``text``: shard, slot, epoch, source, doc_id, from_word, n_words, text.

    Each document is cut once, and its parts are joined with the slots that take their blocks.
    """
    n_words = mixed.block_words

    def cut(batches):
        for batch in batches:
            rows = []
            for key, source, doc, start, text in zip(*(batch.column(c).to_pylist() for c in ("skey", "source", "doc_id", "start")), texts(batch.column("text"))):
                words, low = text.split(), 0
                while low < len(words):
                    block = (start + low) // n_words
                    high = min(len(words), (block + 1) * n_words - start)
                    rows.append((key, source, block, doc, low, high - low, b" ".join(words[low:high])))
                    low = high
                    if len(rows) == 4096:
                        yield made(rows)
                        rows = []
            yield made(rows)

    def made(rows):
        columns = zip(*rows) if rows else [[]] * 7
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names).cast(pa.schema([*zip(names, types[:-1]), ("text", pa.string())]))

    names = ["skey", "source", "block", "doc_id", "from_word", "n_words", "text"]
    whole = offsets(sized(docs, ("text",)), mixed.bases).where("size > 0").select("skey", "source", "doc_id", "start", "text")
    parts = whole.mapInArrow(cut, "skey string, source string, block long, doc_id long, from_word long, n_words long, text string")
    return parts.join(mixed.slots, ["skey", "block"]).select("shard", "slot", "epoch", "source", "doc_id", "from_word", "n_words", "text")
