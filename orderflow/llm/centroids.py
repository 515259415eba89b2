"""Lloyd's clustering with vectors cut into blocks of columns.

Vectors are stored once as chunks of rows, a chunk in a piece per block of columns. A round has three steps: tasks on blocks
work out exact partial distances of a chunk's rows to their own slice of each centroid; the partial distances of a chunk meet and are
added, and the nearest centroid of each row is taken; tasks on blocks get these labels and add up their columns by
label, from which each block's slice of the centroids is replaced. All numbers are integers, so sums do not depend on their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.sources.workdir import fresh_dir

# A component's magnitude at most: 64 squares of differences stay below 2 to the 63.
_LARGEST = 1 << 27
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def packed(values: np.ndarray) -> bytes:
    """Integers in the fewest bytes that hold all of them, and how many bytes each has."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    kind = next(t for t in _WIDTHS if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<i{blob[0]}", offset=1).astype(np.int64)


def usable(vector: str, dims: int) -> Column:
    """Whether a vector has ``dims`` components, all of them numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & fine, F.lit(False))


def levels(values: np.ndarray, scale: int) -> np.ndarray:
    found = np.floor(scale * values)
    if (np.abs(found) > _LARGEST).any():
        raise ValueError(f"a component times {scale} is beyond {_LARGEST}, too large for exact distances in 64 bits")
    return found.astype(np.int64)


def first_centroids(kept: DataFrame, k: int, scale: int, seed: int) -> np.ndarray:
    """The k vectors whose seeded id has the smallest SHA-256; of rows with one id the smaller vector. A null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    rows = kept.orderBy(digest, "_vector").limit(k).select("_vector").collect()
    return levels(np.array([r[0] for r in rows], np.float64), scale)


def _chunks(kept: DataFrame, dims: int, width: int, scale: int, rows: int) -> DataFrame:
    """(chunk, block, data, ids): the levels of a chunk's rows in a block's columns; ids are with the first block. Written once."""
    shape = T.StructType().add("chunk", "long").add("block", "integer").add("data", "binary").add("ids", T.ArrayType(kept.schema["_id"].dataType))

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                part = batch.slice(low, rows)
                values = levels(pc.list_flatten(part.column("_vector")).to_numpy().reshape(-1, dims), scale)
                blocks = [values[:, c : c + width] for c in range(0, dims, width)]
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("_id"))
                columns = {
                    "chunk": pa.array([number] * len(blocks)), "block": pa.array(range(len(blocks)), pa.int32()),
                    "data": pa.array([packed(b) for b in blocks], pa.binary()),
                    "ids": pa.concat_arrays([ids, pa.nulls(len(blocks) - 1, ids.type)])}
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in shape], [f.name for f in shape])
                number += 1

    spark = kept.sparkSession
    path = fresh_dir(spark, "vector-chunks")
    kept.mapInArrow(run, shape).write.partitionBy("block").parquet(path)
    return spark.read.schema(shape).parquet(path)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns))


def assigned(chunks: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """(chunk, labels, distances) of all rows to their nearest centroid, of several the first."""

    def partial(batches):
        for batch in batches:
            out = []
            for _, block, data in _pieces(batch):
                own = centroids[:, block * width : (block + 1) * width]
                x = unpacked(data).reshape(-1, own.shape[1])
                out.append(packed((x * x).sum(1)[:, None] - 2 * (x @ own.T) + (own * own).sum(1)))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(out, pa.binary())], ["chunk", "data"])

    def nearest(group: pa.Table) -> pa.Table:
        total = sum(map(unpacked, group.column("data").to_pylist())).reshape(-1, len(centroids))
        label = total.argmin(1)
        return pa.table({
            "chunk": group.column("chunk")[:1], "labels": pa.array([packed(label)], pa.binary()),
            "distances": pa.array([packed(total[np.arange(len(label)), label])], pa.binary())})

    parts = chunks.select("chunk", "block", "data").mapInArrow(partial, "chunk long, data binary")
    return parts.groupBy("chunk").applyInArrow(nearest, "chunk long, labels binary, distances binary")


def _by_label(label: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labels that occur, and the sums of rows by label."""
    order = np.argsort(label, kind="stable")
    found, cuts = np.unique(label[order], return_index=True)
    return found, np.add.reduceat(values[order], cuts, axis=0)


def moved(chunks: DataFrame, labels: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Each block's slice replaced by the means of its columns by label, rounded down; a centroid without rows stays.

    A task sends its sums, one row per block, centroid and column; the driver gets as many numbers as the centroids have.
    """
    k, dims = centroids.shape

    def sums(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data, label in _pieces(batch):
                label = unpacked(label)
                x = unpacked(data).reshape(len(label), -1)
                total = held.setdefault(block, np.zeros((k, x.shape[1] + 1), np.int64))
                at, added = _by_label(label, np.column_stack([x, np.ones(len(x), np.int64)]))
                total[at] += added
        for block, total in held.items():
            at = np.flatnonzero(total[:, -1])
            wide = total.shape[1] - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(at) * wide, block, np.int32)), pa.array(np.repeat(at, wide)), pa.array(np.tile(np.arange(wide), len(at))),
                pa.array(total[at, :-1].ravel()), pa.array(np.repeat(total[at, -1], wide))], ["block", "label", "column", "total", "rows"])

    rows = chunks.select("chunk", "block", "data").join(labels.select("chunk", "labels"), "chunk").select("block", "data", "labels")
    found = rows.mapInArrow(sums, "block int, label long, column long, total long, rows long").groupBy("block", "label", "column").agg(
        F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    out = centroids.copy()
    for r in found.collect():
        out[r["label"], r["block"] * width + r["column"]] = r["total"] // r["rows"]
    return out


def clustered(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, width: int = 32, seed: int = 1,
    ident: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Each usable vector's ``ident``, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256.

    A vector counts if it has exactly ``dims`` components, none of them null, NaN or infinite; a component x is taken as the integer
    floor(scale * x), and one beyond 2 to the 27 is an error. Other vectors, null ones too, are left out. Repeated rows and
    null ids are vectors like others. Fewer than k vectors are as many centroids; no vectors give no rows. Of centroids at one distance
    the one of the smaller number is nearest. Columns besides these two are not in the result.

    ``width`` columns are a block. The driver holds the centroids, k times ``dims`` numbers; a task holds one chunk.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(ident).alias("_id"), F.col(vector).cast("array<double>").alias("_vector"))
    kept = source.where(usable("_vector", dims))
    centroids = first_centroids(kept, k, scale, seed)
    shape = vectors.select(ident, F.lit(0).alias("cluster"), *[
        F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")).schema
    if not len(centroids):
        return spark.createDataFrame([], shape)
    chunks = _chunks(kept, dims, width, scale, max(16, min(4096, (1 << 20) // k)))
    for _ in range(rounds):
        centroids = moved(chunks, assigned(chunks, centroids, width), centroids, width)

    path = fresh_dir(spark, "vector-labels")
    assigned(chunks, centroids, width).write.parquet(path)
    labels = spark.read.parquet(path)

    def spread(batches):
        total = np.zeros(len(centroids), np.int64)
        for batch in batches:
            for label, distance in _pieces(batch):
                at, added = _by_label(unpacked(label), unpacked(distance))
                total[at] += added
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["label", "total"])

    inertia = np.zeros(len(centroids), np.int64)
    sums = labels.select("labels", "distances").mapInArrow(spread, "label long, total long")
    for r in sums.groupBy("label").agg(F.sum("total").alias("total")).collect():
        inertia[r["label"]] = r["total"]
    digests = np.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                label = unpacked(batch.column("labels")[i].as_py())
                columns = [batch.column("ids")[i].values, pa.array(label.astype(np.int32)), pa.array(unpacked(batch.column("distances")[i].as_py())),
                           pa.array(inertia[label]), pa.array(np.full(len(label), inertia.sum())), pa.array(digests[label])]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in shape])

    ids = chunks.where("block = 0").select("chunk", "ids")
    return ids.join(labels, "chunk").select("ids", "labels", "distances").mapInArrow(rows, shape)
