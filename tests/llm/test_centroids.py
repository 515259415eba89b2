"""Clusters against a plain second implementation in Python integers."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from orderflow.llm import centroids, queries


def brute(rows, k=16, rounds=3, dims=64, scale=64):
    """The expected rows of (vec_id, embedding) pairs."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    digest = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    middles = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middles))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(middles)):
            mine = [v for (_, v), o in zip(kept, own) if o == n]
            if mine:
                middles[n] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [(i, *nearest(v)) for i, v in kept]
    by = [sum(d for _, d, n in found if n == m) for m in range(len(middles))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    return [(i, n, d, by[n], sum(by), sha[n]) for i, d, n in found]


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("width", [1, 2, 3, 4, 9])
def test_any_cut_of_the_columns(spark, width):
    rows = [(i, [math.sin(i * (j + 3)) * (1 + i % 5) for j in range(4)]) for i in range(90)]
    rows = [tuple(r) for r in vectors(spark, rows).collect()]
    got = centroids.clustered(vectors(spark, rows).repartition(4), k=5, dims=4, width=width)
    assert rows_of(got) == sorted(brute(rows, k=5, dims=4), key=str)


def test_unusable_vectors_ties_repeats_and_nulls(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.5]), (1, [0.0, 0.5]), (1, [0.25, 0.5]), (None, [1.0, -1.0]), (None, [1.0, -1.0]), (2, [-1.0, -0.0]), (3, None), (4, []),
            (5, [1.0]), (6, [1.0, 2.0, 3.0]), (7, [None, 1.0]), (8, [nan, 1.0]), (9, [inf, 0.0]), (10, [-inf, 0.0]), (11, [0.015624, -0.015624]),
            (12, [1000.0, -2000.0]), *((13 + i, [0.5, 0.5]) for i in range(40))]
    frame = vectors(spark, rows).selectExpr("*", "'x' as cluster", "1 as distance", "2 as chunk", "3 as ids", "4 as _id")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    for k in (1, 3, 60):
        assert rows_of(centroids.clustered(frame, k=k, dims=2, width=1)) == sorted(brute(rows, k=k, dims=2), key=str)


def test_empty_centroids_stay(spark):
    rows = [(i, [1.0, 1.0]) for i in range(20)]
    got = rows_of(centroids.clustered(vectors(spark, rows), k=4, dims=2, width=2))
    assert got == sorted(brute(rows, k=4, dims=2), key=str) and {r[1] for r in got} == {0}


def test_no_vectors(spark):
    got = centroids.clustered(vectors(spark, [(1, [1.0])]), dims=2)
    assert got.collect() == [] and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_text_ids(spark):
    rows = [(f"v{i}", [float(i % 3), 0.5]) for i in range(9)]
    got = centroids.clustered(spark.createDataFrame(rows, "name string, v array<double>"), k=2, dims=2, width=1, ident="name", vector="v")
    assert rows_of(got) == sorted(brute(rows, k=2, dims=2), key=str)


def test_components_too_large_for_exact_distances(spark):
    with pytest.raises(Exception, match="too large for exact distances"):
        centroids.clustered(vectors(spark, [(1, [1e30, 0.0])]), dims=2)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = queries.QUERIES["op13_centroid_clustering"](spark, sf_dir)
    assert dict(got.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint",
                                "centroid_sha256": "string"}
    assert rows_of(got) == sorted(brute(rows), key=str)
    assert got.agg(F.count_distinct("cluster")).first()[0] > 1
