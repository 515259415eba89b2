"""A stored dimension against the merge as one DataFrame, and what its merges leave alone."""

import datetime as dt
import os

import pytest

from orderflow.operators import dims
from orderflow.sources import dimension, versions

SCHEMA = "customer_sk bigint, customer_id string, customer_segment string, email string, effective_from date, effective_to date, is_current boolean"
END = dt.date(9999, 12, 31)


def base(spark):
    start, middle = dt.date(2020, 1, 1), dt.date(2021, 1, 1)
    rows = [(1, "a", "x", "a@", start, middle, False), (2, "a", "y", "a@", middle, END, True), (3, "b", None, "b@", start, END, True), (4, "c", "z", None, start, END, True)]
    return spark.createDataFrame(rows, SCHEMA)


def incoming(spark, *rows):
    return spark.createDataFrame(rows, "customer_id string, customer_segment string")


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{root}/history") for f in fs}


def rows_of(frame):
    return sorted(map(tuple, frame.select("customer_sk", "customer_id", "customer_segment", "email", "effective_from", "effective_to", "is_current").collect()), key=str)


def test_equals_the_merge_and_leaves_history_alone(spark, tmp_path):
    root, whole = str(tmp_path / "dim"), base(spark)
    dimension.create(spark, root, whole, "base")
    snapshots = [incoming(spark, ("a", "y2"), ("b", None), ("n", "new"), ("n", "NEW")), incoming(spark, ("a", "y3"), ("b", "b2"), ("c", "z")), incoming(spark, ("c", "z"))]
    for i, snapshot in enumerate(snapshots):
        before = files(root)
        day = dt.date(2024, 1 + i, 1)
        got = dimension.merge(spark, root, snapshot, day, f"run-{i}", attributes=["customer_segment"])
        whole = dims.scd2_merge(whole, snapshot, day, attributes=["customer_segment"])
        assert got == [(2, 1), (2, 2), (0, 0)][i]
        assert rows_of(dimension.read(spark, root)) == rows_of(whole)
        assert before.items() <= files(root).items()
        assert rows_of(dimension.read_current(spark, root)) == rows_of(whole.filter("is_current"))
    # nothing changed: the same files are named
    assert len(dimension.head(spark, root).history) == 3 and dimension.head(spark, root).current.endswith("run-1")


def test_a_run_counts_once(spark, tmp_path):
    root = str(tmp_path / "dim")
    dimension.create(spark, root, base(spark), "base")
    dimension.create(spark, root, base(spark), "base")
    one = incoming(spark, ("a", "y2"))
    assert dimension.merge(spark, root, one, dt.date(2024, 1, 1), "r", attributes=["customer_segment"]) == (1, 1)
    assert dimension.merge(spark, root, incoming(spark, ("a", "y3")), dt.date(2024, 2, 1), "s", attributes=["customer_segment"]) == (1, 1)
    before = rows_of(dimension.read(spark, root))
    assert dimension.merge(spark, root, one, dt.date(2024, 3, 1), "r", attributes=["customer_segment"]) == (0, 0)
    assert rows_of(dimension.read(spark, root)) == before
    with pytest.raises(versions.CommitConflict):
        dimension.create(spark, root, base(spark), "other")


def test_the_second_of_two_merges_fails_and_a_dead_one_blocks_nobody(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "dim")
    dimension.create(spark, root, base(spark), "base")
    put, args = dimension._put, dict(attributes=["customer_segment"])

    def overtaken(*a):
        monkeypatch.setattr(dimension, "_put", put)
        dimension.merge(spark, root, incoming(spark, ("b", "fast")), dt.date(2024, 1, 1), "fast", **args)
        return put(*a)

    monkeypatch.setattr(dimension, "_put", overtaken)
    with pytest.raises(versions.CommitConflict):
        dimension.merge(spark, root, incoming(spark, ("b", "slow")), dt.date(2024, 1, 1), "slow", **args)
    monkeypatch.setattr(dimension, "_put", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        dimension.merge(spark, root, incoming(spark, ("b", "dead")), dt.date(2024, 1, 2), "dead", **args)
    monkeypatch.setattr(dimension, "_put", put)
    assert dimension.merge(spark, root, incoming(spark, ("b", "slow")), dt.date(2024, 1, 2), "slow", **args) == (1, 1)
    assert [r["customer_segment"] for r in dimension.read_current(spark, root).filter("customer_id = 'b'").collect()] == ["slow"]


def test_times_that_go_back_are_refused(spark, tmp_path):
    root = str(tmp_path / "dim")
    dimension.create(spark, root, base(spark), "base")
    with pytest.raises(ValueError, match="starts after"):
        dimension.merge(spark, root, incoming(spark, ("a", "q")), dt.date(2020, 6, 1), "r", attributes=["customer_segment"])
    with pytest.raises(ValueError, match="no dimension"):
        dimension.merge(spark, str(tmp_path / "none"), incoming(spark, ("a", "q")), dt.date(2024, 6, 1), "r")
