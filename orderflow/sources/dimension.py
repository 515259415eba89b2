"""A dimension with versions as a stored table in two parts: what is current, and what has expired.

A merge reads and rewrites the current rows only; the rows it closes are appended to the history, whose files are never touched
again. Which folders count is said by a version file, so readers see the state before a merge or after it.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators.dims import OPEN_END, assign_surrogate_keys, scd2_changes
from orderflow.sources import versions
from orderflow.sources.workdir import stored_observed


@dataclass(frozen=True)
class Version:
    """``top`` is the highest surrogate key ever given; paths are below the root."""

    number: int = 0
    run_id: str | None = None
    current: str | None = None
    history: tuple[str, ...] = ()
    top: int = 0
    schema: str = ""


def head(spark: SparkSession, root: str) -> Version:
    number, text = versions.newest(spark, root)
    if not number:
        return Version()
    fields = json.loads(text)
    return Version(**{**fields, "number": number, "history": tuple(fields["history"])})


def _read(spark: SparkSession, root: str, version: Version, paths: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(version.schema))
    return spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in paths]) if paths else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The versions in force; no history is opened."""
    version = head(spark, root)
    return _read(spark, root, version, [version.current])


def read(spark: SparkSession, root: str) -> DataFrame:
    version = head(spark, root)
    return _read(spark, root, version, [version.current, *version.history])


def _put(root: str, rows: DataFrame, part: str, run_id: str) -> str:
    path = f"{part}/run_id={run_id}"
    rows.write.mode("overwrite").parquet(f"{root}/{path}")
    return path


def _commit(spark: SparkSession, root: str, before: Version, after: Version) -> None:
    fields = {k: v for k, v in vars(after).items() if k != "number"}
    versions.commit(spark, root, after.number, json.dumps(fields), after.run_id, before.run_id)


def _is_published(spark: SparkSession, root: str, before: Version, run_id: str) -> bool:
    return before.run_id == run_id or versions.is_marked(spark, root, run_id)


def create(spark: SparkSession, root: str, dim: DataFrame, run_id: str, sk: str = "customer_sk") -> None:
    """Store a dimension that was kept elsewhere as the first version."""
    before = head(spark, root)
    if _is_published(spark, root, before, run_id):
        return
    if before.number:
        raise versions.CommitConflict(f"{root} holds a dimension already")
    top = dim.agg(F.coalesce(F.max(sk), F.lit(0))).first()[0]
    current, history = dim.filter("is_current"), dim.filter("not is_current")
    after = Version(1, run_id, _put(root, current, "current", run_id), (_put(root, history, "history", run_id),), top, json.dumps(dim.schema.jsonValue()))
    _commit(spark, root, before, after)


def merge(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    as_of: dt.date,
    run_id: str,
    key: str = "customer_id",
    sk: str = "customer_sk",
    attributes: Sequence[str] = (),
) -> tuple[int, int]:
    """``dims.scd2_merge`` on a stored dimension; returns how many versions were opened and closed.

    The changes are worked out once and stored. A merge of a run that is published does nothing, one without changes makes a version
    that names the same files. Raises ``CommitConflict`` when another merge was faster, and then changes nothing.
    """
    before = head(spark, root)
    if _is_published(spark, root, before, run_id):
        return 0, 0
    if not before.number:
        raise ValueError(f"no dimension at {root}")
    current = _read(spark, root, before, [before.current])
    fresh = scd2_changes(current, incoming, as_of, key, sk, attributes)
    count = [F.count(F.lit(1)).alias("opened"), F.count_if("_closes").alias("closed")]
    changes, seen = stored_observed(fresh, "scd2-changes", *count)
    after = Version(before.number + 1, run_id, before.current, before.history, before.top, before.schema)
    if seen["opened"]:
        known = spark.range(1).select(F.lit(before.top).cast("bigint").alias(sk))
        opened = assign_surrogate_keys(changes.drop("_closes"), key, sk, known).withColumns(
            {"effective_from": F.lit(as_of), "effective_to": F.lit(OPEN_END), "is_current": F.lit(True)})
        closing = changes.filter("_closes").select(key)
        kept = current.join(closing, key, "left_anti")
        names = current.columns
        now = _put(root, kept.unionByName(opened.select(*names)), "current", run_id)
        history = before.history
        if seen["closed"]:
            closed = current.join(closing, key, "left_semi").withColumns({"effective_to": F.lit(as_of), "is_current": F.lit(False)})
            history = (*history, _put(root, closed.select(*names), "history", run_id))
        after = Version(after.number, run_id, now, history, before.top + seen["opened"], before.schema)
    _commit(spark, root, before, after)
    return seen["opened"], seen["closed"]
