"""Report states by month: sums, exact sets of numbered ids, and sketches, all of which merge.

A month's state is worked out once from its rows. Reports over any months and any of the grouping columns add the sums and
unite the sets, so distinct counts are exact without going back to the rows and without a copy of each row per distinct column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.dims import assign_surrogate_keys
from orderflow.plans.reports import SUMMARY_DAYS, SUMMARY_KEYS, late_count
from orderflow.schemas import STAGED_PARTITIONS
from orderflow.sources import target
from orderflow.sources.workdir import empty, exists, read_file, replace_file, shuffles_go, stored

# Counted ids, and what their counts are called.
ENTITIES = {"order_id": "order_count", "customer_id": "customer_count"}
# A sketch's registers: 2 to this; its standard error is some 0.8 %.
SKETCH_BITS = 14
_SUM = "decimal(24,2)"
# What states and reports are made of.
SOURCE_COLUMNS = [*SUMMARY_KEYS, *ENTITIES, "order_date", "quantity", "gross_revenue", "net_revenue", "days_to_ship", "is_late_shipment"]
_SUMS = ["total_units", "total_gross_revenue", "total_net_revenue", "days_sum", "days_count", "late_shipments"]


def numbered(ids: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, number) of the distinct ids that ``known`` lacks, numbered densely after its highest."""
    fresh = ids.select(F.col(column).alias("value")).filter("value is not null").distinct()
    if known is None:
        known = empty(ids.sparkSession, fresh.withColumn("number", F.lit(0).cast("bigint")).schema)
    else:
        fresh = fresh.join(known, "value", "left_anti")
    return assign_surrogate_keys(fresh, "value", "number", known)


def groups_of(fact: DataFrame, keys: Sequence[str] = SUMMARY_KEYS) -> DataFrame:
    """(keys, group): the groups that occur, stored with a number each, so that rows need not take their keys along when they move."""
    return stored(fact.select(*keys).distinct().withColumn("group", F.monotonically_increasing_id()), "groups")


def grouped(fact: DataFrame, groups: DataFrame) -> DataFrame:
    """``fact`` with each row's group number instead of its keys; there is a group for every row, whichever keys are NULL."""
    keys = [c for c in groups.columns if c != "group"]
    theirs = groups.select("group", *[F.col(c).alias(f"_group_{c}") for c in keys])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_group_{c}")) for c in keys], F.lit(True))
    return fact.join(theirs, same).select("group", *[c for c in fact.columns if c not in keys])


def sums(fact: DataFrame, keys: Sequence[str] = SUMMARY_KEYS) -> DataFrame:
    """A row per group: what adds up."""
    return fact.groupBy(*keys).agg(
        F.sum("quantity").cast("bigint").alias("total_units"),
        F.sum("gross_revenue").cast(_SUM).alias("total_gross_revenue"),
        F.sum("net_revenue").cast(_SUM).alias("total_net_revenue"),
        F.sum("days_to_ship").cast("bigint").alias("days_sum"),
        F.count("days_to_ship").alias("days_count"),
        late_count().cast("bigint").alias("late_shipments"))


def sums_and_sketches(fact: DataFrame, groups: DataFrame) -> DataFrame:
    """``sums``, and sketches of the counted ids.

    Aggregations with sketches sort their rows where there are many groups; they do so apart from the sums, with the ids alone.
    """
    rows = grouped(fact, groups)
    sketches = rows.select("group", *ENTITIES).groupBy("group").agg(*[F.hll_sketch_agg(c, SKETCH_BITS).alias(f"{c}_sketch") for c in ENTITIES])
    return sums(rows, ["group"]).join(sketches, "group").join(groups, "group").drop("group")


def id_sets(fact: DataFrame, column: str, numbers: DataFrame, keys: Sequence[str] = SUMMARY_KEYS, groups: DataFrame | None = None) -> DataFrame:
    """(keys, entity, bucket, bitmap): the numbers of a group's ids, a bitmap for each 32,768 of them that has any.

    A row moves twice: with its id to the id's number, in a join that adaptive execution can split where an id has many rows, and with the number
    to its bitmap. It has the number of its group (``groups``, which is worked out if not given) for its keys. Numbers go to
    their bitmap's task as they are: a group's ids are spread over all tasks of the join, which would send 4 KB for nearly each of them.
    """
    if groups is None:
        groups = groups_of(fact, keys)
    rows = grouped(fact.select(*keys, F.col(column).alias("value")).filter("value is not null"), groups)
    number = F.col("number")
    placed = rows.join(numbers, "value").select(
        "group", F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).cast("int").alias("position"))
    bitmaps = placed.repartition("group", "bucket").groupBy("group", F.lit(column).alias("entity"), "bucket").agg(
        F.bitmap_construct_agg(F.col("position").cast("bigint")).alias("bitmap"))
    return bitmaps.join(groups, "group").select(*keys, "entity", "bucket", "bitmap")


def _places(root: str) -> tuple[str, str]:
    return f"{root}/sums", f"{root}/ids"


def known_numbers(spark: SparkSession, root: str, column: str) -> DataFrame | None:
    path = f"{root}/numbers/{column}"
    return spark.read.parquet(path) if exists(spark, path) else None


def write_states(fact: DataFrame, root: str, keys: Sequence[str] = SUMMARY_KEYS) -> None:
    """The states of the months that ``fact`` has rows of, replacing those months' own. ``fact`` must hold whole months.

    ``keys`` need the year and month. New ids are numbered after the known ones; numbers never change, so that states of other
    months stay valid. Rows without a month are left out. ``fact`` is scanned a few times: store it first when it is costly to compute.
    """
    spark = fact.sparkSession
    dated = fact.filter(" and ".join(f"{c} is not null" for c in STAGED_PARTITIONS))
    sums_at, ids_at = _places(root)

    def put(rows: DataFrame, path: str) -> None:
        rows.hint("rebalance", *STAGED_PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
            "compression", "zstd").partitionBy(*STAGED_PARTITIONS).parquet(path)

    groups, sets = groups_of(dated, keys), None
    with shuffles_go(spark):
        put(sums_and_sketches(dated, groups), sums_at)
        for column in ENTITIES:
            numbered(dated, column, known_numbers(spark, root, column)).write.mode("append").option(
                "compression", "zstd").parquet(f"{root}/numbers/{column}")
            own = id_sets(dated, column, known_numbers(spark, root, column), keys, groups)
            sets = own if sets is None else sets.unionByName(own)
        put(sets, ids_at)


def refresh_states(spark: SparkSession, root: str, target_root: str) -> list[tuple[int, int]]:
    """States of a published target's months brought up to its newest version; returns the months worked out anew.

    Those are the months whose folders are not the ones their states were made from. A month that lost all rows loses its states.
    """
    version = target.head(spark, target_root)
    text = read_file(spark, f"{root}/version")
    old = target.Version.of_text(text) if text else target.Version()

    def by_month(v: target.Version) -> dict[tuple[int, int], set[str]]:
        found: dict[tuple[int, int], set[str]] = {}
        for f in v.folders:
            found.setdefault((f.order_year, f.order_month), set()).add(f.path)
        return found

    now, before = by_month(version), by_month(old)
    changed = sorted(m for m in now | before if now.get(m) != before.get(m))
    if changed:
        wanted = [f for f in version.folders if (f.order_year, f.order_month) in changed]
        if wanted:
            write_states(target.read_folders(spark, target_root, wanted), root)
        for year, month in changed:
            if (year, month) not in now:
                for place in _places(root):
                    target.discard_if_there(spark, f"{place}/order_year={year}/order_month={month}")
    replace_file(spark, f"{root}/version", version.as_text())
    return changed


def _counted(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ids per group of any keys, from bitmaps united first."""
    united = sets.groupBy(*keys, "entity", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return united.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("entity") == c, F.bitmap_count("bitmap"))), F.lit(0)).alias(n) for c, n in ENTITIES.items()])


def merged(states: DataFrame, sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group of ``keys``, which may be fewer than the states have: the sums, and both distinct counts.

    Sums and counts meet in a last aggregation, not in a join, so groups with a NULL in their keys need no care.
    """
    counts = _counted(sets, keys)
    parts = states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
    both = parts.unionByName(counts, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[
        F.coalesce(F.sum(n), F.lit(0)).alias(n) if n in ENTITIES.values() else F.sum(n).alias(n) for n in (*ENTITIES.values(), *_SUMS)])


def read_states(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    sums_at, ids_at = _places(root)
    return spark.read.parquet(sums_at), spark.read.parquet(ids_at)


def rollup(spark: SparkSession, root: str, keys: Sequence[str], condition: Column | None = None) -> DataFrame:
    """A report over stored months by any of their keys; ``condition`` is on keys."""
    states, sets = read_states(spark, root)
    if condition is not None:
        states, sets = states.filter(condition), sets.filter(condition)
    return merged(states, sets, keys)


def approximate_counts(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Both distinct counts from merged sketches: a few kilobytes a group, however many ids."""
    states, _ = read_states(spark, root)
    return states.groupBy(*keys).agg(*[
        F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(n) for c, n in ENTITIES.items()])


def summary_from_states(spark: SparkSession, root: str, fact: DataFrame, as_of: dt.date, days: int = SUMMARY_DAYS) -> DataFrame:
    """``reports.summary`` from stored months; only the month that the window cuts is read from ``fact``."""
    start = as_of - dt.timedelta(days=days)
    month = F.col("order_year") * 12 + F.col("order_month")
    cut = fact.filter((F.col("order_year") == start.year) & (F.col("order_month") == start.month) & (F.col("order_date") >= F.lit(start)))
    states, sets = (rows.filter(month > start.year * 12 + start.month) for rows in read_states(spark, root))
    for c in STAGED_PARTITIONS:
        states, sets = (rows.withColumn(c, F.col(c).cast(fact.schema[c].dataType)) for rows in (states, sets))
    states = states.select(*SUMMARY_KEYS, *_SUMS).unionByName(sums(cut))
    for column in ENTITIES:
        sets = sets.unionByName(id_sets(cut, column, known_numbers(spark, root, column)))
    rows = merged(states, sets, SUMMARY_KEYS)
    return rows.select(
        *SUMMARY_KEYS, *ENTITIES.values(), "total_units",
        F.round("total_gross_revenue", 2).cast(_SUM).alias("total_gross_revenue"),
        F.round("total_net_revenue", 2).cast(_SUM).alias("total_net_revenue"),
        F.round(F.col("days_sum") / F.nullif("days_count", F.lit(0)), 2).alias("avg_days_to_ship"), "late_shipments")
