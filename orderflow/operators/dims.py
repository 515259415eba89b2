"""Dimensions: calendar, surrogate-key lookups, versioned customers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.operators.dedup import dedup_latest
from orderflow.schemas import DIM_DATE

# Calendar range, key of an unmatched row, end of an open version.
CALENDAR_START = dt.date(1990, 1, 1)
CALENDAR_END = dt.date(2040, 12, 31)
UNKNOWN_SK = -1
OPEN_END = dt.date(9999, 12, 31)


def date_key(date: Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def calendar_columns(date: Column, as_of: dt.date, fiscal_start_month: int = 1) -> dict[str, Column]:
    """All calendar attributes of a date: ISO weeks, weekday 1 = Monday.

    The fiscal year is named after the calendar year in which it ends.
    """
    fiscal_month = (F.month(date) + (12 - fiscal_start_month)) % 12 + 1
    fiscal_year = F.year(date) + F.when(
        (F.lit(fiscal_start_month) > 1) & (F.month(date) >= fiscal_start_month), 1).otherwise(0)
    fiscal_quarter = F.ceil(fiscal_month / 3)
    weekday = F.weekday(date) + 1
    in_year = F.year(date) == as_of.year
    columns = {
        "date_sk": date_key(date),
        "full_date": date,
        "calendar_year": F.year(date),
        "calendar_quarter": F.quarter(date),
        "calendar_month": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "month_name_short": F.date_format(date, "MMM"),
        "week_of_year": F.weekofyear(date),
        "day_of_year": F.dayofyear(date),
        "day_of_month": F.dayofmonth(date),
        "day_of_week": weekday,
        "day_name": F.date_format(date, "EEEE"),
        "day_name_short": F.date_format(date, "EEE"),
        "is_weekend": weekday >= 6,
        "is_weekday": weekday < 6,
        "fiscal_year": fiscal_year,
        "fiscal_quarter": fiscal_quarter,
        "fiscal_month": fiscal_month,
        "is_current_month": in_year & (F.month(date) == as_of.month),
        "is_current_year": in_year,
        "year_month": F.date_format(date, "yyyy-MM"),
        "quarter_label": F.concat(F.lit("Q"), F.quarter(date), F.lit(" "), F.year(date)),
        "fiscal_quarter_label": F.concat(F.lit("FQ"), fiscal_quarter, F.lit(" "), fiscal_year),
    }
    return {f.name: columns[f.name].cast(f.dataType) for f in DIM_DATE}


def dim_date(
    spark: SparkSession,
    as_of: dt.date,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    fiscal_start_month: int = 1,
) -> DataFrame:
    """The calendar, one row per day (18,628 for the full range)."""
    days = spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return days.select(*[
        c.alias(n) for n, c in calendar_columns(F.col("d"), as_of, fiscal_start_month).items()])


def lookup_dates(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Date keys for order and shipment: an unknown order date is -1, an unknown ship date NULL.

    The calendar is the one side broadcast by hint: its size is fixed by its range.
    """
    for column, key in (("order_date", "order_date_sk"), ("ship_date", "ship_date_sk")):
        role = F.broadcast(calendar.select(F.col("full_date").alias(column), F.col("date_sk").alias(key)))
        df = df.join(role, column, "left")
    return df.withColumn("order_date_sk", F.coalesce("order_date_sk", F.lit(UNKNOWN_SK)))


def disjoint_versions(customers: DataFrame) -> DataFrame:
    """Versions cut off where the customer's next one starts, so that a date falls into one at most.

    Where versions overlap the later start wins; of those that start together, the one with the higher key.
    """
    later = Window.partitionBy("customer_id").orderBy("effective_from", "effective_to", "customer_sk")
    return customers.withColumn(
        "effective_to", F.least("effective_to", F.coalesce(F.lead("effective_from").over(later), F.col("effective_to"))))


def lookup_customer(df: DataFrame, customers: DataFrame) -> DataFrame:
    """Key of the customer version in force on the order date; -1 when there is none.

    Versions hold from ``effective_from`` up to but not including ``effective_to``; overlapping ones are cut first,
    so no row is multiplied. The equality on customer_id makes this a hash or sort-merge join with the range as a
    residual.
    """
    versions = disjoint_versions(customers.select("customer_id", "customer_sk", "effective_from", "effective_to"))
    versions = versions.withColumnRenamed("customer_id", "_cid")
    in_force = (
        (F.col("customer_id") == F.col("_cid"))
        & (F.col("order_date") >= F.col("effective_from"))
        & (F.col("order_date") < F.col("effective_to"))
    )
    return (
        df.join(versions, in_force, "left")
        .withColumn("customer_sk", F.coalesce("customer_sk", F.lit(UNKNOWN_SK).cast("bigint")))
        .drop("_cid", "effective_from", "effective_to")
    )


def lookup_product(df: DataFrame, products: DataFrame) -> DataFrame:
    """Key of the product, of several rows of one product the highest; -1 when there is none."""
    known = products.groupBy("product_id").agg(F.max("product_sk").alias("product_sk"))
    return df.join(known, "product_id", "left").withColumn(
        "product_sk", F.coalesce("product_sk", F.lit(UNKNOWN_SK).cast("bigint")))


def overlapping_versions(customers: DataFrame) -> DataFrame:
    """Versions that start before the previous one of the same customer ended."""
    w = Window.partitionBy("customer_id").orderBy("effective_from", "effective_to")
    return (
        customers.withColumn("_prev_end", F.lag("effective_to").over(w))
        .filter(F.col("effective_from") < F.col("_prev_end"))
        .drop("_prev_end")
    )


def repeated_products(products: DataFrame) -> DataFrame:
    return products.groupBy("product_id").agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def current_customers(customers: DataFrame) -> DataFrame:
    return customers.filter("is_current")


def join_current_customer(df: DataFrame, customers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attributes of the customer's latest version, whatever the order date."""
    latest = current_customers(customers).select(
        "customer_id", *[F.col(c).alias(f"customer_{c.removeprefix('customer_')}") for c in columns])
    return df.join(latest, "customer_id", "left")


def assign_surrogate_keys(df: DataFrame, natural_key: str, sk: str, existing: DataFrame) -> DataFrame:
    """Dense keys above the highest one in ``existing``, in an order fixed by the natural key.

    Rows are numbered inside hash buckets; bucket offsets come from a table of at most 4,096
    counts, so no step sorts all rows in one task.
    """
    bucket = F.conv(F.substring(F.md5(natural_key), 1, 3), 16, 10).cast("int")
    numbered = df.withColumn("_bucket", bucket)
    counts = numbered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # The highest key so far enters the running total as the count of a bucket before the first.
    used = existing.agg(F.coalesce(F.max(sk), F.lit(0)).alias("_n")).withColumn("_bucket", F.lit(-1))
    # One window over all buckets: 4,097 rows whatever the input size.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.unionByName(used).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural_key))
    return (
        numbered.withColumn("_position", position)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(sk, (F.col("_offset") + F.col("_position")).cast("bigint"))
        .drop("_bucket", "_position", "_offset")
    )


VERSION_COLUMNS = ("effective_from", "effective_to", "is_current")


def scd2_changes(
    current: DataFrame, incoming: DataFrame, as_of: dt.date, key: str, sk: str, attributes: Sequence[str],
) -> DataFrame:
    """The versions that a snapshot opens, without their surrogate keys and times, and whether each closes one (``_closes``).

    Columns that the snapshot lacks come from the version that is closed. Of several snapshot rows of a key the greatest counts, compared
    column by column. Raises when ``as_of`` lies before the start of a version to be closed.
    """
    snapshot = dedup_latest(incoming, [key], order_by=[])
    named = [c for c in current.columns if c not in (sk, *VERSION_COLUMNS)]
    before = current.select(
        F.col(key).alias("_key"), F.col("effective_from").alias("_from"), *[F.col(c).alias(f"_old_{c}") for c in named])
    compared = snapshot.join(before, F.col(key) == F.col("_key"), "left")
    differs = reduce(or_, [~F.col(a).eqNullSafe(F.col(f"_old_{a}")) for a in attributes], F.lit(False))
    changed = compared.filter(F.col("_key").isNull() | differs)
    if changed.filter(F.col("_from") > F.lit(as_of)).take(1):
        raise ValueError(f"a version to be closed starts after {as_of}")
    return changed.select(*[F.col(c if c in incoming.columns else f"_old_{c}").alias(c) for c in named], F.col("_key").isNotNull().alias("_closes"))


def scd2_merge(
    dim: DataFrame,
    incoming: DataFrame,
    as_of: dt.date,
    key: str = "customer_id",
    sk: str = "customer_sk",
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Versioned dimension after a new snapshot of the source, as one DataFrame; ``sources.dimension`` keeps a stored one.

    A current version whose attributes differ is closed on ``as_of`` and followed by a new one; unseen keys get
    their first version; keys missing from the snapshot stay as they are. A new version has the snapshot's columns,
    and those that the snapshot lacks from the version it follows. Of several snapshot rows of a key the greatest
    counts, compared column by column. Raises when ``as_of`` lies before the start of a version to be closed.
    """
    changes = scd2_changes(dim.filter("is_current"), incoming, as_of, key, sk, attributes)
    closing = changes.filter("_closes").select(key, "_closes")

    closes = F.col("is_current") & F.coalesce(F.col("_closes"), F.lit(False))
    history = dim.join(closing, key, "left").select(*[
        F.when(closes, F.lit(as_of)).otherwise(F.col(c)).alias(c) if c == "effective_to"
        else F.when(closes, F.lit(False)).otherwise(F.col(c)).alias(c) if c == "is_current"
        else F.col(c)
        for c in dim.columns])

    opened = assign_surrogate_keys(changes.drop("_closes"), key, sk, dim)
    opened = opened.withColumns({
        "effective_from": F.lit(as_of),
        "effective_to": F.lit(OPEN_END),
        "is_current": F.lit(True),
    })
    return history.unionByName(opened)
