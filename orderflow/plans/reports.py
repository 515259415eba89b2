"""Summaries and views over the fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.dims import current_customers

# Grouping of the summary, its sort order, trailing days.
SUMMARY_KEYS = ["order_year", "order_month", "order_quarter", "product_category", "region", "channel"]
SUMMARY_ORDER = ["order_year", "order_month", "product_category", "region"]
SUMMARY_DAYS = 90

_SUM = "decimal(24,2)"


def trailing_window(fact: DataFrame, as_of: dt.date, days: int = SUMMARY_DAYS) -> DataFrame:
    """Rows from ``days`` before ``as_of`` on; there is no upper bound.

    The month condition follows from the date condition. It is stated because the target is
    partitioned by year and month, so that older directories are not opened.
    """
    start = as_of - dt.timedelta(days=days)
    month = F.col("order_year") * 12 + F.col("order_month")
    return fact.filter(
        (F.col("order_date") >= F.lit(start)) & (month >= start.year * 12 + start.month))


def late_count(flag: str = "is_late_shipment") -> Column:
    return F.sum(F.when(F.col(flag), 1).otherwise(0))


def late_pct(flag: str = "is_late_shipment") -> Column:
    """Late share in percent; NULL over no rows."""
    rows = F.nullif(F.count(F.lit(1)), F.lit(0))
    return F.round(late_count(flag).cast("double") / rows * 100, 2)


def orders_counted(unique_orders: bool) -> Column:
    """Distinct orders.

    When the input is known to hold one row per order, as after the dedup or in an
    upserted target keyed on order_id, a plain count is the same number, and the second distinct
    (which makes Spark copy every row per distinct column before the shuffle) is not needed.
    """
    return F.count("order_id") if unique_orders else F.count_distinct("order_id")


def summary(
    fact: DataFrame,
    as_of: dt.date,
    days: int = SUMMARY_DAYS,
    unique_orders: bool = False,
) -> DataFrame:
    """Revenue and shipping of the trailing days by month, category, region and channel."""
    return trailing_window(fact, as_of, days).groupBy(*SUMMARY_KEYS).agg(
        orders_counted(unique_orders).alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("quantity").alias("total_units"),
        F.round(F.sum("gross_revenue"), 2).cast(_SUM).alias("total_gross_revenue"),
        F.round(F.sum("net_revenue"), 2).cast(_SUM).alias("total_net_revenue"),
        F.round(F.avg("days_to_ship"), 2).alias("avg_days_to_ship"),
        late_count().alias("late_shipments"),
    )


def summary_template(
    fact: DataFrame, as_of: dt.date, days: int = SUMMARY_DAYS, unique_orders: bool = False
) -> DataFrame:
    """The short form: three measures, unrounded."""
    return trailing_window(fact, as_of, days).groupBy(*SUMMARY_KEYS).agg(
        orders_counted(unique_orders).alias("order_count"),
        F.sum("net_revenue").cast(_SUM).alias("total_net_revenue"),
        F.avg("days_to_ship").alias("avg_days_to_ship"),
    )


def monthly_revenue(fact: DataFrame, unique_orders: bool = False) -> DataFrame:
    return fact.groupBy(*SUMMARY_KEYS, "order_status").agg(
        orders_counted(unique_orders).alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("quantity").alias("total_units"),
        F.sum("gross_revenue").cast(_SUM).alias("total_gross_revenue"),
        F.sum("net_revenue").cast(_SUM).alias("total_net_revenue"),
        F.sum("shipping_cost").cast(_SUM).alias("total_shipping_cost"),
        F.avg("days_to_ship").alias("avg_days_to_ship"),
        late_count().alias("late_shipment_count"),
        late_pct().alias("late_shipment_pct"),
    )


def load_check(fact: DataFrame, run_id: str) -> DataFrame:
    """One row on what a run left in the target: rows, distinct orders, newest load time."""
    return fact.filter(F.col("_run_id") == run_id).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("order_id").alias("unique_orders"),
        F.max("_processed_at").alias("last_load_ts"),
    )


def column_profile(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Rows, NULLs, min, max and distinct values per column, values compared as text.

    Distinct values are estimated by a sketch unless ``exact``. The exact form first counts each
    (column, value) pair, which combines before the shuffle, so a value held by most rows is
    one row per input task.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns]))
    long = df.select(pairs.alias("p")).select("p.*")
    if exact:
        per_value = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        rows, nulls = F.sum("n"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
        distinct = F.count("value")
    else:
        per_value = long
        rows, nulls = F.count(F.lit(1)), F.count_if(F.col("value").isNull())
        distinct = F.approx_count_distinct("value")
    return per_value.groupBy("column_name").agg(
        rows.alias("row_count"),
        nulls.alias("null_count"),
        distinct.alias("distinct_count"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def register_views(spark: SparkSession, fact: DataFrame, customers: DataFrame) -> None:
    """The two reporting views, for use from ``spark.sql``."""
    monthly_revenue(fact).createOrReplaceTempView("v_monthly_revenue")
    current_customers(customers).createOrReplaceTempView("v_current_customers")
