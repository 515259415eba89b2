"""Raw text orders to typed, enriched orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.context import RunContext
from orderflow.functions import lower_trim, to_date, to_int, to_price, to_rate, upper_trim
from orderflow.operators.dedup import dedup_latest
from orderflow.schemas import AMOUNT, CLEAN, PRICE, RATE, RAW

# Fixed value: more days than this between order and shipment is late.
SLA_DAYS = 7


def cast_types(df: DataFrame) -> DataFrame:
    """Dates, quantity and money; a missing or unreadable discount or shipping cost is 0."""
    return df.withColumns({
        "order_date": to_date(F.col("order_date")),
        "ship_date": to_date(F.col("ship_date")),
        "quantity": to_int(F.col("quantity")),
        "unit_price": to_price(F.col("unit_price")),
        "discount": F.coalesce(to_rate(F.col("discount")), F.lit(0).cast(RATE)),
        "shipping_cost": F.coalesce(to_price(F.col("shipping_cost")), F.lit(0).cast(PRICE)),
    })


def add_revenue(df: DataFrame) -> DataFrame:
    """Exact decimal products, rounded half up once at the end; NULL when out of range."""
    gross = F.col("quantity") * F.col("unit_price")
    net = gross * (F.lit(1) - F.col("discount"))
    return df.withColumns({
        "gross_revenue": F.round(gross, 2).try_cast(AMOUNT),
        "net_revenue": F.round(net, 2).try_cast(AMOUNT),
    })


def add_shipping(df: DataFrame, sla_days: int = SLA_DAYS) -> DataFrame:
    days = F.datediff("ship_date", "order_date")
    return df.withColumns({
        "days_to_ship": days,
        "is_late_shipment": F.coalesce(days > sla_days, F.lit(False)),
    })


def add_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
        "order_quarter": F.quarter("order_date"),
    })


def standardise(df: DataFrame) -> DataFrame:
    trimmed = ("order_status", "order_priority", "ship_mode", "product_category")
    return df.withColumns({
        **{c: F.trim(c) for c in trimmed},
        **{c: upper_trim(F.col(c)) for c in ("region", "country")},
        "channel": lower_trim(F.col("channel")),
    })


def stamp(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumns({
        "_job_name": F.lit(ctx.job_name),
        "_run_id": F.lit(ctx.run_id),
        "_processed_at": F.lit(ctx.run_ts),
    })


def derive(df: DataFrame, ctx: RunContext, sla_days: int = SLA_DAYS) -> DataFrame:
    """What follows from the typed columns of a row, or is the same for the whole run."""
    return stamp(add_date_parts(add_shipping(add_revenue(df), sla_days)), ctx)


def enrich(df: DataFrame, ctx: RunContext, sla_days: int = SLA_DAYS) -> DataFrame:
    """Everything but the dedup: one projection over the scan."""
    return derive(standardise(cast_types(df)), ctx, sla_days)


def transform(
    df: DataFrame,
    ctx: RunContext,
    keys: Sequence[str] = ("order_id",),
    sla_days: int = SLA_DAYS,
    gather: Sequence[str] = (),
) -> DataFrame:
    """Clean orders: typed, enriched, one row per key.

    Derived columns neither order the rows nor move with them: only the row that is kept gets them, unless a key is one of them.
    ``gather`` names date parts that rows are brought together by for a partitioned write, which they are before the rest is derived.
    """
    if "_source_file" not in df.columns:
        df = df.withColumn("_source_file", F.lit(None).cast("string"))
    # All other columns of a row follow from these, or are the same for the whole run.
    ties = [*RAW.names, "_source_file"]
    if not set(keys) <= set(ties):
        kept = dedup_latest(enrich(df, ctx, sla_days).select(*CLEAN.names), keys, ties=ties)
        return kept.hint("rebalance", *gather) if gather else kept
    kept = dedup_latest(standardise(cast_types(df)).select(*ties), keys, order_by=[], ties=ties)
    if gather:
        kept = add_date_parts(kept).select(*ties, *gather).hint("rebalance", *gather)
    return derive(kept, ctx, sla_days).select(*CLEAN.names)
