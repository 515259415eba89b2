"""Scan, sink, manifest, load and run queries: each writes files and returns what is read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from orderflow.context import PipelineConfig, RunContext
from orderflow.functions import partition_date
from orderflow.operators import dims
from orderflow.operators.conform import conform
from orderflow.plans import reports
from orderflow.plans.batch import run_batch
from orderflow.schemas import AUDIT, CLEAN, LANDING_PARTITIONS, RAW_COLUMNS
from orderflow.sources import layouts, manifest, readers, runlog, target, writers
from orderflow.sources.workdir import fresh_dir, shuffles_go
from registered import query
from registered.reporting import FACT_MEASURES, SUMMARY_SQL
from registered.sample import (
    AS_OF,
    CLEAN_COLUMNS,
    CLEAN_SQL,
    CTX,
    CTX2,
    DIM_CUSTOMER_SQL,
    DIM_PRODUCT_SQL,
    RAW_SQL,
    WAVES_SQL,
    clean_orders,
    dim_customer,
    dim_product,
    raw_lines,
    raw_orders,
    wave_orders,
    with_,
)

_RAW = ", ".join(RAW_COLUMNS)


def land(df, root, fmt="parquet", mode="append", compression=None):
    """Raw lines as landing files, one directory per day."""
    day = F.col("landing_date")
    out = df.select(*RAW_COLUMNS, F.year(day).alias("year"), F.format_string("%02d", F.month(day)).alias("month"),
                    F.format_string("%02d", F.dayofmonth(day)).alias("day"))
    writer = out.hint("rebalance", *LANDING_PARTITIONS).write.mode(mode).partitionBy(*LANDING_PARTITIONS)
    if fmt == "csv":
        # The writer would otherwise trim the padding the transform is there to remove.
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                ignoreTrailingWhiteSpace=False)
    if compression:
        writer = writer.option("compression", compression)
    with shuffles_go(df.sparkSession):
        writer.format(fmt).save(root)
    return root


@query(with_(RAW_SQL, f"""select {_RAW} from raw_lines
    where landing_date between date '2024-01-13' and date '2024-01-15'"""))
def scan_partition_lookback(spark, sf_dir):
    """Three days of the landing zone; the day range prunes directories."""
    root = land(raw_lines(spark, sf_dir), fresh_dir(spark, "landing"))
    return readers.read_raw(spark, root, "parquet", dt.date(2024, 1, 15), 3).select(*RAW_COLUMNS)


@query(with_(RAW_SQL, f"select {_RAW} from raw_lines"))
def scan_parquet_typed(spark, sf_dir):
    """Files that store a price as a number and the postal code as an integer."""
    path = fresh_dir(spark, "typed")
    raw_orders(spark, sf_dir).withColumns({
        "unit_price": F.col("unit_price").cast("decimal(12,2)"),
        "postal_code": F.col("postal_code").cast("int"),
    }).write.parquet(path)
    return readers.read_typed(spark, path).select(*RAW_COLUMNS)


_QUOTED = "concat(product_name, ' \"x\",', chr(10), 'y')"


@query(with_(RAW_SQL, f"select * exclude (wave, landing_date) replace ({_QUOTED} as product_name) from raw_lines"))
def scan_csv(spark, sf_dir):
    """CSV whose product names hold quotes, commas and line breaks."""
    lines = raw_lines(spark, sf_dir).withColumn("product_name", F.expr(_QUOTED))
    root = land(lines, fresh_dir(spark, "landing-csv"), "csv")
    return readers.read_raw(spark, root, "csv").select(*RAW_COLUMNS)


@query(with_(RAW_SQL, f"select {_RAW} from raw_lines"))
def scan_auto_format(spark, sf_dir):
    """A landing zone that switched from CSV to Parquet half-way."""
    lines = raw_lines(spark, sf_dir)
    switch = F.col("landing_date") < F.lit(dt.date(2024, 2, 1))
    root = fresh_dir(spark, "landing-mixed")
    land(lines.filter(switch), root, "csv")
    land(lines.filter(~switch), root, "parquet")
    return readers.read_raw(spark, root).select(*RAW_COLUMNS)


@query(with_(RAW_SQL, """select strftime(landing_date, '%Y-%m-%d') as file_day, true as is_parquet,
    count(*) as row_count, count(order_id) as orders_named from raw_lines group by 1"""))
def scan_lineage(spark, sf_dir):
    """Rows per landing day, the day taken from the source file each row names."""
    root = land(raw_lines(spark, sf_dir), fresh_dir(spark, "landing"))
    source = F.col("_source_file")
    return readers.read_raw(spark, root, "parquet").groupBy(
        partition_date(source, F.lit("none")).alias("file_day"),
        source.endswith(".parquet").alias("is_parquet"),
    ).agg(F.count(F.lit(1)).alias("row_count"), F.count("order_id").alias("orders_named"))


def _stage(spark, sf_dir):
    return writers.write_staged(clean_orders(spark, sf_dir), fresh_dir(spark, "staged"), "fact_orders", CTX)


@query(with_(CLEAN_SQL, f"select {', '.join(CLEAN_COLUMNS)} from clean"))
def sink_staged_roundtrip(spark, sf_dir):
    return spark.read.schema(CLEAN).parquet(_stage(spark, sf_dir)).select(*CLEAN_COLUMNS)


@query(with_(CLEAN_SQL, """select coalesce(cast(order_year as string), 'none') as order_year,
    coalesce(cast(order_month as string), 'none') as order_month, true as all_mandatory, true as has_bytes,
    true as same_files, true as same_bytes from clean group by all"""))
def load_manifest(spark, sf_dir):
    """The written manifest, summed per staged partition and held against a listing of what was staged."""
    staged = _stage(spark, sf_dir)
    path = manifest.write_manifest(spark, staged, fresh_dir(spark, "manifest"))

    def part(url, name):
        return F.coalesce(F.nullif(F.regexp_extract(url, rf"/{name}=(\d+)/", 1), F.lit("")), F.lit("none")).alias(name)
    months = ["order_year", "order_month"]
    listed = manifest.read_manifest(spark, path).groupBy(*[part("url", m) for m in months]).agg(
        F.bool_and("mandatory").alias("all_mandatory"), F.sum("length").alias("bytes"), F.count("url").alias("files"))
    found = readers.list_files(spark, staged, "*.parquet").groupBy(*[part("path", m) for m in months]).agg(
        F.sum("length").alias("found_bytes"), F.count("path").alias("found_files"))
    return listed.join(found, months, "full_outer").select(
        *months, "all_mandatory", (F.col("bytes") > 0).alias("has_bytes"),
        F.col("files").eqNullSafe(F.col("found_files")).alias("same_files"),
        F.col("bytes").eqNullSafe(F.col("found_bytes")).alias("same_bytes"))


@query(with_(CLEAN_SQL, f"select {', '.join(CLEAN_COLUMNS)} from clean"))
def load_from_manifest(spark, sf_dir):
    """Only listed files are loaded: a file that turns up later is left out."""
    staged = _stage(spark, sf_dir)
    path = manifest.write_manifest(spark, staged, fresh_dir(spark, "manifest"))
    clean_orders(spark, sf_dir).withColumn("order_id", F.lit("LATE")).drop(
        "order_year", "order_month").write.parquet(f"{staged}/order_year=1900/order_month=1")
    return manifest.load_from_manifest(
        spark, manifest.read_manifest(spark, path), staged, CLEAN).select(*CLEAN_COLUMNS)


@query(with_(CLEAN_SQL, SUMMARY_SQL.format(source="clean")))
def export_summary(spark, sf_dir):
    report = reports.summary(clean_orders(spark, sf_dir), AS_OF, unique_orders=True)
    path = writers.export_summary(report, fresh_dir(spark, "export"), "fact_orders", AS_OF)
    return spark.read.parquet(path)


_PROFILED = ["order_id", "customer_id", "order_status", "region", "channel", "order_date", "ship_date",
             "quantity", "order_year"]


@query(with_(CLEAN_SQL, " union all ".join(
    f"""select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
    count(distinct {c}) as distinct_count, min(cast({c} as string)) as min_value,
    max(cast({c} as string)) as max_value from clean""" for c in _PROFILED)))
def table_statistics(spark, sf_dir):
    return reports.column_profile(clean_orders(spark, sf_dir), _PROFILED, exact=True)


_PUBLISHED = ["order_line_sk", "order_id", "customer_id", "product_id", "order_status", "order_date",
              "order_year", "order_month", "order_quarter", "quantity", "unit_price", "discount",
              "shipping_cost", "gross_revenue", "net_revenue", "discount_amount", "days_to_ship",
              "is_late_shipment", "_run_id"]
# Rows without a date or a state break the contract and never reach the target.
_LOADABLE = "order_date is not null and order_status is not null"


def published_sql(extra: str = "") -> str:
    waves = WAVES_SQL
    for wave in ("wave = 1", "wave = 2"):
        waves = waves.replace(f"from waves where {wave}", f"from waves where {wave} and {_LOADABLE}")
    return with_(waves, f"""select md5(order_id) as order_line_sk, order_id, customer_id, product_id,
        order_status, order_date, {FACT_MEASURES}{extra} from upserted""")


@query(published_sql(
    f", case wave when 1 then '{CTX.run_id}' else '{CTX2.run_id}' end as _run_id"))
def upsert_fact(spark, sf_dir):
    """Two loads published one after the other, then the target as a reader sees it."""
    root = fresh_dir(spark, "target")
    for wave, ctx in ((1, CTX), (2, CTX2)):
        _publish(spark, root, wave_orders(spark, sf_dir, wave, ctx), ctx)
    return target.read_target(spark, root).select(*_PUBLISHED)


def _publish(spark, root, rows, ctx):
    staging = fresh_dir(spark, "staging")
    conform(rows).filter(_LOADABLE).write.option("compression", "zstd").parquet(staging)
    return target.publish_upsert(spark, root, spark.read.parquet(staging), ctx)


_THIRD = "cast(substring(order_id, 5) as bigint) % 3 = 0"
CTX3 = RunContext("00000000-0000-0000-0000-000000000003", CTX2.run_ts, AS_OF, "sample")


@query(published_sql(f""", case when wave = 2 then '{CTX3.run_id}' when {_THIRD} then '{CTX2.run_id}'
    else '{CTX.run_id}' end as _run_id"""))
def upsert_append(spark, sf_dir):
    """A first load, then keys that are all new but fall into the same months, then old and new ones."""
    root = fresh_dir(spark, "target")
    _publish(spark, root, wave_orders(spark, sf_dir, 1, CTX).filter(f"not ({_THIRD})"), CTX)
    _publish(spark, root, wave_orders(spark, sf_dir, 1, CTX2).filter(_THIRD), CTX2)
    _publish(spark, root, wave_orders(spark, sf_dir, 2, CTX3), CTX3)
    return target.read_target(spark, root).select(*_PUBLISHED)


@query(with_(CLEAN_SQL, f"""select md5(order_id) as order_line_sk, order_id, customer_id, product_id, order_status,
    order_date, {FACT_MEASURES} from clean where {_LOADABLE}
    and order_date between date '1999-01-01' and date '1999-03-31' and product_category = 'ECONOMY'"""))
def layout_sorted_scan(spark, sf_dir):
    """A scan of the published fact by its leading sort columns, which skips months and row groups."""
    root = fresh_dir(spark, "target")
    _publish(spark, root, clean_orders(spark, sf_dir), CTX)
    return target.read_target(spark, root).filter(
        F.col("order_date").between(F.lit(dt.date(1999, 1, 1)), F.lit(dt.date(1999, 3, 31)))
        & (F.col("product_category") == "ECONOMY")).select(*_PUBLISHED[:-1])


@query(with_(f"{CLEAN_SQL}, {DIM_CUSTOMER_SQL}", """select c.order_id, c.customer_id, c.net_revenue, d.customer_sk, d.customer_segment
    from clean c join dim_customer d on d.customer_id = c.customer_id and d.is_current"""))
def layout_key_join(spark, sf_dir):
    """Fact and customers in buckets of the customer: the join moves no row of either."""
    fact = layouts.keyed(clean_orders(spark, sf_dir).select("order_id", "customer_id", "net_revenue"), "customer_id", 8)
    current = dims.current_customers(dim_customer(spark, sf_dir)).select("customer_id", "customer_sk", "customer_segment")
    return fact.join(layouts.keyed(current, "customer_id", 8), "customer_id").select(
        "order_id", "customer_id", "net_revenue", "customer_sk", "customer_segment")


@query(with_(f"{CLEAN_SQL}, {DIM_PRODUCT_SQL}", """select c.order_id, c.product_id, c.quantity, p.product_sk, p.product_name as listed_name
    from clean c left join dim_product p using (product_id)"""))
def layout_all_join(spark, sf_dir):
    """Fact spread evenly, products on every executor: the fact's rows stay where they are."""
    path = writers.write_evenly(clean_orders(spark, sf_dir).select("order_id", "product_id", "quantity"), fresh_dir(spark, "even"))
    products = dim_product(spark, sf_dir).select("product_id", "product_sk", F.col("product_name").alias("listed_name"))
    return spark.read.parquet(path).join(layouts.replicated(products), "product_id", "left").select(
        "order_id", "product_id", "quantity", "product_sk", "listed_name")


@query(with_(f"{CLEAN_SQL}, {DIM_CUSTOMER_SQL}, {DIM_PRODUCT_SQL}", """select d.customer_segment, p.product_name as listed_name,
    count(*) as order_count, cast(sum(c.net_revenue) as decimal(24,2)) as total_net_revenue
    from clean c join dim_customer d on d.customer_id = c.customer_id and d.is_current
    join dim_product p on p.product_id = c.product_id where p.product_sk <= 20 group by all"""))
def statistics_join(spark, sf_dir):
    """A star join over analysed tables, written customers first: the plan takes the few products first."""
    fact = layouts.analysed(clean_orders(spark, sf_dir).select("customer_id", "product_id", "net_revenue"), ["customer_id", "product_id"])
    customers = layouts.analysed(dims.current_customers(dim_customer(spark, sf_dir)).select("customer_id", "customer_segment"), ["customer_id"])
    products = layouts.analysed(dim_product(spark, sf_dir).select(
        "product_id", "product_sk", F.col("product_name").alias("listed_name")), ["product_id", "product_sk"])
    return fact.join(customers, "customer_id").join(products.filter("product_sk <= 20"), "product_id").groupBy(
        "customer_segment", "listed_name").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("net_revenue").cast("decimal(24,2)").alias("total_net_revenue"))


@query(with_(f"""{CLEAN_SQL}, loadable as (select * from clean
    where order_date is not null and order_status is not null)""", """select cast(1 as bigint) as audit_id,
    'sample' as job_name, 'fact_orders' as target_table, (select count(*) from raw_lines) as rows_read,
    (select count(*) from tagged where _dq_failure is not null)
        + (select count(*) from clean) - (select count(*) from loadable) as rows_rejected,
    (select count(*) from loadable) as rows_inserted, cast(0 as bigint) as rows_updated,
    'SUCCESS' as status"""))
def audit_run_row(spark, sf_dir):
    """The whole job over a landing zone, and the log row it leaves."""
    root = land(raw_lines(spark, sf_dir), fresh_dir(spark, "landing"))
    cfg = PipelineConfig.under(root, fresh_dir(spark, "run"))
    run_batch(spark, cfg, CTX)
    return spark.read.schema(AUDIT).parquet(cfg.audit_root).select(
        "audit_id", "job_name", "target_table", "rows_read", "rows_rejected", "rows_inserted",
        "rows_updated", "status")


@query(with_(CLEAN_SQL, """select cast(1 as bigint) as audit_id, 'fact_orders' as target_table, cast(0 as bigint) as rows_read,
    cast(0 as bigint) as rows_rejected, cast(0 as bigint) as rows_inserted, cast(0 as bigint) as rows_updated, 'SUCCESS' as status,
    date '1990-01-01' as partition_date, (select count(*) from raw_lines) as rows_elsewhere, cast(0 as bigint) as rows_published"""))
def audit_empty_run(spark, sf_dir):
    """A run of a day for which nothing has landed, in a landing zone full of other days: a success of zeros."""
    root = land(raw_lines(spark, sf_dir), fresh_dir(spark, "landing"))
    cfg = PipelineConfig.under(root, fresh_dir(spark, "run"), partition_date=dt.date(1990, 1, 1))
    run_batch(spark, cfg, CTX)
    elsewhere = readers.read_raw(spark, root, "parquet").count()
    published = target.read_target(spark, cfg.target_root).count()
    return runlog.read(spark, cfg.audit_root).select(
        "audit_id", "target_table", "rows_read", "rows_rejected", "rows_inserted", "rows_updated", "status", "partition_date",
        F.lit(elsewhere).cast("bigint").alias("rows_elsewhere"), F.lit(published).cast("bigint").alias("rows_published"))
