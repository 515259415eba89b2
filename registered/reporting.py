"""Conform, dimension, upsert and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderflow.operators import dims, upsert
from orderflow.operators.conform import conform, line_key, violation_counts
from orderflow.plans import reports, states
from orderflow.schemas import FACT
from orderflow.sources import dimension
from orderflow.sources.workdir import fresh_dir, stored
from registered import query
from registered.sample import (
    AS_OF,
    CLEAN_COLUMNS,
    CLEAN_SQL,
    CTX,
    CTX2,
    DIM_CUSTOMER_SQL,
    DIM_PRODUCT_SQL,
    ENRICHED_SQL,
    RAW_SQL,
    WAVES_SQL,
    clean_orders,
    customers_source,
    dim_customer,
    dim_product,
    raw_orders,
    table,
    valid_orders,
    wave_orders,
    with_,
)
from orderflow.operators import transform as tr

# Rounded half up on whole numbers: a quotient such as 403 / 40 = 10.075 lies on the edge, and
# DuckDB's round of the double (10.07) loses the tie.
_ROUNDED_AVG = """cast(sign(sum(days_to_ship))
    * ((abs(sum(days_to_ship)) * 200 + count(days_to_ship)) // (2 * count(days_to_ship))) as double) / 100"""
SUMMARY_SQL = f"""select order_year, order_month, order_quarter, product_category, region, channel,
    count(distinct order_id) as order_count, count(distinct customer_id) as customer_count,
    cast(sum(quantity) as bigint) as total_units,
    cast(round(sum(gross_revenue), 2) as decimal(24,2)) as total_gross_revenue,
    cast(round(sum(net_revenue), 2) as decimal(24,2)) as total_net_revenue,
    {_ROUNDED_AVG} as avg_days_to_ship,
    cast(sum(case when is_late_shipment then 1 else 0 end) as bigint) as late_shipments
    from {{source}} where order_date >= date '2001-08-01' - 90 group by all"""


@query(with_(CLEAN_SQL, SUMMARY_SQL.format(source="clean")))
def summary_90d(spark, sf_dir):
    return reports.summary(clean_orders(spark, sf_dir), AS_OF, unique_orders=True)


@query(with_(ENRICHED_SQL, SUMMARY_SQL.format(source="enriched")))
def summary_90d_lines(spark, sf_dir):
    """The same report at order-line grain, where orders repeat and both counts must be distinct."""
    return reports.summary(tr.enrich(valid_orders(spark, sf_dir), CTX), AS_OF)


@query(with_(CLEAN_SQL, """select order_year, order_month, order_quarter, product_category, region, channel,
    count(distinct order_id) as order_count, cast(sum(net_revenue) as decimal(24,2)) as total_net_revenue,
    avg(days_to_ship) as avg_days_to_ship
    from clean where order_date >= date '2001-08-01' - 90 group by all"""))
def summary_90d_template(spark, sf_dir):
    return reports.summary_template(clean_orders(spark, sf_dir), AS_OF, unique_orders=True)


@query(with_(CLEAN_SQL, """select order_year, order_month, order_quarter, product_category, region, channel,
    order_status, count(distinct order_id) as order_count, count(distinct customer_id) as customer_count,
    cast(sum(quantity) as bigint) as total_units,
    cast(sum(gross_revenue) as decimal(24,2)) as total_gross_revenue,
    cast(sum(net_revenue) as decimal(24,2)) as total_net_revenue,
    cast(sum(shipping_cost) as decimal(24,2)) as total_shipping_cost,
    avg(days_to_ship) as avg_days_to_ship,
    cast(sum(case when is_late_shipment then 1 else 0 end) as bigint) as late_shipment_count,
    round(cast(sum(case when is_late_shipment then 1 else 0 end) as double) / count(*) * 100, 2)
        as late_shipment_pct
    from clean group by all"""))
def view_monthly_revenue(spark, sf_dir):
    return reports.monthly_revenue(clean_orders(spark, sf_dir), unique_orders=True)


def _lines(spark, sf_dir):
    return tr.enrich(valid_orders(spark, sf_dir), CTX)


@query(with_(ENRICHED_SQL, """select region, channel, count(distinct order_id) as order_count,
    count(distinct customer_id) as customer_count from enriched group by all"""))
def agg_distinct(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("region", "channel").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"))


@query(with_(ENRICHED_SQL, """select region, order_status,
    cast(sum(case when is_late_shipment then 1 else 0 end) as bigint) as late_count
    from enriched group by all"""))
def agg_conditional(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("region", "order_status").agg(
        reports.late_count().alias("late_count"))


@query(with_(ENRICHED_SQL, """select country, order_year,
    round(cast(sum(case when is_late_shipment then 1 else 0 end) as double) / count(*) * 100, 2) as late_pct
    from enriched group by all"""))
def agg_late_pct(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("country", "order_year").agg(reports.late_pct().alias("late_pct"))


def _states(spark, rows):
    """Monthly states of stored rows, and the rows: all of them, with the columns that states and reports read."""
    rows, root = stored(rows.select(*states.SOURCE_COLUMNS), "fact", "zstd"), fresh_dir(spark, "states")
    states.write_states(rows, root)
    return rows, root


@query(with_(CLEAN_SQL, SUMMARY_SQL.format(source="clean")))
def summary_90d_states(spark, sf_dir):
    """The summary from stored monthly states; rows are read of one month only."""
    rows, root = _states(spark, clean_orders(spark, sf_dir))
    return states.summary_from_states(spark, root, rows, AS_OF)


@query(with_(ENRICHED_SQL, SUMMARY_SQL.format(source="enriched")))
def summary_90d_lines_states(spark, sf_dir):
    """At order-line grain, where both counts are unions of sets."""
    rows, root = _states(spark, _lines(spark, sf_dir))
    return states.summary_from_states(spark, root, rows, AS_OF)


_DISTINCT_BY = ["order_year", "order_quarter", "region"]


@query(with_(ENRICHED_SQL, f"""select {', '.join(_DISTINCT_BY)}, count(distinct order_id) as order_count,
    count(distinct customer_id) as customer_count, cast(sum(quantity) as bigint) as total_units
    from enriched where order_date is not null group by all"""))
def rollup_distinct_states(spark, sf_dir):
    """Distinct orders and customers by quarter, from the sets of its months."""
    rows, root = _states(spark, _lines(spark, sf_dir))
    found = states.rollup(spark, root, _DISTINCT_BY)
    return found.select(*[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in _DISTINCT_BY], "order_count", "customer_count", "total_units")


@query(with_(ENRICHED_SQL, """select order_year, true as orders_within_5_pct, true as customers_within_5_pct
    from enriched where order_date is not null group by all"""))
def rollup_distinct_sketches(spark, sf_dir):
    """Yearly distinct counts from merged sketches, held against the exact ones from merged sets."""
    rows, root = _states(spark, _lines(spark, sf_dir))
    near = states.approximate_counts(spark, root, ["order_year"]).withColumnsRenamed({"order_count": "orders", "customer_count": "customers"})
    both = near.join(states.rollup(spark, root, ["order_year"]), "order_year")

    def within(a, b):
        return F.abs(F.col(a) - F.col(b)) <= 0.05 * F.col(b)
    return both.select(
        F.col("order_year").cast(rows.schema["order_year"].dataType).alias("order_year"),
        within("orders", "order_count").alias("orders_within_5_pct"), within("customers", "customer_count").alias("customers_within_5_pct"))


# ------------------------------------------------------------------ conform and dimensions

_FACT = [c for c in FACT.names if c not in ("_source_file", "_processed_at")]
FACT_MEASURES = """cast(order_year as smallint) as order_year, cast(order_month as smallint) as order_month,
    cast(order_quarter as smallint) as order_quarter, quantity, cast(unit_price as decimal(12,2)) as unit_price,
    cast(discount as decimal(5,4)) as discount, cast(shipping_cost as decimal(12,2)) as shipping_cost,
    gross_revenue, net_revenue, cast(gross_revenue - net_revenue as decimal(12,2)) as discount_amount,
    cast(days_to_ship as smallint) as days_to_ship, is_late_shipment"""
_FACT_TEXT = """order_id, customer_id, product_id, sales_rep_id, order_status, order_priority, ship_mode,
    product_category, product_name, region, country, city, postal_code, channel, order_date, ship_date"""
_CUSTOMER_SK = """coalesce((select max(customer_sk) from dim_customer d where d.customer_id = c.customer_id
    and c.order_date >= d.effective_from and c.order_date < d.effective_to), -1)"""
_PRODUCT_SK = "coalesce((select max(product_sk) from dim_product d where d.product_id = c.product_id), -1)"


@query(with_(f"{CLEAN_SQL}, {DIM_CUSTOMER_SQL}, {DIM_PRODUCT_SQL}", f"""select md5(order_id) as order_line_sk,
    cast({_CUSTOMER_SK} as bigint) as customer_sk, cast({_PRODUCT_SK} as bigint) as product_sk,
    coalesce(cast(strftime(order_date, '%Y%m%d') as int), -1) as order_date_sk,
    cast(strftime(ship_date, '%Y%m%d') as int) as ship_date_sk, {_FACT_TEXT}, {FACT_MEASURES},
    '{CTX.job_name}' as _job_name, '{CTX.run_id}' as _run_id from clean c"""))
def conform_fact(spark, sf_dir):
    fact = conform(clean_orders(spark, sf_dir), dim_customer(spark, sf_dir), dim_product(spark, sf_dir),
                   dims.dim_date(spark, AS_OF))
    return fact.select(*_FACT)


# Key parts that are missing, or hold the separator or the escape.
_PARTS = {"order_id": "order_id", "line_ref": "case when quantity is null then null when quantity = '1' then '#' "
          "else concat(sales_rep_id, '#', quantity) end", "sales_rep_id": "nullif(sales_rep_id, 'REP-1')"}
_ESCAPED = " || '#' || ".join(
    rf"coalesce(replace(replace({c}, '\', '\\'), '#', '\#'), '\N')" for c in _PARTS)


@query(with_(RAW_SQL, f"""select *, md5({_ESCAPED}) as order_line_sk from (
    select {', '.join(f'{e} as {c}' for c, e in _PARTS.items())} from raw_lines) parts"""))
def conform_line_key(spark, sf_dir):
    parts = raw_orders(spark, sf_dir).select(*[F.expr(e).alias(c) for c, e in _PARTS.items()])
    return parts.withColumn("order_line_sk", line_key(list(_PARTS)))


_REQUIRED = {"order_line_sk": "order_id", "customer_sk": "1", "product_sk": "1", "order_date_sk": "1",
             "order_id": "order_id", "customer_id": "customer_id", "order_status": "order_status",
             "order_date": "order_date", "order_year": "order_date", "order_month": "order_date",
             "order_quarter": "order_date", "quantity": "quantity", "unit_price": "unit_price",
             "discount": "1", "gross_revenue": "gross_revenue", "net_revenue": "net_revenue",
             "is_late_shipment": "1", "_processed_at": "1"}


@query(with_(CLEAN_SQL, " union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {e} is null) as null_count from clean"
    for c, e in _REQUIRED.items())))
def contract_violations(spark, sf_dir):
    return violation_counts(conform(clean_orders(spark, sf_dir)))


@query(with_(f"{CLEAN_SQL}, {DIM_CUSTOMER_SQL}",
             f"select order_id, customer_id, order_date, cast({_CUSTOMER_SK} as bigint) as customer_sk from clean c"))
def dim_customer_asof(spark, sf_dir):
    return dims.lookup_customer(clean_orders(spark, sf_dir), dim_customer(spark, sf_dir)).select(
        "order_id", "customer_id", "order_date", "customer_sk")


@query(with_(f"{CLEAN_SQL}, {DIM_PRODUCT_SQL}",
             f"select order_id, product_id, cast({_PRODUCT_SK} as bigint) as product_sk from clean c"))
def dim_product_lookup(spark, sf_dir):
    return dims.lookup_product(clean_orders(spark, sf_dir), dim_product(spark, sf_dir)).select(
        "order_id", "product_id", "product_sk")


@query(with_(CLEAN_SQL, """select order_id, order_date, ship_date,
    coalesce(cast(strftime(order_date, '%Y%m%d') as int), -1) as order_date_sk,
    cast(strftime(ship_date, '%Y%m%d') as int) as ship_date_sk from clean"""))
def dim_date_lookup(spark, sf_dir):
    return dims.lookup_dates(clean_orders(spark, sf_dir), dims.dim_date(spark, AS_OF)).select(
        "order_id", "order_date", "ship_date", "order_date_sk", "ship_date_sk")


@query("""with days as (select cast(unnest(generate_series(date '1990-01-01', date '2040-12-31',
        interval 1 day)) as date) as d),
    sold as (select cast(o_orderdate as date) as d, count(*) as orders_placed from orders group by 1)
    select cast(strftime(d, '%Y%m%d') as int) as date_sk, d as full_date, cast(year(d) as smallint) as calendar_year,
    cast(quarter(d) as smallint) as calendar_quarter, cast(month(d) as smallint) as calendar_month,
    strftime(d, '%B') as month_name, strftime(d, '%b') as month_name_short,
    cast(weekofyear(d) as smallint) as week_of_year, cast(dayofyear(d) as smallint) as day_of_year,
    cast(day(d) as smallint) as day_of_month, cast(isodow(d) as smallint) as day_of_week,
    strftime(d, '%A') as day_name, strftime(d, '%a') as day_name_short, isodow(d) >= 6 as is_weekend,
    isodow(d) < 6 as is_weekday,
    cast(case when month(d) >= 4 then year(d) + 1 else year(d) end as smallint) as fiscal_year,
    cast((month(d) + 8) % 12 // 3 + 1 as smallint) as fiscal_quarter,
    cast((month(d) + 8) % 12 + 1 as smallint) as fiscal_month,
    year(d) = 2001 and month(d) = 8 as is_current_month, year(d) = 2001 as is_current_year,
    strftime(d, '%Y-%m') as year_month, 'Q' || quarter(d) || ' ' || year(d) as quarter_label,
    'FQ' || ((month(d) + 8) % 12 // 3 + 1) || ' ' ||
        (case when month(d) >= 4 then year(d) + 1 else year(d) end) as fiscal_quarter_label,
    coalesce(orders_placed, 0) as orders_placed
    from days left join sold using (d)""")
def dim_date_generate(spark, sf_dir):
    """The whole calendar, with the orders placed on each of its days."""
    sold = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(
        F.count(F.lit(1)).alias("orders_placed"))
    calendar = dims.dim_date(spark, AS_OF, fiscal_start_month=4)
    return calendar.join(sold, "full_date", "left").withColumn(
        "orders_placed", F.coalesce("orders_placed", F.lit(0).cast("bigint")))


_VERSION = ["customer_sk", "customer_id", "customer_name", "customer_segment", "region", "country",
            "effective_from", "effective_to", "is_current"]


@query(with_(DIM_CUSTOMER_SQL, f"select {', '.join(_VERSION)} from dim_customer where is_current"))
def view_current_customers(spark, sf_dir):
    return dims.current_customers(dim_customer(spark, sf_dir)).select(*_VERSION)


@query(with_(f"{CLEAN_SQL}, {DIM_CUSTOMER_SQL}", """select c.order_id, c.customer_id, c.net_revenue,
    d.customer_name, d.customer_segment from clean c left join dim_customer d
    on d.customer_id = c.customer_id and d.is_current"""))
def join_current_customer(spark, sf_dir):
    return dims.join_current_customer(
        clean_orders(spark, sf_dir), dim_customer(spark, sf_dir),
        ["customer_name", "customer_segment"],
    ).select("order_id", "customer_id", "net_revenue", "customer_name", "customer_segment")


# Customers not yet in the dimension, and those whose segment changes. The snapshot names some customers twice, has a
# new name for all, and lacks region, country and is_active, which a new version takes from the one it follows.
_UNSEEN, _PROMOTED = "c_custkey % 11 = 0", "c_custkey % 5 = 0"
_SNAPSHOT = f"case when {_PROMOTED} then 'VIP' else c_mktsegment end"
_DIM_COLUMNS = ["customer_sk", "customer_id", "customer_name", "customer_segment", "region", "country", "is_active",
                "effective_from", "effective_to", "is_current"]


_SCD2_SQL = with_(f"""{DIM_CUSTOMER_SQL},
    seen as (select * from dim_customer where cast(substr(customer_id, 6) as bigint) % 11 <> 0),
    incoming as (select concat('CUST-', cast(c_custkey as string)) as customer_id,
        {_SNAPSHOT} as customer_segment, concat(c_name, ' Ltd') as customer_name from customer),
    compared as (select i.*, s.customer_id is null as is_new, s.region, s.country, s.is_active, s.customer_segment as old
        from incoming i left join (select * from seen where is_current) s using (customer_id)),
    fresh as (select * from compared where is_new or customer_segment <> old),
    closed as (select customer_id from fresh where not is_new)""",
    """select customer_sk, customer_id, customer_name, customer_segment, region, country, is_active, effective_from,
        case when is_current and customer_id in (from closed) then date '2001-08-01' else effective_to end
            as effective_to,
        is_current and customer_id not in (from closed) as is_current from seen
    union all
    select (select max(customer_sk) from seen)
        + row_number() over (order by substr(md5(customer_id), 1, 3), customer_id) as customer_sk,
        customer_id, customer_name, customer_segment, region, country, is_active, date '2001-08-01', date '9999-12-31',
        true from fresh""")


def _snapshot(spark, sf_dir):
    """The dimension so far, and the new snapshot of the source."""
    dim = dim_customer(spark, sf_dir).filter("cast(substr(customer_id, 6) as bigint) % 11 <> 0").select(*_DIM_COLUMNS)
    source = customers_source(spark, sf_dir)
    incoming = source.select(
        F.expr("concat('CUST-', cast(c_custkey as string))").alias("customer_id"),
        F.expr(_SNAPSHOT).alias("customer_segment"), F.expr("concat(c_name, ' Ltd')").alias("customer_name"))
    # The lesser row of a pair must not count.
    twice = incoming.filter("customer_id like '%3'").withColumn("customer_segment", F.lit("!"))
    return dim, incoming.unionByName(twice)


@query(_SCD2_SQL)
def scd2_merge(spark, sf_dir):
    dim, incoming = _snapshot(spark, sf_dir)
    return dims.scd2_merge(dim, incoming, AS_OF, attributes=["customer_segment"]).select(*_DIM_COLUMNS)


@query(_SCD2_SQL)
def scd2_store(spark, sf_dir):
    """The same merge on a stored dimension: current rows rewritten, closed ones appended to the history; then all of it again, to no effect."""
    dim, incoming = _snapshot(spark, sf_dir)
    root = fresh_dir(spark, "dim-customer")
    dimension.create(spark, root, dim, "base")
    for run_id in ("merge", "merge", "again"):
        dimension.merge(spark, root, incoming, AS_OF, run_id, attributes=["customer_segment"])
    return dimension.read(spark, root).select(*_DIM_COLUMNS)


# ------------------------------------------------------------------ upsert and checks


def _waves(spark, sf_dir):
    return wave_orders(spark, sf_dir, 1, CTX), wave_orders(spark, sf_dir, 2, CTX2)


@query(with_(WAVES_SQL, f"select {', '.join(CLEAN_COLUMNS)} from survivors"))
def upsert_survivors(spark, sf_dir):
    return upsert.survivors(*_waves(spark, sf_dir)).select(*CLEAN_COLUMNS)


@query(with_(WAVES_SQL, """select
    count(*) filter (where order_id not in (select order_id from target)) as rows_inserted,
    count(*) filter (where order_id in (select order_id from target)) as rows_updated from batch"""))
def upsert_counts(spark, sf_dir):
    return upsert.upsert_counts(*_waves(spark, sf_dir))


@query(with_(WAVES_SQL, f"""select count(*) as total_rows, count(distinct order_id) as unique_orders,
    cast({int(CTX2.run_ts.timestamp())} as bigint) as last_load_second from upserted where wave = 2"""))
def validate_load(spark, sf_dir):
    fact = upsert.upsert(*_waves(spark, sf_dir))
    return reports.load_check(fact, CTX2.run_id).select(
        "total_rows", "unique_orders", F.unix_seconds("last_load_ts").alias("last_load_second"))
