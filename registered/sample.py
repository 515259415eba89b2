"""The driver's tables seen as raw orders, dimensions and arrival events, in Spark and in SQL.

Column expressions are written once, in SQL that both engines read alike.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.context import RunContext
from orderflow.operators import quality
from orderflow.operators.transform import transform
from orderflow.schemas import RAW_COLUMNS
from orderflow.sources.workdir import fresh_dir, shuffles_go

AS_OF = dt.date(2001, 8, 1)
CTX = RunContext("00000000-0000-0000-0000-000000000001",
                 dt.datetime(2001, 8, 1, tzinfo=dt.timezone.utc), AS_OF, "sample")
CTX2 = RunContext("00000000-0000-0000-0000-000000000002",
                  dt.datetime(2001, 8, 2, tzinfo=dt.timezone.utc), AS_OF, "sample")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- raw orders

_OD = "cast(o_orderdate as date)"
_H = "((l_orderkey * 31 + l_partkey * 7 + l_linenumber) % 200)"

RAW_EXPRESSIONS = {
    "order_id": f"case when {_H} = 0 then null else concat('ORD-', cast(l_orderkey as string)) end",
    "customer_id": f"case when {_H} = 1 then null else concat('CUST-', cast(o_custkey as string)) end",
    "order_date": f"case when {_H} = 2 then null when {_H} = 12 then '2024-02-30' "
                  f"else cast({_OD} as string) end",
    "order_status": f"case when {_H} = 3 then 'Unknown' when {_H} = 13 then null "
                    "when o_orderstatus = 'F' then 'Delivered' "
                    "when o_orderstatus = 'O' then 'Pending' else 'Processing' end",
    "order_priority": "concat(' ', o_orderpriority)",
    "ship_date": f"case when {_H} = 15 then null "
                 f"else cast({_OD} + cast(l_partkey % 15 as int) as string) end",
    "ship_mode": "concat(l_returnflag, ' ')",
    "product_id": "concat('PROD-', cast(l_partkey as string))",
    "product_category": "p_type",
    "product_name": "p_name",
    "quantity": f"case when {_H} in (0, 4) then '0' when {_H} = 5 then 'abc' when {_H} = 14 then '2.5' "
                "else cast(cast(l_quantity as int) as string) end",
    "unit_price": f"case when {_H} = 6 then '-10.00' "
                  "else cast(cast(p_retailprice as decimal(12,2)) as string) end",
    "discount": f"case when {_H} = 7 then '1.5' when {_H} = 8 then '-0.1' when {_H} = 9 then null "
                f"when {_H} = 10 then 'n/a' else cast(cast(l_discount as decimal(5,4)) as string) end",
    "shipping_cost": f"case when {_H} = 11 then null "
                     "else cast(cast(l_tax * 100 as decimal(12,2)) as string) end",
    "region": "concat(' ', lower(r_name), ' ')",
    "country": "lower(n_name)",
    "city": "concat('CITY-', cast(c_nationkey as string))",
    "postal_code": "cast(10000 + c_custkey as string)",
    "sales_rep_id": "concat('REP-', cast(l_suppkey as string))",
    "channel": "case when l_linenumber % 2 = 0 then 'ONLINE' else ' Store ' end",
}
# Not part of the raw layout: which load a line comes with, and the day its file lands.
SPLIT_EXPRESSIONS = {
    "wave": "case when l_linenumber <= 4 then 1 else 2 end",
    "landing_date": "cast('2024-01-01' as date) + cast(l_orderkey % 60 as int)",
}


_LANDED: dict[tuple[str, str], str] = {}


def _derive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with ``wave`` and ``landing_date``, from six tables.

    What an order has of its customer is joined at order grain, and a line meets its part while it is still narrow: a line is
    shuffled twice, whatever the tables' sizes. Part is hashed task by task, so that lines need no sort there. The two tables
    that grow without bound are merged last by a shuffle on the order key, where adaptive execution can split a hot order.
    Whichever of the rest are small enough to broadcast, Spark finds by their size.
    """
    placed = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part").hint("shuffle_hash"), F.expr("l_partkey = p_partkey"))
        .join(placed.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    exprs = {**RAW_EXPRESSIONS, **SPLIT_EXPRESSIONS}
    return joined.select(*[F.expr(e).alias(c) for c, e in exprs.items()])


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw order files every query starts from, as a pipeline finds them in its source.

    They are written to the shared folder once per application, so that queries scan stored text
    columns: pruning and pushdown then work as they do on real raw files.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        path = fresh_dir(spark, "raw")
        with shuffles_go(spark):
            _derive_lines(spark, sf_dir).write.option("compression", "zstd").parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_lines(spark, sf_dir).select(*RAW_COLUMNS)


def tagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.tag(raw_orders(spark, sf_dir))


def valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_rows(tagged_orders(spark, sf_dir))


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(valid_orders(spark, sf_dir), CTX)


def wave_orders(spark: SparkSession, sf_dir: str, wave: int, ctx: RunContext) -> DataFrame:
    lines = raw_lines(spark, sf_dir).filter(F.col("wave") == wave).drop("wave", "landing_date")
    return transform(quality.valid_rows(quality.tag(lines)), ctx)


RAW_SQL = (
    "raw_lines as (select "
    + ", ".join(f"{e} as {c}" for c, e in {**RAW_EXPRESSIONS, **SPLIT_EXPRESSIONS}.items())
    + """ from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey)"""
)


def sql_int(c: str) -> str:
    return (f"try_cast(nullif(regexp_extract({c}, "
            r"'^[ \t\r\n]*([+-]?[0-9]+)([.][0-9]*)?[ \t\r\n]*$', 1), '') as int)")


def sql_date(c: str) -> str:
    return (f"case when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"then cast(try_strptime({c}, '%Y-%m-%d') as date) end")


# States and reasons of the gate.
TAG_CASE = f"""case when order_id is null then 'order_id is null'
    when customer_id is null then 'customer_id is null'
    when order_date is null then 'order_date is null'
    when order_status not in ('Pending', 'Processing', 'Shipped', 'Delivered', 'Cancelled', 'Returned')
        then 'invalid order_status'
    when {sql_int('quantity')} is null or {sql_int('quantity')} <= 0 then 'quantity <= 0 or non-numeric'
    when try_cast(unit_price as double) is null or try_cast(unit_price as double) < 0
        then 'unit_price < 0 or non-numeric'
    when try_cast(discount as double) < 0 or try_cast(discount as double) > 1
        then 'discount out of [0, 1] range' end"""

TAGGED_SQL = f"{RAW_SQL}, tagged as (select *, {TAG_CASE} as _dq_failure from raw_lines)"

ENRICHED_SQL = f"""{TAGGED_SQL},
typed as (select * replace (
    {sql_date('order_date')} as order_date, {sql_date('ship_date')} as ship_date,
    {sql_int('quantity')} as quantity, try_cast(unit_price as decimal(18,6)) as unit_price,
    cast(coalesce(try_cast(discount as decimal(7,6)), 0) as decimal(7,6)) as discount,
    cast(coalesce(try_cast(shipping_cost as decimal(18,6)), 0) as decimal(18,6)) as shipping_cost,
    trim(order_status) as order_status, trim(order_priority) as order_priority,
    trim(ship_mode) as ship_mode, trim(product_category) as product_category,
    trim(upper(region)) as region, trim(upper(country)) as country, trim(lower(channel)) as channel)
    from tagged where _dq_failure is null),
enriched as (select *,
    cast(round(cast(quantity as decimal(10,0)) * unit_price, 2) as decimal(14,2)) as gross_revenue,
    cast(round(cast(quantity as decimal(10,0)) * unit_price * cast(1 - discount as decimal(8,6)), 2)
        as decimal(14,2)) as net_revenue,
    cast(datediff('day', order_date, ship_date) as int) as days_to_ship,
    coalesce(datediff('day', order_date, ship_date) > 7, false) as is_late_shipment,
    cast(year(order_date) as int) as order_year, cast(month(order_date) as int) as order_month,
    cast(quarter(order_date) as int) as order_quarter from typed)"""

TIE_COLUMNS = [c for c in RAW_COLUMNS if c != "order_id"] + [
    "gross_revenue", "net_revenue", "days_to_ship", "is_late_shipment",
    "order_year", "order_month", "order_quarter"]
CLEAN_COLUMNS = ["order_id", *TIE_COLUMNS]
_TIES = ", ".join(f"{c} desc nulls last" for c in TIE_COLUMNS)


def sql_dedup(source: str, partition: str = "order_id") -> str:
    return (f"select * exclude (_rn) from (select *, row_number() over "
            f"(partition by {partition} order by {_TIES}) as _rn from {source}) where _rn = 1")


CLEAN_SQL = f"{ENRICHED_SQL}, clean as ({sql_dedup('enriched')})"
# One clean row per order and wave, and what is left after the second wave replaced the first.
WAVES_SQL = f"""{ENRICHED_SQL}, waves as ({sql_dedup('enriched', 'wave, order_id')}),
batch as (select * from waves where wave = 2), target as (select * from waves where wave = 1),
survivors as (select * from target where order_id not in (select order_id from batch)),
upserted as (select * from survivors union all select * from batch)"""


# ---------------------------------------------------------------- dimensions

_CUSTOMER_BASE = {
    "customer_id": "concat('CUST-', cast(c_custkey as string))",
    "customer_name": "c_name",
    "region": "upper(r_name)",
    "country": "upper(n_name)",
    "is_active": "true",
}
_CUSTOMER_OLD = {
    "customer_sk": "c_custkey * 2 + 1",
    "customer_segment": "concat('OLD-', c_mktsegment)",
    "effective_from": "cast('1990-01-01' as date)",
    "effective_to": "cast('1998-01-01' as date)",
    "is_current": "false",
}
_CUSTOMER_NEW = {
    "customer_sk": "c_custkey * 2 + 2",
    "customer_segment": "c_mktsegment",
    "effective_from": "cast('1998-01-01' as date)",
    "effective_to": "cast('9999-12-31' as date)",
    "is_current": "true",
}
# Customers without a first version, and products the catalogue lacks: their lookups miss.
_LATE_CUSTOMER = "c_custkey % 10 = 7"
_LISTED_PRODUCT = "p_partkey % 25 <> 3"

_PRODUCT = {
    "product_sk": "p_partkey + 1",
    "product_id": "concat('PROD-', cast(p_partkey as string))",
    "product_name": "p_name",
    "product_category": "p_type",
    "brand": "p_brand",
    "retail_price": "cast(p_retailprice as decimal(12,2))",
    "is_active": "true",
}


def _columns(exprs: dict[str, str]) -> list:
    return [F.expr(e).alias(c) for c, e in exprs.items()]


def _columns_sql(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} as {c}" for c, e in exprs.items())


def customers_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions per customer, changing on 1998-01-01."""
    source = customers_source(spark, sf_dir)
    old = source.filter(f"not ({_LATE_CUSTOMER})").select(*_columns({**_CUSTOMER_BASE, **_CUSTOMER_OLD}))
    return old.unionByName(source.select(*_columns({**_CUSTOMER_BASE, **_CUSTOMER_NEW})))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(_LISTED_PRODUCT).select(*_columns(_PRODUCT))


_CUSTOMER_FROM = """from customer join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey"""
DIM_CUSTOMER_SQL = f"""dim_customer as (
    select {_columns_sql({**_CUSTOMER_BASE, **_CUSTOMER_OLD})} {_CUSTOMER_FROM} where not ({_LATE_CUSTOMER})
    union all by name
    select {_columns_sql({**_CUSTOMER_BASE, **_CUSTOMER_NEW})} {_CUSTOMER_FROM})"""
DIM_PRODUCT_SQL = f"dim_product as (select {_columns_sql(_PRODUCT)} from part where {_LISTED_PRODUCT})"


# ---------------------------------------------------------------- arrival events

BUCKET = "raw-zone"
PREFIXES = ["orders/", "returns/"]
RUN_DATE = dt.date(2024, 2, 1)

_MM = "lpad(cast(user_id % 12 + 1 as string), 2, '0')"
_DD = "lpad(cast(user_id % 28 + 1 as string), 2, '0')"
_NAME = "concat('u ', cast(user_id as string), '+', event_type)"
EVENT_EXPRESSIONS = {
    "event_id": "event_id",
    "ts": "ts",
    "bucket": f"case when user_id % 17 = 0 then 'other-zone' else '{BUCKET}' end",
    "key": f"""case user_id % 6
        when 0 then concat('orders/year=2024/month=', {_MM}, '/day=', {_DD}, '/', {_NAME}, '.parquet')
        when 1 then concat('orders/dt=2024-', {_MM}, '-', {_DD}, '/', {_NAME}, '.csv')
        when 2 then concat('returns/2024/', {_MM}, '/', {_DD}, '/', {_NAME}, '.json.gz')
        when 3 then concat('orders/', {_NAME}, '.parquet')
        when 4 then concat('internal/', {_NAME}, '.parquet')
        else concat('orders/', {_NAME}, '.xlsx') end""",
    "envelope": "case when event_id % 40 = 39 then 'test' when event_id % 40 = 38 then 'cut' "
                "when event_id % 40 = 37 then 'cut body' when event_id % 40 = 36 then 'none' "
                "when event_id % 4 = 0 then 'bus' when event_id % 4 = 1 then 'queue' else 'notification' end",
}
# Every third notification names a second file.
_SECOND = "envelope = 'notification' and event_id % 3 = 0"
_ENCODED = "replace(replace(replace({}, '+', '%2B'), '=', '%3D'), ' ', '+')"


def _record(key: str) -> str:
    return ("concat('{\"s3\":{\"bucket\":{\"name\":\"', bucket, '\"},\"object\":{\"key\":\"', "
            + key + ", '\"}}}')")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, ts, payload): the events table as arrival messages in three envelopes."""
    named = table(spark, sf_dir, "events").select(
        *[F.expr(e).alias(c) for c, e in EVENT_EXPRESSIONS.items()])
    first, second = _record(_ENCODED.format("key")), _record(_ENCODED.format("concat(key, '.gz')"))
    notification = (f"concat('{{\"Records\":[', {first}, "
                    f"case when {_SECOND} then concat(',', {second}) else '' end, ']}}')")
    payload = f"""case envelope
        when 'test' then '{{"Event":"s3:TestEvent"}}'
        when 'cut' then substr({notification}, 1, 30)
        when 'cut body' then to_json(named_struct('Records', array(named_struct('body', substr({notification}, 1, 30)))))
        when 'none' then null
        when 'queue' then to_json(named_struct('Records', array(named_struct('body', {notification}))))
        when 'bus' then to_json(named_struct('detail', named_struct(
            'bucket', named_struct('name', bucket), 'object', named_struct('key', key))))
        else {notification} end"""
    return named.select("event_id", "ts", F.expr(payload).alias("payload"))


_PARTITION_DATE = """case when key is null then null
    when regexp_matches(key, 'year=[0-9]{4}/month=[0-9]{2}/day=[0-9]{2}') then regexp_replace(
        regexp_extract(key, 'year=[0-9]{4}/month=[0-9]{2}/day=[0-9]{2}'),
        'year=([0-9]{4})/month=([0-9]{2})/day=([0-9]{2})', '\\1-\\2-\\3')
    when regexp_matches(key, 'dt=[0-9]{4}-[0-9]{2}-[0-9]{2}')
        then regexp_extract(key, 'dt=([0-9]{4}-[0-9]{2}-[0-9]{2})', 1)
    when regexp_matches(key, '[0-9]{4}/[0-9]{2}/[0-9]{2}')
        then replace(regexp_extract(key, '[0-9]{4}/[0-9]{2}/[0-9]{2}'), '/', '-')
    else '2024-02-01' end"""
EVENTS_SQL = f"""named as (select {_columns_sql(EVENT_EXPRESSIONS)} from events),
files as (select event_id, ts, 0 as record_no, bucket, key from named where envelope in ('bus', 'queue', 'notification')
    union all select event_id, ts, 0, null, null from named where envelope in ('cut', 'cut body', 'none')
    union all select event_id, ts, 1, bucket, concat(key, '.gz') from named where {_SECOND}),
parsed as (select *, {_PARTITION_DATE} as partition_date from files),
checked as (select *, case when key is null then 'message is not JSON'
    when bucket <> '{BUCKET}' then concat('unexpected bucket: ', bucket, ' (expected {BUCKET})')
    when not (starts_with(key, 'orders/') or starts_with(key, 'returns/'))
        then concat('key outside the valid prefixes: ', key)
    when not (ends_with(key, '.parquet') or ends_with(key, '.csv') or ends_with(key, '.json')
        or ends_with(key, '.gz')) then concat('unsupported file extension: ', key) end as reason
    from parsed),
arriving as (select key, ts, event_id, record_no, cast(floor(epoch(ts)) as bigint) as second
    from checked where reason is null),
taken(key, second) as (
    select key, min(second) from arriving group by key
    union all
    select a.key, min(a.second) from taken t join arriving a
        on a.key = t.key and a.second >= t.second + 86400 group by a.key, t.second),
winners as (select key, event_id, record_no from (
    select a.*, row_number() over (partition by a.key, a.second order by ts, event_id, record_no) as rn
    from arriving a join taken using (key, second)) where rn = 1),
routed as (select c.*, case when c.key is null then 'malformed' when c.reason is not null then 'skipped'
    when w.key is not null then 'accepted' else 'duplicate' end as status
    from checked c left join winners w using (key, event_id, record_no))"""


def with_(ctes: str, body: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{ctes} {body}"
