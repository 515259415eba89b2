"""Typed transform, dedup and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderflow.functions import (
    ends_with_any,
    event_key_decode,
    lower_trim,
    partition_date,
    replace_invalid_chars,
    starts_with_any,
    to_date,
    to_double,
    to_int,
    to_price,
    upper_trim,
)
from orderflow.operators import transform as tr
from orderflow.operators.dedup import dedup_latest
from registered import query
from registered.sample import (
    CLEAN_COLUMNS,
    CLEAN_SQL,
    CTX,
    ENRICHED_SQL,
    EVENTS_SQL,
    RAW_SQL,
    RUN_DATE,
    arrivals,
    clean_orders,
    raw_orders,
    sql_date,
    sql_dedup,
    sql_int,
    table,
    valid_orders,
    with_,
)

_CASTS = ["order_id", "product_id", "order_date", "ship_date", "quantity", "unit_price",
          "discount", "shipping_cost"]


@query(with_(ENRICHED_SQL, f"select {', '.join(_CASTS)} from enriched"))
def transform_casts(spark, sf_dir):
    return tr.cast_types(valid_orders(spark, sf_dir)).select(*_CASTS)


@query(with_(ENRICHED_SQL, "select order_id, product_id, gross_revenue, net_revenue from enriched"))
def transform_revenue(spark, sf_dir):
    return tr.add_revenue(tr.cast_types(valid_orders(spark, sf_dir))).select(
        "order_id", "product_id", "gross_revenue", "net_revenue")


@query(with_(ENRICHED_SQL, "select order_id, product_id, days_to_ship, is_late_shipment from enriched"))
def transform_shipping(spark, sf_dir):
    return tr.add_shipping(tr.cast_types(valid_orders(spark, sf_dir))).select(
        "order_id", "product_id", "days_to_ship", "is_late_shipment")


@query(with_(ENRICHED_SQL, "select order_id, order_date, order_year, order_month, order_quarter from enriched"))
def transform_date_parts(spark, sf_dir):
    return tr.add_date_parts(tr.cast_types(valid_orders(spark, sf_dir))).select(
        "order_id", "order_date", "order_year", "order_month", "order_quarter")


_TEXT = ["order_id", "order_status", "order_priority", "ship_mode", "product_category",
         "region", "country", "channel"]


@query(with_(ENRICHED_SQL, f"select {', '.join(_TEXT)} from enriched"))
def transform_strings(spark, sf_dir):
    return tr.standardise(valid_orders(spark, sf_dir)).select(*_TEXT)


@query(with_(ENRICHED_SQL, f"""select order_id, product_id, '{CTX.job_name}' as _job_name,
    '{CTX.run_id}' as _run_id, cast({int(CTX.run_ts.timestamp())} as bigint) as processed_second
    from enriched"""))
def transform_audit(spark, sf_dir):
    return tr.stamp(valid_orders(spark, sf_dir), CTX).select(
        "order_id", "product_id", "_job_name", "_run_id",
        F.unix_seconds("_processed_at").alias("processed_second"))


@query(with_(CLEAN_SQL, f"select {', '.join(CLEAN_COLUMNS)} from clean"))
def transform_full(spark, sf_dir):
    return clean_orders(spark, sf_dir).select(*CLEAN_COLUMNS)


_LINE = ["order_id", "product_id", "channel", "order_date", "quantity", "net_revenue", "sales_rep_id"]


@query(with_(f"{ENRICHED_SQL}, kept as ({sql_dedup('enriched', 'order_id, product_id')})",
             f"select {', '.join(_LINE)} from kept"))
def dedup_latest_line_grain(spark, sf_dir):
    """Order-line grain: the keys are a parameter."""
    typed = tr.enrich(valid_orders(spark, sf_dir), CTX)
    return dedup_latest(typed.select(*CLEAN_COLUMNS), ["order_id", "product_id"]).select(*_LINE)


@query(with_(f"""{ENRICHED_SQL}, kept as (select * exclude (_rn) from (select *, row_number() over (
    partition by order_id order by ship_date desc nulls last, net_revenue desc nulls last,
    customer_id desc nulls last, order_date desc nulls last, sales_rep_id desc nulls last,
    channel desc nulls last, quantity desc nulls last, product_id desc nulls last) as _rn
    from enriched) where _rn = 1)""", f"select {', '.join(_LINE)}, ship_date from kept"),
       name="dedup_latest")
def newest_shipment(spark, sf_dir):
    """Newest shipment per order; the order list is a parameter, the rest are tie-breakers."""
    typed = tr.enrich(valid_orders(spark, sf_dir), CTX).select(
        "order_id", "customer_id", "order_date", "sales_rep_id", "channel", "quantity",
        "product_id", "ship_date", "net_revenue")
    newest = [F.col("ship_date").desc_nulls_last(), F.col("net_revenue").desc_nulls_last()]
    return dedup_latest(typed, ["order_id"], newest).select(*_LINE, "ship_date")


# ------------------------------------------------------------------ functions

# Ways to spell a number, as prefix and suffix around the raw text.
_SPELLINGS = {"padded": (" ", "\t"), "tail": ("", ".9"), "exponent": ("", "e3"),
              "large": ("99999999", ""), "signed": ("+", ""), "word": ("", " pcs")}
# DuckDB reads '+-10' as a number, and some prices are negative.
_PRICE_SPELLINGS = [n for n in _SPELLINGS if n != "signed"]


def _spelled_sql(c: str, name: str) -> str:
    before, after = _SPELLINGS[name]
    after = after.replace("\t", "'||chr(9)||'")
    return f"('{before}' || {c} || '{after}')"


@query(with_(RAW_SQL, "select order_id, product_id, " + ", ".join(
    f"{sql_int(_spelled_sql('quantity', n))} as quantity_{n}" for n in _SPELLINGS) + ", " + ", ".join(
    f"try_cast({_spelled_sql('unit_price', n)} as double) as price_{n}" for n in _PRICE_SPELLINGS) + ", "
    + ", ".join(f"try_cast({_spelled_sql('unit_price', n)} as decimal(18,6)) as exact_{n}"
                for n in _PRICE_SPELLINGS) + " from raw_lines"))
def fn_casts(spark, sf_dir):
    columns = []
    for name, (before, after) in _SPELLINGS.items():
        def spelled(c, before=before, after=after):
            return F.concat(F.lit(before), F.col(c), F.lit(after))
        columns.append(to_int(spelled("quantity")).alias(f"quantity_{name}"))
        if name in _PRICE_SPELLINGS:
            columns += [to_double(spelled("unit_price")).alias(f"price_{name}"),
                        to_price(spelled("unit_price")).alias(f"exact_{name}")]
    return raw_orders(spark, sf_dir).select("order_id", "product_id", *columns)


@query(with_(RAW_SQL, f"""select order_id, product_id, {sql_date('order_date')} as strict_date,
    {sql_date("replace(order_date, '-0', '-')")} as short_date,
    {sql_date("order_date || ' 00:00:00'")} as long_date,
    cast({sql_date('order_date')} - 90 as date) as window_start,
    cast(year({sql_date('order_date')}) as int) as y, cast(month({sql_date('order_date')}) as int) as m,
    cast(quarter({sql_date('order_date')}) as int) as q,
    cast(datediff('day', {sql_date('order_date')}, {sql_date('ship_date')}) as int) as days
    from raw_lines"""))
def fn_dates(spark, sf_dir):
    c = F.col("order_date")
    d = to_date(c)
    return raw_orders(spark, sf_dir).select(
        "order_id", "product_id", d.alias("strict_date"),
        to_date(F.replace(c, F.lit("-0"), F.lit("-"))).alias("short_date"),
        to_date(F.concat(c, F.lit(" 00:00:00"))).alias("long_date"),
        F.date_sub(d, 90).alias("window_start"),
        F.year(d).alias("y"), F.month(d).alias("m"), F.quarter(d).alias("q"),
        F.datediff(to_date(F.col("ship_date")), d).alias("days"))


@query(with_(RAW_SQL, """select order_id, trim(order_priority) as priority, trim(upper(region)) as region,
    trim(upper(country)) as country, trim(lower(channel)) as channel,
    starts_with(product_id, 'PROD-1') or starts_with(product_id, 'PROD-2') as starts,
    ends_with(product_name, 'ing') or ends_with(product_name, 'get') as ends from raw_lines"""))
def fn_strings(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "order_id", F.trim("order_priority").alias("priority"),
        upper_trim(F.col("region")).alias("region"), upper_trim(F.col("country")).alias("country"),
        lower_trim(F.col("channel")).alias("channel"),
        starts_with_any(F.col("product_id"), ["PROD-1", " PROD-2 "]).alias("starts"),
        ends_with_any(F.col("product_name"), ["ing", "get"]).alias("ends"))


@query(with_(EVENTS_SQL, """select event_id, key, partition_date,
    cast(try_strptime(partition_date, '%Y-%m-%d') as date) as calendar_date
    from parsed where key is not null""", recursive=True))
def fn_partition_date(spark, sf_dir):
    from orderflow.operators.events import parse_events

    key = F.col("key")
    text = partition_date(key, F.lit(RUN_DATE.isoformat()))
    return parse_events(arrivals(spark, sf_dir), "payload", RUN_DATE).filter("key is not null").select(
        "event_id", "key", text.alias("partition_date"), to_date(text).alias("calendar_date"))


@query("""select page_id, url, url_decode(replace(url, '+', ' ')) as decoded_url,
    replace(html, '%', '') as decoded_html from pages""")
def fn_url_decode(spark, sf_dir):
    """Plain URLs, and whole pages encoded and decoded again."""
    encoded = F.url_encode(F.replace(F.col("html"), F.lit("%"), F.lit("")))
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", event_key_decode(F.col("url")).alias("decoded_url"),
        event_key_decode(encoded).alias("decoded_html"))


@query("select doc_id, substr(text, 1, 500) as text, lang from documents")
def load_truncate_columns(spark, sf_dir):
    """Long text cut at a declared length, as the load into a limited column does."""
    from pyspark.sql import types as T

    from orderflow.operators.conform import truncate_columns

    contract = T.StructType([T.StructField("text", T.StringType(), True, {"max_length": 500})])
    return truncate_columns(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), contract)


@query("""select doc_id, case when doc_id % 2 = 0 then replace(text, chr(65533), ' ') || ' ' || lang
    else text || chr(65533) || lang end as text from documents""")
def load_replace_invalid_chars(spark, sf_dir):
    """A byte that is no UTF-8 in every other text comes back as a blank; a valid U+FFFD in the others stays."""
    broken = F.concat("text", F.when(F.col("doc_id") % 2 == 0, F.expr("cast(x'FF' as string)")).otherwise("\uFFFD"), "lang")
    return table(spark, sf_dir, "documents").select("doc_id", replace_invalid_chars(broken).alias("text"))
