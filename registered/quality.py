"""Data-quality gate queries."""

from __future__ import annotations

from orderflow.operators import quality
from orderflow.sources.workdir import fresh_dir
from orderflow.sources.writers import write_rejected
from registered import query
from registered.sample import CTX, TAGGED_SQL, raw_orders, tagged_orders, valid_orders, with_

SEEN = ["order_id", "customer_id", "order_date", "order_status", "product_id",
        "quantity", "unit_price", "discount", "channel"]
_SEEN = ", ".join(SEEN)


@query(with_(TAGGED_SQL, f"select {_SEEN}, _dq_failure from tagged"))
def dq_tag(spark, sf_dir):
    return tagged_orders(spark, sf_dir).select(*SEEN, "_dq_failure")


def _one_rule(spark, sf_dir, first, last):
    rules = quality.order_rules()[first:last]
    return quality.rejected_rows(quality.tag(raw_orders(spark, sf_dir), rules)).select(*SEEN, "_dq_failure")


def _one_rule_sql(predicate: str, reason: str) -> str:
    return with_(TAGGED_SQL, f"select {_SEEN}, '{reason}' as _dq_failure from tagged where {predicate}")


@query(with_(TAGGED_SQL, f"""select {_SEEN}, case when order_id is null then 'order_id is null'
    when customer_id is null then 'customer_id is null' else 'order_date is null' end as _dq_failure
    from tagged where order_id is null or customer_id is null or order_date is null"""))
def dq_rule_nulls(spark, sf_dir):
    return _one_rule(spark, sf_dir, 0, 3)


@query(_one_rule_sql(
    "order_status is not null and order_status not in "
    "('Pending', 'Processing', 'Shipped', 'Delivered', 'Cancelled', 'Returned')", "invalid order_status"))
def dq_rule_status(spark, sf_dir):
    return _one_rule(spark, sf_dir, 3, 4)


@query(_one_rule_sql("""not coalesce(try_cast(regexp_extract(quantity, '^([+-]?[0-9]+)([.][0-9]*)?$', 1)
    as int) > 0, false)""", "quantity <= 0 or non-numeric"))
def dq_rule_quantity(spark, sf_dir):
    return _one_rule(spark, sf_dir, 4, 5)


@query(_one_rule_sql("not coalesce(try_cast(unit_price as double) >= 0, false)",
                     "unit_price < 0 or non-numeric"))
def dq_rule_price(spark, sf_dir):
    return _one_rule(spark, sf_dir, 5, 6)


@query(_one_rule_sql("coalesce(not (try_cast(discount as double) between 0 and 1), false)",
                     "discount out of [0, 1] range"))
def dq_rule_discount(spark, sf_dir):
    return _one_rule(spark, sf_dir, 6, 7)


@query(with_(TAGGED_SQL, f"select {_SEEN} from tagged where _dq_failure is null"))
def dq_valid_rows(spark, sf_dir):
    return valid_orders(spark, sf_dir).select(*SEEN)


@query(with_(TAGGED_SQL, f"select {_SEEN}, _dq_failure from tagged where _dq_failure is not null"))
def dq_rejected_rows(spark, sf_dir):
    """The rejected rows as read back from their sink."""
    tagged = tagged_orders(spark, sf_dir)
    counts = quality.gate(tagged)
    path = write_rejected(quality.rejected_rows(tagged), fresh_dir(spark, "rejected"), "fact_orders",
                          CTX, counts.rejected)
    return spark.read.parquet(path).select(*SEEN, "_dq_failure")


@query(with_(TAGGED_SQL, """select count(*) as total, count(_dq_failure) as rejected,
    cast(count(_dq_failure) as double) / count(*) * 100 as reject_pct,
    case when cast(count(_dq_failure) as double) / count(*) * 100 > 5 then 'FAIL' else 'PASS' end as verdict
    from tagged"""))
def dq_gate(spark, sf_dir):
    return quality.gate_report(tagged_orders(spark, sf_dir))


@query(with_(TAGGED_SQL, """select _dq_failure, count(*) as row_count from tagged
    where _dq_failure is not null group by _dq_failure"""))
def dq_profile(spark, sf_dir):
    return quality.profile(tagged_orders(spark, sf_dir))
