import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.operators.dedup import dedup_latest
from orderflow.operators.transform import enrich, transform
from orderflow.schemas import CLEAN
from orders import CTX, raw


def one(spark, **changes):
    return enrich(raw(spark, changes), CTX).first()


def test_types_and_values(spark):
    r = one(spark)
    assert r["order_date"] == dt.date(2023, 11, 6) and r["ship_date"] == dt.date(2023, 11, 9)
    assert r["quantity"] == 4 and r["unit_price"] == Decimal("12.35")
    assert r["gross_revenue"] == Decimal("49.40") and r["net_revenue"] == Decimal("37.05")
    assert (r["order_year"], r["order_month"], r["order_quarter"]) == (2023, 11, 4)
    assert (r["_job_name"], r["_run_id"]) == ("unit", CTX.run_id)


@pytest.mark.parametrize("ship, days, late", [
    ("2023-11-06", 0, False), ("2023-11-13", 7, False), ("2023-11-14", 8, True),
    ("2024-02-06", 92, True), (None, None, False), ("2023-11-9", None, False)])
def test_shipping(spark, ship, days, late):
    r = one(spark, ship_date=ship)
    assert (r["days_to_ship"], r["is_late_shipment"]) == (days, late)


@pytest.mark.parametrize("discount", [None, "n/a", "0.0"])
def test_no_discount_means_net_is_gross(spark, discount):
    r = one(spark, discount=discount)
    assert r["discount"] == 0 and r["net_revenue"] == r["gross_revenue"]


def test_missing_shipping_cost_is_zero(spark):
    assert one(spark, shipping_cost=None)["shipping_cost"] == 0


def test_strings(spark):
    r = one(spark, region=" al-Ps ", channel="STORE ", country="at", order_priority=" Low", ship_mode="A ")
    assert (r["region"], r["channel"], r["country"], r["order_priority"], r["ship_mode"]) == (
        "AL-PS", "store", "AT", "Low", "A")


def test_nothing_is_rounded_before_the_product(spark):
    r = one(spark, quantity="3", unit_price="20.455", discount="0")
    assert r["gross_revenue"] == Decimal("61.37")  # 61.365 half up; 3 * 20.46 would be 61.38


def test_unreadable_price_and_overflow_are_null(spark):
    assert one(spark, unit_price="NaN")["gross_revenue"] is None
    assert one(spark, quantity="2147483647", unit_price="99999999999")["gross_revenue"] is None


def test_output_contract(spark):
    clean = transform(raw(spark), CTX)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in CLEAN]


def test_dedup_is_unique_and_independent_of_partitioning(spark):
    rows = raw(spark, *[{"order_id": f"O{i % 7}", "quantity": str(i % 11 + 1), "city": str(i)}
                        for i in range(500)])
    results = [
        sorted(transform(rows.repartition(n, *by), CTX).collect())
        for n, by in ((1, ()), (7, ()), (5, ("city",)))]
    assert len(results[0]) == 7 and results[0] == results[1] == results[2]


def test_dedup_takes_the_newest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", None, "n")],
                               "k string, _processed_at int, v string")
    assert sorted((r["k"], r["v"]) for r in dedup_latest(df, ["k"]).collect()) == [("a", "y"), ("b", "n")]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = dedup_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange


def test_only_raw_columns_are_shuffled_for_the_dedup(spark):
    plan = transform(raw(spark, {}, {}), CTX)._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window "):]
    assert "gross_revenue" in plan[:plan.index("Window ")]
    assert not any(c in window for c in ("gross_revenue", "days_to_ship", "order_quarter", "_run_id"))


def test_rows_are_gathered_before_the_rest_is_derived(spark):
    rows = raw(spark, {}, {"order_id": "b", "order_date": "2024-02-30"}, {"order_id": "c", "order_date": "2024-02-03"})
    plan = transform(rows, CTX, gather=["order_year", "order_month"])._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RebalancePartitions"):]
    assert "gross_revenue" in plan and not any(c in moved for c in ("gross_revenue", "days_to_ship", "order_quarter", "_run_id"))
    for keys in (("order_id",), ("order_id", "days_to_ship")):
        assert sorted(map(str, transform(rows, CTX, keys, gather=["order_year"]).collect())) == sorted(map(str, transform(rows, CTX, keys).collect()))


def test_a_derived_column_may_be_a_key(spark):
    rows = raw(spark, {}, {"ship_date": "2023-11-30"}, {"city": "x"})
    assert sorted(r["days_to_ship"] for r in transform(rows, CTX, keys=("order_id", "days_to_ship")).collect()) == [3, 24]
