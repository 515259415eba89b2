"""Monthly states: any split of the rows and any rollup gives the counts of all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderflow.context import RunContext
from orderflow.operators.conform import conform
from orderflow.operators.transform import transform
from orderflow.plans import reports, states
from orderflow.sources import target
from orderflow.sources.workdir import stored
from orders import CTX, raw


def lines(spark, n=400):
    rows = spark.range(n).select(
        (F.col("id") % 90).cast("string").alias("order_id"),
        F.when(F.col("id") % 13 > 0, (F.col("id") * 7 % 50).cast("string")).alias("customer_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 11 % 150).cast("int")).alias("order_date"),
        F.when(F.col("id") % 5 > 0, F.lit("web")).alias("channel"), (F.col("id") % 3).cast("string").alias("region"),
        (F.col("id") % 2).cast("string").alias("product_category"), F.col("id").cast("int").alias("quantity"),
        (F.col("id") / 4).cast("decimal(12,2)").alias("gross_revenue"), (F.col("id") / 8).cast("decimal(12,2)").alias("net_revenue"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 9).cast("int")).alias("days_to_ship"), (F.col("id") % 9 > 7).alias("is_late_shipment"))
    return rows.select("*", F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"), F.quarter("order_date").alias("order_quarter"))


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("as_of", [dt.date(2024, 6, 1), dt.date(2024, 5, 31), dt.date(2030, 1, 1)])
def test_summary_equals_that_of_the_rows(spark, tmp_path, as_of):
    rows, root = lines(spark), str(tmp_path / "states")
    # months written apart, one of them twice
    for months in ((1, 2), (3, 4, 5, 6), (2,)):
        states.write_states(rows.filter(F.col("order_month").isin(*months)), root)
    got = states.summary_from_states(spark, root, rows, as_of)
    same(got, reports.summary(rows, as_of))
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in reports.summary(rows, as_of)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("keys", [["region"], ["order_year", "channel"], []])
def test_rollups(spark, tmp_path, keys):
    rows, root = lines(spark), str(tmp_path / "states")
    states.write_states(rows, root)
    want = rows.groupBy(*keys).agg(F.count_distinct("order_id").alias("order_count"), F.count_distinct("customer_id").alias("customer_count"))
    same(states.rollup(spark, root, keys).select(*keys, "order_count", "customer_count"), want)
    near = states.approximate_counts(spark, root, keys)
    same(near, want)


def test_numbers_stay_and_are_dense(spark):
    first = states.numbered(lines(spark, 40), "order_id")
    more = states.numbered(lines(spark, 80), "order_id", first)
    both = sorted(r["number"] for r in first.unionByName(more).collect())
    assert both == list(range(1, 81)) and first.join(more, "value").count() == 0


def test_no_rows(spark, tmp_path):
    root = str(tmp_path / "states")
    states.write_states(lines(spark), root)
    states.write_states(lines(spark).limit(0), root)
    assert states.rollup(spark, root, ["region"], F.col("order_month") == 77).collect() == []


def test_refresh_follows_the_target(spark, tmp_path):
    root, place = str(tmp_path / "fact"), str(tmp_path / "states")

    def load(n, *changes):
        ctx, path = RunContext(f"run-{n}", CTX.run_ts, CTX.as_of, CTX.job_name), f"{root}-staging-{n}"
        conform(transform(raw(spark, *changes), ctx)).write.parquet(path)
        target.publish_upsert(spark, root, spark.read.parquet(path), ctx)
        done = states.refresh_states(spark, place, root)
        same(states.rollup(spark, place, ["order_month"]).select("order_month", "order_count", "customer_count").withColumn("order_month", F.col("order_month").cast("int")),
             target.read_target(spark, root).groupBy(F.col("order_month").cast("int").alias("order_month")).agg(
                 F.count_distinct("order_id").alias("order_count"), F.count_distinct("customer_id").alias("customer_count")))
        return done

    assert load(1, {"order_id": "a"}, {"order_id": "b", "order_date": "2024-02-02"}, {"order_id": "c", "order_date": "2024-03-03"}) == [(2023, 11), (2024, 2), (2024, 3)]
    # b moves and empties February; March is not worked out again
    assert load(2, {"order_id": "b", "customer_id": "CUST-9"}, {"order_id": "e"}) == [(2023, 11), (2024, 2)]
    assert states.refresh_states(spark, place, root) == []


def test_numbers_are_moved_and_not_bitmaps(spark):
    """A task that joins ids has few of each group's: bitmaps of 4 KB are made where all of a bitmap's numbers are."""
    rows = lines(spark)
    plan = states.id_sets(rows, "order_id", states.numbered(rows, "order_id"))._jdf.queryExecution().executedPlan().toString()
    made = plan.index("bitmap_construct_agg")
    assert 0 < plan.index("partial_bitmap_construct_agg") < plan.index("Exchange hashpartitioning", made)
    # ids of several buckets of 32,768
    many = spark.range(70_000).select(F.concat(F.lit("o"), "id").alias("order_id"), (F.col("id") % 3).alias("region"))
    sets = states.id_sets(many.unionByName(many), "order_id", states.numbered(many, "order_id"), ["region"])
    found = sets.groupBy("region").agg(F.sum(F.bitmap_count("bitmap")).alias("n"), F.count("*").alias("buckets")).collect()
    assert sorted((r["region"], r["n"], r["buckets"]) for r in found) == [(0, 23334, 3), (1, 23333, 3), (2, 23333, 3)]


def test_rows_move_with_their_group_and_id_alone(spark):
    """Twice an entity: to the number and to the bitmap; neither keys nor a distinct of the pairs go along."""
    rows = lines(spark)
    groups, numbers = states.groups_of(rows), stored(states.numbered(rows, "order_id"), "numbers")
    plan = states.id_sets(rows, "order_id", numbers, groups=groups)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression [group"):].splitlines()
    assert "Project [group" in below[1] and not any(c in below[1] for c in reports.SUMMARY_KEYS)
    assert not any("Aggregate" in line for line in below)
    # sketches sort their rows apart from the sums
    plan = states.sums_and_sketches(rows, groups)._jdf.queryExecution().executedPlan().toString()
    sorted_rows = [line for line in plan.splitlines() if "ObjectHashAggregate" in line]
    assert sorted_rows and not any("sum(" in line or "order_month" in line for line in sorted_rows)


def test_groups_with_null_keys_keep_their_rows(spark):
    rows = lines(spark)
    groups = states.groups_of(rows, ["region", "channel"])
    assert groups.count() == groups.select("group").distinct().count() == 6
    got = states.grouped(rows, groups).join(groups, "group").groupBy("region", "channel").count()
    same(got, rows.groupBy("region", "channel").count())
    # no keys at all, and an id that most rows have
    many = rows.unionByName(rows.withColumn("customer_id", F.lit("guest")))
    sets = states.id_sets(many, "customer_id", states.numbered(many, "customer_id"), [])
    assert sets.columns == ["entity", "bucket", "bitmap"]
    assert sets.agg(F.sum(F.bitmap_count("bitmap"))).first()[0] == many.select("customer_id").distinct().filter("customer_id is not null").count()


def test_states_are_made_from_the_columns_they_read(spark, tmp_path):
    from registered import reporting
    rows = lines(spark).withColumn("product_name", F.lit("x"))
    kept, root = reporting._states(spark, rows)
    assert kept.columns == states.SOURCE_COLUMNS and kept.count() == rows.count()
    same(states.summary_from_states(spark, root, kept, dt.date(2024, 6, 1)), reports.summary(rows, dt.date(2024, 6, 1)))
