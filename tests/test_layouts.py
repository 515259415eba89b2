"""Layouts and statistics, by the plans that come of them."""

import pytest
from pyspark.sql import functions as F

from orderflow.sources import layouts


@pytest.fixture
def no_small_tables(spark):
    """Without it Spark would broadcast every table of a test."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, n=3000):
    return spark.range(n).select(F.col("id").alias("order_id"), (F.col("id") * 7 % 200).alias("customer_id"), (F.col("id") % 40).alias("product_id"))


def customers(spark):
    return spark.range(200).select(F.col("id").alias("customer_id"), (F.col("id") % 3).alias("segment"))


def test_joins_and_groupings_by_the_key_move_nothing(spark, no_small_tables):
    fact, dim = layouts.keyed(facts(spark), "customer_id", 8), layouts.keyed(customers(spark), "customer_id", 8)
    joined = fact.join(dim, "customer_id")
    assert "Exchange" not in plan(joined) and joined.count() == 3000
    assert "Exchange" not in plan(joined.groupBy("customer_id").count())
    plain = facts(spark).join(customers(spark), "customer_id")
    assert plan(plain).count("Exchange hashpartitioning") >= 2
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("keyed_")]


def test_a_dimension_is_replicated_up_to_a_size(spark, no_small_tables):
    dim, fact = customers(spark), facts(spark)
    size = layouts.text_bytes(dim)
    small = plan(fact.join(layouts.replicated(dim, size), "customer_id"))
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small
    assert "BroadcastHashJoin" not in plan(fact.join(layouts.replicated(dim, size - 1), "customer_id"))
    assert layouts.text_bytes(dim.limit(0)) == 0


def test_statistics_order_the_joins(spark, no_small_tables):
    """Written customers first; with statistics the two products are joined first."""
    products = spark.range(40).select(F.col("id").alias("product_id"), F.col("id").alias("product_sk"))

    def joined(fact, dim, goods):
        return fact.join(dim, "customer_id").join(goods.filter("product_sk < 2"), "product_id").select("order_id", "segment", "product_sk")

    layouts.use_statistics(spark)
    try:
        stored = [(facts(spark), ["customer_id", "product_id"]), (customers(spark), ["customer_id"]), (products, ["product_id", "product_sk"])]
        unknown = joined(*(layouts.analysed(df, []) for df, _ in stored))
        known = joined(*(layouts.analysed(df, columns) for df, columns in stored))

        def joined_by(df):
            """The conditions of the joins, the outermost first."""
            return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]

        assert ["product_id" in line for line in joined_by(unknown)] == [True, False]
        assert ["product_id" in line for line in joined_by(known)] == [False, True]
        assert sorted(map(tuple, known.collect())) == sorted(map(tuple, unknown.collect())) and known.count() == 150
    finally:
        for name in layouts._STATISTICS:
            spark.conf.unset(name)
