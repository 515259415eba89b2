"""The raw order files that queries start from."""

import datetime as dt

from pyspark.sql import functions as F

from registered import sample


def tables(spark, root, orders):
    """Small tables of the driver's schema; an order has a line for each of four parts, one order is there twice."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{root}/{name}.parquet")
    put("region", [(0, "ASIA")], "r_regionkey int, r_name string")
    put("nation", [(0, "INDIA", 0), (1, "CHINA", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(k, k % 2) for k in range(7)] + [(None, 1)], "c_custkey bigint, c_nationkey int")
    put("part", [(k, f"part {k}", "ECONOMY", 10.5) for k in range(5)] + [(3, "part 3 again", "PROMO", 1.0)],
        "p_partkey bigint, p_name string, p_type string, p_retailprice double")
    put("orders", [(k, (k or 0) % 9, dt.datetime(1998, 1, 1 + (k or 0) % 28), "F", "1-URGENT") for k in [*range(orders), 5, None]],
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderstatus string, o_orderpriority string")
    put("lineitem", [(k, part, 1, n, 2.0, 0.05, 0.02, "N") for k in range(orders + 3) for n, part in enumerate((0, 3, None, 9, 4), 1)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string")


def test_lines_of_an_order_are_stored_together(spark, tmp_path):
    """Then the dedup, which limits each order before its shuffle, sends an order's row and not its lines."""
    root = str(tmp_path)
    tables(spark, root, 400)
    # parts that are too many to broadcast, and more than one file
    spark.range(10, 20_000).select(
        F.col("id").alias("p_partkey"), F.md5(F.col("id").cast("string")).alias("p_name"), F.lit("PROMO").alias("p_type"),
        F.lit(1.0).alias("p_retailprice")).write.mode("append").parquet(f"{root}/part.parquet")
    large = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "65536",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "65536"}
    before = {k: spark.conf.get(k, None) for k in large}
    for k, v in large.items():
        spark.conf.set(k, v)
    try:
        rows = sample.raw_lines(spark, root).withColumn("file", F.col("_metadata.file_path"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    # by a column that each line of an order has
    number = F.regexp_extract("order_id", "([0-9]+)", 1).alias("number")
    files = rows.filter("order_id is not null").groupBy(number).agg(F.count_distinct("file").alias("files"))
    assert rows.select("file").distinct().count() > 1
    assert files.filter("files > 1").count() == 0


def test_every_match_is_a_line(spark, tmp_path):
    """Repeated, missing and null keys join as plain inner joins of the six tables do."""
    root = str(tmp_path)
    tables(spark, root, 40)
    found = sample.raw_lines(spark, root).count()
    # orders 0 to 39 and 5 again, of customers 0 to 6 out of 0 to 8; parts 0 and 4, and 3 that is there twice
    known = sum(k % 9 < 7 for k in [*range(40), 5])
    assert found == known * 4
