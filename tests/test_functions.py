import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderflow import functions as fn

INTS = {" 3 ": 3, "2.5": 2, "-2.9": -2, "1e3": None, "3000000000": None, "+7": 7, "\t8\n": 8,
        "abc": None, "": None, None: None, "2.": 2, "1 2": None}


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r["v"] for r in df.select("i", column(F.col("c")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_never_raise(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert values(spark, list(INTS), fn.to_int) == list(INTS.values())
        assert values(spark, ["1e3", "x", None, "-2.5"], fn.to_double) == [1000.0, None, None, -2.5]
        assert values(spark, ["2024-01-05", "2024-1-5", "2024-02-30", "2024-01-05 10:00:00", None, "x"],
                      fn.to_date) == [dt.date(2024, 1, 5), None, None, None, None, None]
        assert [v and str(v) for v in values(spark, ["12.345678", "NaN", "2d", "x"], fn.to_price)] == [
            "12.345678", None, None, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


KEYS = {
    "in/year=2022/month=07/day=09/z9.snappy": "2022-07-09",
    "dt=2021-10-30/f": "2021-10-30",
    "a/b/2019/04/03/c/d.gz": "2019-04-03",
    "nothing-to-see/2019-4-3.txt": "2024-02-01",
    "2020/01/02/year=2022/month=07/day=09": "2022-07-09",
    "2020/01/02/dt=2021-10-30/x": "2021-10-30",
    "year=2022/month=99/day=00/x": "2022-99-00",
}


def test_partition_date(spark):
    found = values(spark, list(KEYS), lambda c: fn.partition_date(c, F.lit("2024-02-01")))
    assert found == list(KEYS.values())


def test_key_decoding(spark):
    assert values(spark, ["a%3Db+c", "plain", "bad%zz+x", "%2B", "a%20b%zz", "%", "%4", "%41%4", "%%41", "%C3%A9%25"],
                  fn.event_key_decode) == ["a=b c", "plain", "bad%zz x", "+", "a b%zz", "%", "%4", "A%4", "%A", "é%"]


def test_only_broken_bytes_are_blanked(spark):
    df = spark.sql("select concat('a', cast(x'ff' as string), 'b') as c union all select 'x\uFFFDy' union all select null")
    assert sorted((r["v"] for r in df.select(fn.replace_invalid_chars(F.col("c")).alias("v")).collect()), key=str) == [
        None, "a b", "x\uFFFDy"]


def test_prefixes_are_stripped(spark):
    assert values(spark, ["orders/x", "other/x"],
                  lambda c: fn.starts_with_any(c, [" orders/ ", "returns/"])) == [True, False]


def test_int_casts_only_text_that_is_one(spark):
    """A cast that fails costs an error a row: each is behind a look at the text, and none of that changes a result."""
    texts = {"7": 7, " +07\t": 7, "\x01-7\x7f": -7, "12.": 12, " 12.9 ": 12, "\x0112.9": None, "12.3.4": None, "": None, "+": None,
             "abc": None, "1e3": None, "999999999": 999999999, "2147483647": 2147483647, "2147483648": None, "-2147483648": -2147483648,
             "-2147483649.5": None, "00000000000000000002147483647.0": 2147483647, "99999999999": None}
    df = spark.createDataFrame([(t, n) for t, n in texts.items()], "t string, n int")
    assert df.filter(~fn.to_int(F.col("t")).eqNullSafe(F.col("n"))).collect() == []
    # the first operand that coalesce tries is a check of the text, not a bare cast
    plan = df.select(fn.to_int(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(CASE WHEN RLIKE" in plan


def test_plain_dates_need_no_formatter(spark):
    texts = ["2024-02-29", "2023-02-29", "2024-13-01", "0000-01-01", "9999-12-31", "2024-1-05", " 2024-01-05", "2024-01-05\n", "+12345-01-01",
             "2024-01-05T", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    strict = F.try_to_date(F.col("t"), "yyyy-MM-dd")
    assert df.filter(~fn.to_date(F.col("t")).eqNullSafe(strict)).collect() == []
    plan = df.select(fn.to_date(F.col("t")).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN RLIKE" in plan
