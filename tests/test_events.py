import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from orderflow.operators import events

RUN = dt.date(2024, 2, 1)


def notification(bucket, key):
    return {"s3": {"bucket": {"name": bucket}, "object": {"key": key}}}


def bus(bucket, key):
    return {"source": "bus", "detail": {"bucket": {"name": bucket}, "object": {"key": key}}}


def parse(spark, *messages, **kw):
    df = spark.createDataFrame([(i, m if isinstance(m, str) else json.dumps(m))
                                for i, m in enumerate(messages)], "id int, payload string")
    return [(r["id"], r["record_no"], r["bucket"], r["key"], r["partition_date"])
            for r in events.parse_events(df, "payload", RUN, **kw).orderBy("id", "record_no").collect()]


def test_three_envelopes(spark):
    encoded, plain = "orders/dt%3D2024-01-05/a+b.csv", "orders/dt=2024-01-05/a+b.csv"
    queue = {"Records": [{"body": json.dumps({"Records": [notification("b", encoded), notification("b", "k2")]})},
                         {"body": json.dumps(bus("b", plain))}]}
    assert parse(
        spark, {"Records": [notification("b", encoded), notification("b", "k2")]}, queue, bus("b", plain),
        notification("b", encoded),
    ) == [
        (0, 0, "b", "orders/dt=2024-01-05/a b.csv", "2024-01-05"), (0, 1, "b", "k2", "2024-02-01"),
        (1, 0, "b", "orders/dt=2024-01-05/a b.csv", "2024-01-05"), (1, 1, "b", "k2", "2024-02-01"),
        (1, 2, "b", "orders/dt=2024-01-05/a+b.csv", "2024-01-05"),
        (2, 0, "b", "orders/dt=2024-01-05/a+b.csv", "2024-01-05"),
        (3, 0, "b", "orders/dt=2024-01-05/a b.csv", "2024-01-05"),
    ]


def test_nothing_comes_of_test_events_and_incomplete_ones(spark):
    wrapped_test = {"Records": [{"body": json.dumps({"Event": events.TEST_EVENT})}]}
    assert parse(spark, {"Event": events.TEST_EVENT}, wrapped_test, {"Records": []}, {},
                 notification("", "k"), notification("b", "")) == []


def test_messages_that_are_no_json_stay_visible(spark):
    half = json.dumps(notification("b", "k"))[:25]
    queue = {"Records": [{"body": half}, {"body": json.dumps(bus("b", "sales/k.csv"))}]}
    df = spark.createDataFrame([(0, "not json"), (1, half), (2, None), (3, ""), (4, json.dumps(queue))], "i int, m string")
    parsed = events.parse_events(df, "m", dt.date(2024, 2, 1))
    rows = {(r["i"], r["record_no"]): r["malformed"] for r in parsed.collect()}
    assert rows == {(0, 0): True, (1, 0): True, (2, 0): True, (3, 0): True, (4, 0): True, (4, 1): False}
    timed = parsed.withColumn("ts", F.timestamp_seconds(F.col("i")))
    routed = events.route_events(timed, "b", ["sales/"], "ts", ["i", "record_no"])
    assert {r["status"]: r["row_count"] for r in events.outcome_counts(routed).collect()} == {"malformed": 5, "accepted": 1}


def test_wrapped_bus_events_can_be_ignored(spark):
    queue = {"Records": [{"body": json.dumps(bus("b", "k"))}]}
    assert parse(spark, queue, wrapped_bus_events=False) == []


@pytest.mark.parametrize("bucket, key, word", [
    ("inbox", "sales/dt=2021-10-30/f7.parquet", None),
    ("outbox", "sales/f7.parquet", "outbox"),
    ("inbox", "scratch/f7.parquet", "prefix"),
    ("inbox", "sales", "prefix"),
    ("inbox", "sales/notes.pdf", "extension"),
    ("inbox", "refunds/f7.csv", None),
    ("inbox", "sales/f7.ndjson.gz", None),
    ("outbox", "scratch/notes.pdf", "bucket"),
])
def test_validation(spark, bucket, key, word):
    df = spark.createDataFrame([(bucket, key)], "bucket string, key string")
    reason = events.validate_events(df, "inbox", ["sales/", " refunds/"]).first()["reason"]
    assert reason is None if word is None else word in reason


def brute_force(rows, ttl, locks=()):
    last, taken = dict(locks), set()
    for key, second, ident in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or second >= last[key] + ttl:
            last[key] = second
            taken.add(ident)
    return taken


def arrivals(spark, rows):
    return spark.createDataFrame(rows, "key string, s bigint, ident bigint").select(
        "key", F.timestamp_seconds("s").alias("ts"), "ident")


def test_time_to_live_counts_from_the_last_accepted(spark):
    rows = [("k", s, i) for i, s in enumerate((0, 10, 90000, 100000, 180001))]
    marked = events.dedup_ttl(arrivals(spark, rows), "key", "ts", ["ident"])
    assert {r["ident"] for r in marked.collect() if r["is_accepted"]} == {0, 2, 4}


@pytest.mark.parametrize("seed", range(3))
def test_repeats_against_brute_force_with_a_hot_key(spark, seed):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < .4 else f"k{rng.randrange(40)}", rng.randrange(500_000), i)
            for i in range(3000)]
    locks = {"hot": 1000, "k1": 40_000}
    marked = events.dedup_ttl(
        arrivals(spark, rows), "key", "ts", ["ident"], 7200,
        spark.createDataFrame(list(locks.items()), "key string, second bigint"))
    assert marked.count() == len(rows)
    assert {r["ident"] for r in marked.collect() if r["is_accepted"]} == brute_force(rows, 7200, locks)


@pytest.mark.parametrize("slice_seconds", [1, 20_000, 10**9])
def test_chains_cut_by_slices(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    rows = [(f"k{rng.randrange(4)}", rng.randrange(-300_000, 300_000) // 10 * 10, i) for i in range(2500)]
    rows += [("dense", s, 10_000 + s) for s in range(0, 200_000, 97)]
    got = events.accepted_arrivals(arrivals(spark, rows), "key", "ts", ["ident"], 7200, slice_seconds=slice_seconds)
    assert {r["ident"] for r in got.collect()} == brute_force(rows, 7200)


def jobs_of(spark, run):
    tracker, group = spark.sparkContext.statusTracker(), f"group-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(tracker.getJobIdsForGroup(group))


def test_an_outlier_in_time_changes_neither_result_nor_jobs(spark):
    rows = [("k", s, s) for s in range(0, 500_000, 977)]
    far = [("k", -60_000_000_000, -1), ("k", 200_000_000_000, -2)]

    def run(rows):
        return jobs_of(spark, lambda: {r["ident"] for r in events.accepted_arrivals(arrivals(spark, rows), "key", "ts", ["ident"], 7200).collect()})

    plain, jobs = run(rows)
    with_far, more_jobs = run(rows + far)
    assert with_far == plain | {-1, -2} == brute_force(rows + far, 7200)
    assert abs(more_jobs - jobs) <= 1


def test_arrivals_without_key_or_time(spark):
    df = spark.createDataFrame([("k", 5, 1), ("k", None, 2), (None, 5, 3)], "key string, s bigint, ident bigint").select(
        "key", F.timestamp_seconds("s").alias("ts"), "ident")
    marked = events.dedup_ttl(df, "key", "ts", ["ident"])
    assert {r["ident"]: r["is_accepted"] for r in marked.collect()} == {1: True, 2: False, 3: False}


def test_routing_order(spark):
    rows = [("b", "orders/a.csv", 0, 0), ("b", "orders/a.csv", 5, 1), ("x", "orders/a.csv", 1, 2),
            ("b", "orders/b.csv", 9, 3)]
    df = spark.createDataFrame(rows, "bucket string, key string, s bigint, ident bigint").withColumn(
        "ts", F.timestamp_seconds("s"))
    routed = events.route_events(df, "b", ["orders/"], "ts", ["ident"])
    assert {r["ident"]: r["status"] for r in routed.collect()} == {
        0: "accepted", 1: "duplicate", 2: "skipped", 3: "accepted"}
    assert {r["status"]: r["row_count"] for r in events.outcome_counts(routed).collect()} == {
        "accepted": 2, "duplicate": 1, "skipped": 1}


def test_locks_released_after_their_time(spark):
    taken = spark.createDataFrame([("a", 100), ("b", 5000)], "key string, second bigint")
    old = spark.createDataFrame([("a", 50), ("c", 60)], "key string, second bigint")
    live = events.live_locks(old, taken, expired_at=60)
    assert sorted(tuple(r) for r in live.collect()) == [("a", 100), ("b", 5000)]


def test_alert_threshold(spark):
    df = spark.createDataFrame([(0,), (10,), (299,), (300,), (900,)], "s bigint").select(
        F.timestamp_seconds("s").alias("ts"))
    got = events.alert_windows(df, "ts", threshold=2).collect()
    assert [(r["window_start"].minute, r["metric_sum"]) for r in got] == [(0, 3)]
