import datetime as dt
import os
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.context import PipelineConfig, RunContext
from orderflow.operators import quality
from orderflow.operators.events import ACCEPTED
from orderflow.operators.quality import GateFailed
from orderflow.plans import batch as batch_plan
from orderflow.plans.batch import DimensionError, LoadMismatch, run_batch, validate_load
from orderflow.schemas import FACT, RAW_LANDING, max_length
from orderflow.sources import readers, target, workdir, writers
from orderflow.streaming.arrivals import alert_stream, alert_updates, read_alerts, read_routed, route_stream, stream_outcomes
from orderflow.streaming.ingest import batch_context, run_incremental
from orders import CTX, raw


def rows(spark, wave):
    return raw(spark, *[
        {"order_id": f"O{i}", "city": f"w{wave}", "order_date": f"2024-0{i % 3 + 1}-10",
         **({"quantity": "0"} if i == 7 else {}), **({"order_date": "2024-02-30"} if i == 8 else {})}
        for i in range(wave * 10, wave * 10 + 30)])


def deliver(spark, root, wave):
    rows(spark, wave).write.mode("append").parquet(f"{root}/year=2024/month=01/day={wave + 10:02d}")


def published(spark, cfg):
    return {r["order_id"]: r["city"] for r in target.read_target(spark, cfg.target_root).collect()}


def config(tmp_path, **kw):
    return PipelineConfig.under(str(tmp_path / "landing"), str(tmp_path / "out"),
                                source_format="parquet", **kw)


def test_batch_run_end_to_end(spark, tmp_path):
    cfg = config(tmp_path, partition_date=dt.date(2024, 1, 10))
    deliver(spark, cfg.source_root, 0)
    result = run_batch(spark, cfg, CTX)
    assert (result.rows_read, result.rows_rejected, result.rows_inserted, result.rows_updated) == (30, 2, 28, 0)
    assert len(published(spark, cfg)) == 28
    assert spark.read.parquet(result.export_path).agg(F.sum("order_count")).first()[0] == 28
    assert spark.read.option("recursiveFileLookup", True).parquet(cfg.rejected_root).count() == 2

    deliver(spark, cfg.source_root, 1)
    again = run_batch(spark, config(tmp_path, partition_date=dt.date(2024, 1, 11)),
                      RunContext("22222222-2222-2222-2222-222222222222", CTX.run_ts, CTX.as_of, "unit"))
    assert (again.rows_inserted, again.rows_updated) == (10, 20)
    cities = published(spark, cfg)
    assert len(cities) == 38 and cities["O10"] == "w1" and cities["O9"] == "w0"
    log = spark.read.parquet(cfg.audit_root).orderBy("audit_id").collect()
    assert [(r["audit_id"], r["status"], r["rows_updated"]) for r in log] == [
        (1, "SUCCESS", 0), (2, "SUCCESS", 20)]


def test_gate_failure_is_logged_and_loads_nothing(spark, tmp_path):
    cfg = config(tmp_path, max_reject_pct=1.0)
    deliver(spark, cfg.source_root, 0)
    with pytest.raises(GateFailed):
        run_batch(spark, cfg, CTX)
    log = spark.read.parquet(cfg.audit_root).collect()
    assert [r["status"] for r in log] == ["FAILED"] and "1 of 30" in log[0]["error_message"]
    assert (log[0]["rows_read"], log[0]["rows_rejected"], log[0]["rows_inserted"]) == (30, 1, None)
    assert not os.path.exists(f"{cfg.target_root}/staging/run_id={CTX.run_id}")
    assert published(spark, cfg) == {}


def test_a_day_without_files_is_a_successful_no_op(spark, tmp_path):
    cfg = config(tmp_path, partition_date=dt.date(2023, 1, 1))
    deliver(spark, cfg.source_root, 0)
    result = run_batch(spark, cfg, CTX)
    assert (result.status, result.rows_read, result.rows_inserted) == ("SUCCESS", 0, 0)


def test_a_killed_run_stays_visible(spark, tmp_path, monkeypatch):
    cfg = config(tmp_path, partition_date=dt.date(2024, 1, 10))
    deliver(spark, cfg.source_root, 0)

    def killed(*args, **kw):
        assert [(r["audit_id"], r["status"]) for r in batch_plan.audit_log(spark, cfg).collect()] == [(1, "RUNNING")]
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(batch_plan, "load_batch", killed)
        with pytest.raises(KeyboardInterrupt):
            run_batch(spark, cfg, CTX)
    run_batch(spark, cfg, RunContext("again", CTX.run_ts, CTX.as_of, "unit"))
    log = {r["audit_id"]: (r["run_id"], r["status"], r["partition_date"]) for r in batch_plan.audit_log(spark, cfg).collect()}
    assert log == {1: (CTX.run_id, "RUNNING", dt.date(2024, 1, 10)), 2: ("again", "SUCCESS", dt.date(2024, 1, 10))}


def test_ids_that_become_one_stop_the_load(spark, tmp_path):
    cfg = config(tmp_path)
    long = "O" * (max_length(FACT["order_id"]) - 1)
    raw(spark, {"order_id": long + "12"}, {"order_id": long + "1"}, {"order_id": "short"}).write.parquet(f"{cfg.source_root}/year=2024/month=01/day=01")
    with pytest.raises(LoadMismatch, match="3 rows but 2 order ids"):
        run_batch(spark, cfg, CTX)
    assert published(spark, cfg) == {}


def test_a_load_scans_its_input_once(spark, tmp_path):
    """The gate, the staged and the contract counts come from the writes: no job of the load only counts its stored rows."""
    cfg = config(tmp_path)
    deliver(spark, cfg.source_root, 0)
    counted = []
    real = DataFrame.count
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrame, "count", lambda df: counted.append(df) or real(df))
        patch.setattr(quality, "gate", None)
        result = run_batch(spark, cfg, CTX)
    # the one count left is that of a batch which replaces nothing
    assert len(counted) <= 1 and (result.rows_read, result.rows_rejected, result.rows_inserted) == (30, 2, 28)


def test_a_load_moves_staged_rows_once_and_survivors_alone(spark, tmp_path, monkeypatch):
    """Rows go from the staged files to the target without a stored copy between, and without moving."""
    cfg, wrote, write = config(tmp_path), [], target.write_partitioned

    def watched(df, path, **options):
        wrote.append((df.count(), options, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, path, **options)
    monkeypatch.setattr(target, "write_partitioned", watched)
    monkeypatch.setattr(batch_plan, "_written", lambda df, path, *m, real=batch_plan._written: (wrote.append(path.rpartition("/")[2]), real(df, path, *m))[1])
    for wave in (0, 1):
        deliver(spark, cfg.source_root, wave)
        run_batch(spark, config(tmp_path, partition_date=dt.date(2024, 1, 10 + wave)), RunContext(f"r{wave}", CTX.run_ts, CTX.as_of, "unit"))
    assert [w if isinstance(w, str) else w[0] for w in wrote] == ["tagged", 28, "tagged", 30, 8]
    for _, options, plan in (wrote[1], wrote[3]):
        assert options["gathered"] and "RebalancePartitions" not in plan
    assert wrote[4][1]["mode"] == "append" and len(published(spark, cfg)) == 38
    # a file a month and run, and one for the rows that stay
    files = [readers.list_files(spark, f"{cfg.target_root}/data/run_id=r{wave}", "*.parquet").count() for wave in (0, 1)]
    assert files[0] == 3 and files[1] <= 6


def test_scans_for_a_sort_are_cut_small(spark, tmp_path):
    path, before = str(tmp_path / "rows"), spark.conf.get(workdir._TASK_BYTES)
    rows, _ = batch_plan._written(spark.range(0, 4_000_000, 1, 1).select(F.xxhash64("id").alias("h")), path, F.count("h").alias("n"))
    with workdir.small_tasks(spark, 1024 * 1024):
        most = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        with workdir.small_tasks(spark, 2**40):
            assert spark.conf.get(workdir._TASK_BYTES) == str(1024 * 1024)
    assert most <= 2_200_000 and spark.conf.get(workdir._TASK_BYTES) == before


def test_a_published_run_that_is_repeated_keeps_its_rows(spark, tmp_path):
    cfg = config(tmp_path)
    for wave in (0, 1):
        deliver(spark, cfg.source_root, wave)
        run = RunContext(f"r{wave}", CTX.run_ts, CTX.as_of, "unit")
        run_batch(spark, config(tmp_path, partition_date=dt.date(2024, 1, 10 + wave)), run)
    before = published(spark, cfg)
    again = batch_plan.load_batch(spark, readers.read_raw(spark, cfg.source_root, "parquet", dt.date(2024, 1, 11)), cfg, run)
    assert (again.rows_inserted, again.rows_updated) == (0, 0) and published(spark, cfg) == before and len(before) == 38


def test_a_load_with_dimensions_loads_the_same_rows(spark, tmp_path):
    products = spark.createDataFrame([("GARDEN-8", 5)], "product_id string, product_sk bigint")
    found = {}
    for name, given in (("without", None), ("with", products)):
        cfg = PipelineConfig.under(str(tmp_path / "landing"), str(tmp_path / name), source_format="parquet")
        if name == "without":
            deliver(spark, cfg.source_root, 0)
        result = run_batch(spark, cfg, CTX, products=given)
        rejected = spark.read.option("recursiveFileLookup", True).parquet(f"{cfg.rejected_root}/contract").collect()
        assert (result.rows_inserted, result.rows_rejected, [r["_dq_failure"] for r in rejected]) == (28, 2, ["contract:order_date is null"])
        found[name] = target.read_target(spark, cfg.target_root)
    assert {r[0] for r in found["with"].select("product_sk").collect()} == {5}
    assert sorted(map(str, found["with"].drop("product_sk").collect())) == sorted(map(str, found["without"].drop("product_sk").collect()))


def shuffle_files(disk):
    return {str(p) for folder in disk.localDirs() for p in Path(folder.getPath()).rglob("shuffle_*")}


def test_shuffle_files_go_with_the_write_that_made_them(spark, tmp_path):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = spark.conf.get(workdir._SHUFFLES_GO)
    old = shuffle_files(files)
    rows = spark.read.parquet(writers.write_partitioned(spark.range(1000).withColumn("part", F.col("id") % 3), str(tmp_path / "moved"), ["part"]))
    for _ in range(50):
        if not (left := shuffle_files(files) - old):
            break
        time.sleep(0.1)
    assert not left and rows.count() == 1000 and spark.conf.get(workdir._SHUFFLES_GO) == before


def test_load_check_raises_on_a_difference(spark, tmp_path):
    cfg = config(tmp_path)
    deliver(spark, cfg.source_root, 0)
    run_batch(spark, cfg, CTX)
    fact = target.read_target(spark, cfg.target_root)
    validate_load(fact, CTX.run_id, 28, 28, CTX.run_ts)
    for wrong in ((29, 28, CTX.run_ts), (28, 27, CTX.run_ts), (28, 28, CTX.run_ts + dt.timedelta(seconds=1))):
        with pytest.raises(LoadMismatch):
            validate_load(fact, CTX.run_id, *wrong)
    profile = spark.read.parquet(f"{cfg.target_root}/statistics/run_id={CTX.run_id}").filter("column_name = 'order_id'").first()
    assert (profile["row_count"], profile["null_count"]) == (28, 0)


def test_bad_dimensions_stop_a_run_before_it_loads(spark, tmp_path):
    cfg = config(tmp_path)
    deliver(spark, cfg.source_root, 0)
    products = spark.createDataFrame([("P", 1), ("P", 2)], "product_id string, product_sk bigint")
    with pytest.raises(DimensionError):
        run_batch(spark, cfg, CTX, products=products)
    log = spark.read.parquet(cfg.audit_root).collect()
    assert [(r["status"], r["rows_read"]) for r in log] == [("FAILED", None)] and published(spark, cfg) == {}


def test_incremental_takes_both_formats_logs_and_exports(spark, tmp_path):
    cfg, checkpoint = PipelineConfig.under(str(tmp_path / "landing"), str(tmp_path / "out")), str(tmp_path / "checkpoint")
    deliver(spark, cfg.source_root, 0)
    rows(spark, 3).write.option("header", True).csv(f"{cfg.source_root}/year=2024/month=01/day=20", compression="gzip")
    run_incremental(spark, cfg, checkpoint, CTX.as_of)
    assert len(published(spark, cfg)) == 58
    log = spark.read.parquet(cfg.audit_root).collect()
    assert [(r["status"], r["rows_read"], r["rows_inserted"]) for r in log] == [("SUCCESS", 60, 58)]
    assert spark.read.option("recursiveFileLookup", True).parquet(cfg.export_root).agg(F.sum("order_count")).first()[0] == 58


def test_a_replayed_micro_batch_has_the_same_folders(spark, tmp_path):
    one, two = (batch_context(spark, str(tmp_path / "c"), 4, CTX.as_of, "j") for _ in range(2))
    assert (one.run_id, one.stamp) == (two.run_id, two.stamp)
    assert batch_context(spark, str(tmp_path / "c"), 5, CTX.as_of, "j").run_id != one.run_id


def test_incremental_equals_batch_and_restarts(spark, tmp_path):
    cfg, checkpoint = config(tmp_path), str(tmp_path / "checkpoint")
    results = []
    for wave in (0, 1):
        deliver(spark, cfg.source_root, wave)
        run_incremental(spark, cfg, checkpoint, CTX.as_of, on_batch=lambda c, r: results.append(r))
    run_incremental(spark, cfg, checkpoint, CTX.as_of, on_batch=lambda c, r: results.append(r))
    assert [(r.rows_read, r.rows_inserted, r.rows_updated) for r in results] == [(30, 28, 0), (30, 10, 20)]

    batch = PipelineConfig.under(cfg.source_root, str(tmp_path / "batch"), source_format="parquet")
    for wave in (0, 1):
        dated = PipelineConfig.under(cfg.source_root, str(tmp_path / "batch"), source_format="parquet",
                                     partition_date=dt.date(2024, 1, 10 + wave))
        run_batch(spark, dated, RunContext(f"r{wave}", CTX.run_ts, CTX.as_of, "unit"))
    assert published(spark, cfg) == published(spark, batch)


def test_config_from_arguments():
    roots = ["source", "staging", "manifest", "target", "export", "audit", "rejected"]
    argv = [a for r in roots for a in (f"--{r}-root", f"/{r}")]
    cfg = PipelineConfig.from_args([*argv, "--partition-date", "2024-01-15", "--lookback-days", "3"])
    assert (cfg.partition_date, cfg.lookback_days, cfg.max_reject_pct) == (dt.date(2024, 1, 15), 3, 5.0)
    assert cfg.source_root == "/source" and cfg.table == "fact_orders" and list(cfg.keys) == ["order_id"]
    more = PipelineConfig.from_args([*argv, "--keys", "order_id,product_id", "--customers-path", "/c", "--single-line-csv"])
    assert (list(more.keys), more.customers_path, more.products_path, more.multi_line) == (["order_id", "product_id"], "/c", None, False)


def test_locks_outlive_a_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "event_id bigint, record_no int, ts timestamp, bucket string, key string, partition_date string"

    def deliver_events(*seconds):
        first = seconds[0]
        spark.createDataFrame([(s, 0, "b", "orders/k.csv", "x") for s in seconds],
                              "event_id bigint, record_no int, bucket string, key string, partition_date string"
                              ).withColumn("ts", F.timestamp_seconds("event_id")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        route_stream(stream, out, checkpoint, "b", ["orders/"])
        return first

    deliver_events(0, 10)
    # the time of another key far ahead does not end a lock
    spark.createDataFrame([(10_000_000, 0, "b", "orders/other.csv", "x")], "event_id bigint, record_no int, bucket string, key string, partition_date string"
                          ).withColumn("ts", F.timestamp_seconds("event_id")).write.mode("append").parquet(source)
    deliver_events(500, 90_000)
    deliver_events(80_000)
    deliver_events(100_000, 180_001)
    accepted = read_routed(spark, out).filter((F.col("status") == ACCEPTED) & (F.col("key") == "orders/k.csv"))
    assert sorted(r["event_id"] for r in accepted.collect()) == [0, 90_000, 180_001]
    assert read_routed(spark, out).count() == 8


def routed_in_turn(spark, tmp_path, *deliveries, **more):
    """Seconds delivered one after the other to restarted streams; the queries, and the status of each second."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "event_id bigint, record_no int, ts timestamp, bucket string, key string, partition_date string"
    queries = []
    for rows in deliveries:
        spark.createDataFrame([(s, 0, "b", key, "x") for s, key in rows],
                              "event_id bigint, record_no int, bucket string, key string, partition_date string"
                              ).withColumn("ts", F.timestamp_seconds("event_id")).write.mode("append").parquet(source)
        queries.append(route_stream(spark.readStream.schema(schema).parquet(source), out, checkpoint, "b", ["orders/"], **more))
    return queries, {r["event_id"]: r["status"] for r in read_routed(spark, out).collect()}


def test_locks_end_by_the_watermark(spark, tmp_path):
    many = [(1000 + i, f"orders/{i}.csv") for i in range(30)]
    queries, status = routed_in_turn(
        spark, tmp_path, many, [(200_000, "orders/far.csv")], [(1010, "orders/0.csv")], delay_seconds=100_000)
    # the watermark of 100,000 is past the end of the first locks; the one left is that of the newest arrival
    rows = [q.lastProgress["stateOperators"][0]["numRowsTotal"] for q in queries]
    assert rows[0] >= 30 and rows[1] < 5
    assert status[1010] == "accepted" and status[1000] == "accepted"


def test_arrivals_from_the_future_end_no_lock(spark, tmp_path):
    _, status = routed_in_turn(
        spark, tmp_path, [(1_700_000_000, "orders/a.csv")], [(250_000_000_000, "orders/far.csv")], [(1_700_000_010, "orders/a.csv")],
        delay_seconds=400 * 366 * 86400)
    assert status == {1_700_000_000: "accepted", 250_000_000_000: "accepted", 1_700_000_010: "duplicate"}


def test_a_busy_key_in_pieces(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    seconds = [rng.randrange(400_000) for _ in range(6000)]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    frame = spark.createDataFrame([(i, None if i % 50 == 0 else 0, s) for i, s in enumerate(seconds)], "event_id bigint, record_no int, s bigint")
    frame = frame.select("event_id", "record_no", F.timestamp_seconds("s").alias("ts"), F.lit("b").alias("bucket"), F.lit("orders/k.csv").alias("key"),
                         F.lit(None).cast("string").alias("partition_date"), (F.col("s") / 7).alias("more"))
    frame.write.parquet(source)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        route_stream(spark.readStream.schema(frame.schema).parquet(source), out, checkpoint, "b", ["orders/"], ttl_seconds=3600)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    last, want = None, set()
    for s, no, i in sorted((s, -1 if i % 50 == 0 else 0, i) for i, s in enumerate(seconds)):
        if last is None or s >= last + 3600:
            last = s
            want.add(i)
    assert {r["event_id"] for r in read_routed(spark, out, ACCEPTED).collect()} == want
    back = read_routed(spark, out).select(*frame.columns)
    assert back.count() == 6000 and back.exceptAll(frame).isEmpty() and back.schema.simpleString() == frame.schema.simpleString()


def test_arrivals_without_time_and_each_status_in_its_folder(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = [(1, 5, "b", "orders/k.csv"), (2, None, "b", "orders/k.csv"), (3, 7, "b", "orders/k.csv"), (4, 8, "other", "orders/k.csv")]
    frame = spark.createDataFrame(rows, "event_id bigint, s bigint, bucket string, key string").select(
        "event_id", F.timestamp_seconds("s").alias("ts"), "bucket", "key")
    frame.write.parquet(source)
    query = route_stream(spark.readStream.schema(frame.schema).parquet(source), out, checkpoint, "b", ["orders/"], ident=["event_id"])
    assert stream_outcomes(query) == {"malformed": 0, "skipped": 1, "duplicate": 2, "accepted": 1}
    for status, want in (("accepted", {1}), ("duplicate", {2, 3}), ("skipped", {4})):
        assert {r["event_id"] for r in read_routed(spark, out, status).collect()} == want
        assert {r["event_id"] for r in spark.read.parquet(f"{out}/routed/status={status}").collect()} == want


def test_every_alert_window_is_there_at_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for start in (0, 250):
        spark.createDataFrame([(start + s,) for s in (0, 10, 400)], "s bigint").select(
            F.timestamp_seconds("s").alias("ts")).write.mode("append").parquet(source)
        alert_updates(spark.readStream.schema("ts timestamp").parquet(source), "ts", out, checkpoint)
    got = sorted((int(r["window_start"].timestamp()), r["metric_sum"]) for r in read_alerts(spark, out).collect())
    assert got == [(0, 4), (300, 1), (600, 1)]


def test_alert_stream_emits_each_closed_window_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for start in (0, 3000):
        spark.createDataFrame([(start + s,) for s in (0, 10, 400, 2000)], "s bigint").select(
            F.timestamp_seconds("s").alias("ts")).write.mode("append").parquet(source)
        alert_stream(spark.readStream.schema("ts timestamp").parquet(source), "ts", out, checkpoint)
    got = sorted((int(r["window_start"].timestamp()), r["metric_sum"])
                 for r in spark.read.parquet(out).collect())
    assert got == [(0, 2), (300, 1), (1800, 1), (3000, 2), (3300, 1)]


def test_landing_schema_has_partitions_last():
    assert RAW_LANDING.names[-3:] == ["year", "month", "day"]
