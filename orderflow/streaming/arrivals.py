"""Arrival events as a stream: routing with locks in Spark's keyed state, and alert windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from orderflow.functions.time import epoch_seconds
from orderflow.operators import events
from orderflow.operators.events import TTL_SECONDS

# How late an arrival may come and still be held against the lock of its time. A lock is a key and a number on an
# executor's disk, so a whole season of them is cheap.
DELAY_SECONDS = 120 * 86400
# Keys whose locks a call goes through together are those of a bucket; it holds a micro-batch's arrivals of one bucket. A
# checkpoint keeps the number it was begun with.
BUCKETS = 512

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_routed(spark: SparkSession, root: str, status: str | None = None) -> DataFrame:
    """All routed arrivals, or those of one status: each status has a folder of its own."""
    routed = spark.read.parquet(f"{root}/routed")
    return routed if status is None else routed.filter(F.col("status") == status)


@contextmanager
def _keyed_state(spark: SparkSession) -> Iterator[None]:
    """State that lives on executors' disks, for a query started inside; the checkpoint remembers it."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class Locks(StatefulProcessor):
    """The last accepted second of each key of a bucket, and a timer that forgets those that no arrival in time can meet.

    A call for each key would cost more than its rows, so a call has a bucket of keys. Its state is a row per key, and one timer,
    which is set at or before the first end of a lock.
    A micro-batch's arrivals come in any order and in pieces. Of those of a key in one second only the first can be accepted, so
    a task holds one arrival per key and second and passes the others on at once. When all have come, the seconds of all keys are
    gone through in jumps: the first one free, then the first one at least the time to live after it.
    """

    def __init__(self, ttl_seconds: int, order: Sequence[str]):
        self.ttl_seconds, self.order = ttl_seconds, ["_key", "_second", *order]

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getMapState("last", T.StructType().add("key", "string"), T.StructType().add("second", "long"))

    def _set_timer(self, second: int) -> None:
        """The bucket's timer at the end of a lock of ``second``, unless it is set for an earlier one."""
        at, known = (second + self.ttl_seconds) * 1000, list(self.handle.listTimers())
        if not known or at < min(known):
            for later in known:
                self.handle.deleteTimer(later)
            self.handle.registerTimer(at)

    def _first_of_each_second(self, pieces: list[pd.DataFrame]) -> tuple[pd.DataFrame, pd.DataFrame]:
        rows = pd.concat(pieces).sort_values(self.order, kind="stable", ignore_index=True)
        later = rows.duplicated(["_key", "_second"])
        return rows[~later], rows[later]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, waiting, size = [], [], 0
        for piece in rows:
            # the columns come in order but without their names
            waiting.append(piece.set_axis(["_bucket", *self.order, "_row"], axis=1))
            size += len(piece)
            if size >= max(10_000, sum(map(len, held))):
                first, later = self._first_of_each_second([*held, *waiting])
                held, waiting, size = [first], [], 0
                yield _marked(later, False)
        first, later = self._first_of_each_second([*held, *waiting])
        yield _marked(later, False)

        names, seconds = first["_key"].to_numpy(), first["_second"].to_numpy(np.int64)
        starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        names = names[starts].tolist()
        found = [self.last.getValue((name,)) for name in names]
        before = [None if f is None else f[0] for f in found]
        taken, last = _chains(seconds, starts, before, self.ttl_seconds)
        new = {name: second for name, old, second in zip(names, before, last) if second != old}
        for name, second in new.items():
            self.last.updateValue((name,), (second,))
        if new:
            self._set_timer(min(new.values()))
        yield _marked(first, taken)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        passed = max(at, timerValues.getCurrentWatermarkInMs() - 1)
        left = []
        for (name,), (second,) in list(self.last.iterator()):
            if (second + self.ttl_seconds) * 1000 <= passed:
                self.last.removeKey((name,))
            else:
                left.append(second)
        if left:
            self.handle.registerTimer((min(left) + self.ttl_seconds) * 1000)
        return iter(())

    def close(self) -> None:
        pass


def _chains(seconds: np.ndarray, starts: np.ndarray, before: list, ttl_seconds: int) -> tuple[np.ndarray, list]:
    """Which of the rising distinct seconds of each key, whose rows begin at ``starts``, are accepted after the last one accepted
    ``before`` (None: none), and the last one accepted then. A step is one acceptance of all keys."""
    low, span = int(seconds.min()), int(seconds.max() - seconds.min())
    width = span + 2
    ends = np.append(starts[1:], len(seconds))
    place = np.repeat(np.arange(len(starts)), ends - starts) * width + (seconds - low)
    free = [0 if b is None else min(max(b + ttl_seconds - low, 0), span + 1) for b in before]
    taken, last = np.zeros(len(seconds), bool), list(before)
    rows = np.arange(len(starts))
    at = np.searchsorted(place, rows * width + np.array(free, np.int64))
    while len(going := np.flatnonzero(at < ends[rows])):
        rows, at = rows[going], at[going]
        taken[at] = True
        own = seconds[at]
        for row, second in zip(rows.tolist(), own.tolist()):
            last[row] = second
        at = np.searchsorted(place, rows * width + np.minimum(own - low + ttl_seconds, span + 1))
    return taken, last


def _marked(rows: pd.DataFrame, taken) -> pd.DataFrame:
    return pd.DataFrame({"_row": rows["_row"].to_numpy(), "_taken": taken}, index=range(len(rows)))


STATUSES = (events.MALFORMED, events.SKIPPED, events.DUPLICATE, events.ACCEPTED)
_OUTCOMES = "outcomes"
# Types that pass through text unharmed.
_PLAIN = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)


def _as_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(field.name).cast("string")
    if not isinstance(field.dataType, _PLAIN):
        raise ValueError(f"column {field.name} of type {field.dataType.simpleString()} can't be routed")
    return F.col(field.name).cast("string")


def _of_text(field: T.StructField, text: Column) -> Column:
    if isinstance(field.dataType, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint")).alias(field.name)
    return text.cast(field.dataType).alias(field.name)


def locked(valid: DataFrame, ts: str, ident: Sequence[str], ttl_seconds: int, delay_seconds: int, buckets: int = BUCKETS) -> DataFrame:
    """A stream's valid arrivals with ``_taken``: whether each finds its key free.

    The watermark is on a copy of the time that goes no further, so that timers follow it while late arrivals still come
    through. An arrival from the future does not move it: times later than now count as now.
    """
    names = list(valid.columns)
    timed = valid.withColumn("_time", F.least(F.col(ts).cast("timestamp"), F.current_timestamp()))
    timed = timed.withWatermark("_time", f"{delay_seconds} seconds")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    order = {"_micros": micros}
    for i, c in enumerate(ident):
        whole = isinstance(valid.schema[c].dataType, T.IntegralType)
        order[f"_order{i}"] = F.coalesce(F.col(c).cast("bigint"), F.lit(-2**63)) if whole else F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = timed.select(
        F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("_bucket"), F.col("key").alias("_key"), epoch_seconds(valid, ts).alias("_second"), *[c.alias(n) for n, c in order.items()],
        F.array(*[_as_text(valid.schema[c]) for c in names]).alias("_row"))
    marked = rows.groupBy("_bucket").transformWithStateInPandas(
        Locks(ttl_seconds, list(order)), "_row array<string>, _taken boolean", outputMode="Append", timeMode="EventTime")
    return marked.select(*[_of_text(valid.schema[c], F.get("_row", F.lit(i))) for i, c in enumerate(names)], "_taken")


def route_stream(
    arrivals: DataFrame,
    root: str,
    checkpoint: str,
    bucket: str,
    prefixes: Sequence[str],
    ts: str = "ts",
    ident: Sequence[str] = ("event_id", "record_no"),
    payload: str | None = None,
    run_date: dt.date | None = None,
    ttl_seconds: int = TTL_SECONDS,
    delay_seconds: int = DELAY_SECONDS,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Route all waiting arrivals, exact across micro-batches and restarts.

    ``arrivals`` holds parsed events, or raw envelopes when ``payload`` names their column. Malformed and skipped arrivals
    need no state. Of valid ones those of a bucket of keys meet in Spark's keyed state, which the checkpoint keeps. Within a micro-batch
    arrivals go by time; across micro-batches a key's last accepted second decides, so an arrival that comes late, with
    a time before that second, is a duplicate. An arrival without a time finds no free lock. A timer forgets a lock when the watermark, the newest
    time less ``delay_seconds``, has passed its end, so only an arrival that is late by more than the delay can be accepted beside an
    earlier one. Rows go to ``routed/status=…/batch_id=…``, a sink per status; a replayed micro-batch overwrites its own.
    """
    spark = arrivals.sparkSession
    parsed = arrivals if payload is None else events.parse_events(arrivals, payload, run_date or dt.date.today())
    checked = events.validate_events(parsed, bucket, prefixes)
    malformed = F.col("malformed") if "malformed" in parsed.columns else F.lit(False)
    valid = F.col("reason").isNull() & F.col(ts).isNotNull()
    apart = checked.filter(~valid).withColumn("status", F.when(malformed, events.MALFORMED).when(
        F.col("reason").isNotNull(), events.SKIPPED).otherwise(events.DUPLICATE))
    kept = locked(checked.filter(valid), ts, ident, ttl_seconds, delay_seconds, buckets)
    kept = kept.withColumn("status", F.when(F.col("_taken"), events.ACCEPTED).otherwise(events.DUPLICATE)).drop("_taken")

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "status", "batch_id").parquet(f"{root}/routed")

    routed = apart.unionByName(kept).observe(_OUTCOMES, *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    with _keyed_state(spark):
        query = (
            routed.writeStream.foreachBatch(write)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return query


def stream_outcomes(query: StreamingQuery) -> dict[str, int]:
    """Arrivals by status that a call of ``route_stream`` routed, as its writes counted them."""
    seen = [p["observedMetrics"][_OUTCOMES] for p in query.recentProgress if _OUTCOMES in p["observedMetrics"]]
    return {s: sum(row[s] for row in seen) for s in STATUSES}


def alert_stream(
    metrics: DataFrame, ts: str, path: str, checkpoint: str, delay: str = "10 minutes", **settings
) -> StreamingQuery:
    """Append each alert window once, when the watermark has closed it.

    Rows that come after their window was closed are left out; the query's progress counts them as
    ``numRowsDroppedByWatermark``. ``alert_updates`` waits for no watermark.
    """
    timed = metrics.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    query = (
        events.alert_windows(timed, ts, **settings)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that a stream left out because their window was closed."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def alert_updates(
    metrics: DataFrame, ts: str, path: str, checkpoint: str, delay: str = "10 minutes", **settings
) -> StreamingQuery:
    """Every alert window as soon as it has data, again whenever its sum changes: (batch_id, window_start, window_end, metric_sum)."""
    timed = metrics.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        events.alert_windows(timed, ts, **settings)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of each window that ``alert_updates`` has written."""
    rows = spark.read.parquet(path)
    return rows.groupBy("window_start", "window_end").agg(F.max_by("metric_sum", "batch_id").alias("metric_sum"))
