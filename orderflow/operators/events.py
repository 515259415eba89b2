"""File-arrival events: parse, validate, drop repeats, route, count, alert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions import ends_with_any, event_key_decode, partition_date, starts_with_any
from orderflow.functions.time import epoch_seconds
from orderflow.sources.workdir import stored_observed

# Event format names, accepted endings, repeat window, alert window.
TEST_EVENT = "s3:TestEvent"
EXTENSIONS = [".parquet", ".csv", ".json", ".gz"]
TTL_SECONDS = 86400
ALERT_SECONDS = 300
ALERT_THRESHOLD = 1

# Time of one key that a task sorts when repeats are dropped: 30 days.
SLICE_SECONDS = 30 * 86400

_NAMED = "struct<bucket: struct<name: string>, object: struct<key: string>>"
_RECORD = f"Event: string, s3: {_NAMED}, detail: {_NAMED}, body: string"
# One schema for all three envelopes: a list of records, or a record by itself. Text that is no JSON goes to _broken.
_ENVELOPE = (f"Records array<struct<{_RECORD}>>, Event string, s3 {_NAMED}, detail {_NAMED}, body string, "
             "_broken string")
_OPTIONS = {"columnNameOfCorruptRecord": "_broken"}
# Stands for the event name of a message or body that can't be read.
_UNREADABLE = "\x00unreadable"

ACCEPTED, DUPLICATE, SKIPPED, MALFORMED = "accepted", "duplicate", "skipped", "malformed"


def _own_record(envelope: Column) -> Column:
    """The envelope as the one record it holds; a broken one as a record that says so."""
    event = F.when(envelope["_broken"].isNotNull(), F.lit(_UNREADABLE)).otherwise(envelope["Event"])
    return F.array(F.struct(event.alias("Event"), *[envelope[f].alias(f) for f in ("s3", "detail", "body")]))


def parse_events(
    df: DataFrame,
    payload: str,
    run_date: dt.date,
    wrapped_bus_events: bool = True,
) -> DataFrame:
    """Rows (…, record_no, bucket, key, partition_date, malformed), one per file named in an event.

    Understands a notification, a queue message whose body is a notification, and a bus event.
    Keys are URL-decoded in notifications only. Test events and events without bucket or key
    give no row. A message or body that is no JSON, or NULL, gives a row that is ``malformed``, without
    bucket, key and date. ``wrapped_bus_events=False`` ignores bus events inside queue messages.
    """
    kept = [c for c in df.columns if c != payload]
    # Each JSON text is parsed in a column of its own, so once per message and once per body.
    def spoken(c: Column) -> Column:
        # An empty text would parse to NULL and be taken for no message at all.
        return F.when(F.trim(c) == "", F.lit("empty")).otherwise(c)

    text = F.coalesce(spoken(F.col(payload)), F.lit("none"))
    messages = df.select(*kept, F.from_json(text, _ENVELOPE, _OPTIONS).alias("_message"))
    records = messages.select(*kept, F.coalesce(
        F.col("_message.Records"), _own_record(F.col("_message"))).alias("_records"))
    bodies = records.select(*kept, "_records", F.transform(
        "_records", lambda r: F.from_json(spoken(r["body"]), _ENVELOPE, _OPTIONS)).alias("_bodies"))

    def unwrap(record: Column, i: Column) -> Column:
        body = F.get("_bodies", i)
        alone = _own_record(body)
        if not wrapped_bus_events:
            alone = F.when(body["_broken"].isNotNull(), alone).otherwise(F.array().cast(f"array<struct<{_RECORD}>>"))
        return F.when(record["body"].isNull(), F.array(record)).otherwise(
            F.coalesce(body["Records"], alone))

    event = bodies.select(*kept, F.posexplode(
        F.flatten(F.transform("_records", unwrap))).alias("record_no", "_e"))

    notified = (F.col("_e.s3.bucket.name") != "") & (F.col("_e.s3.object.key") != "")
    bucket = F.when(notified, F.col("_e.s3.bucket.name")).otherwise(F.col("_e.detail.bucket.name"))
    key = F.when(notified, event_key_decode(F.col("_e.s3.object.key"))).otherwise(
        F.col("_e.detail.object.key"))
    unreadable = F.coalesce(F.col("_e.Event") == _UNREADABLE, F.lit(False))
    day = F.when(~F.col("malformed"), partition_date(F.col("key"), F.lit(run_date.isoformat())))
    return (
        event.filter(F.coalesce(F.col("_e.Event"), F.lit("")) != TEST_EVENT)
        .select(*kept, "record_no", bucket.alias("bucket"), key.alias("key"), unreadable.alias("malformed"))
        .filter("malformed or (bucket <> '' and key <> '')")
        .select(*kept, "record_no", "bucket", "key", day.alias("partition_date"), "malformed")
    )


def rejection(bucket: str, prefixes: Sequence[str], malformed: Column | None = None) -> Column:
    """Why an arrival is not wanted, first reason first; NULL when it is."""
    key = F.col("key")
    return F.coalesce(
        F.when(F.lit(False) if malformed is None else malformed, F.lit("message is not JSON")),
        F.when(F.col("bucket") != bucket,
               F.concat(F.lit("unexpected bucket: "), F.col("bucket"), F.lit(f" (expected {bucket})"))),
        F.when(~starts_with_any(key, prefixes), F.concat(F.lit("key outside the valid prefixes: "), key)),
        F.when(~ends_with_any(key, EXTENSIONS), F.concat(F.lit("unsupported file extension: "), key)),
    )


def validate_events(df: DataFrame, bucket: str, prefixes: Sequence[str]) -> DataFrame:
    return df.withColumn("reason", rejection(bucket, prefixes, F.col("malformed") if "malformed" in df.columns else None))


def _pointers(seconds: DataFrame, key: str, ttl_seconds: int, slice_seconds: int) -> DataFrame:
    """(key, second, to, reached): seconds that are accepted whatever else is, and each second's next one.

    A second with none in the ttl before it heads a chain and is accepted; ``to`` is the first second of the chain that is at least a ttl
    later. Both are found within slices of time, with the seconds a ttl around a slice copied into it: a slice of one
    key is what a task sorts, and it spills. Seconds that neither head a chain nor have a next one are left out.
    """
    width, own = F.lit(slice_seconds), F.floor(F.col("second") / slice_seconds)
    before = F.when(F.col("second") - own * width < ttl_seconds, own - 1)
    after = F.when(F.col("second") >= (own + 1) * width - ttl_seconds, own + 1)
    data = seconds.select(
        key, "second", own.alias("_own"), F.explode(F.array_compact(F.array(own, before, after))).alias("_slice")).select(
        key, "_slice", F.col("second").alias("_at"), F.col("second").alias("_data"), F.col("second").alias("_from"),
        (F.col("_slice") == F.col("_own")).alias("_is_own"))
    goal = F.col("second") + ttl_seconds
    goals = seconds.select(key, F.floor(goal / slice_seconds).alias("_slice"), goal.alias("_at"), F.lit(None).cast("bigint").alias("_data"),
                           F.col("second").alias("_from"), F.lit(False).alias("_is_own"))
    slice_ = Window.partitionBy(key, "_slice")
    rising = slice_.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    falling = slice_.orderBy(F.desc("_at"), F.desc_nulls_last("_data")).rowsBetween(Window.unboundedPreceding, 0)
    seen = data.unionByName(goals).select(
        key, "_at", "_data", "_from", "_is_own", F.last("_data", ignorenulls=True).over(rising).alias("_before"),
        F.last("_data", ignorenulls=True).over(falling).alias("_next"))
    lone = F.col("_is_own") & (F.col("_before").isNull() | (F.col("_at") - F.col("_before") >= ttl_seconds))
    step = F.when(F.col("_data").isNull() & (F.col("_next") - F.col("_at") < ttl_seconds), F.col("_next"))
    return _joined_up(seen.select(key, F.col("_from").alias("second"), step.alias("to"), lone.alias("reached")), key)


def _joined_up(pointers: DataFrame, key: str) -> DataFrame:
    told = pointers.filter("to is not null or reached")
    return told.groupBy(key, "second").agg(F.max("to").alias("to"), F.bool_or("reached").alias("reached"))


def _doubled(pointers: DataFrame, key: str) -> DataFrame:
    """Where accepted seconds point is accepted too; then each pointer goes as far again."""
    going, done = pointers.filter("to is not null"), pointers.filter("to is null")
    onward = going.select(key, F.col("second").alias("to"), F.col("to").alias("_beyond"))
    further = going.join(onward, [key, "to"], "left").select(key, "second", F.col("_beyond").alias("to"), "reached")
    met = going.filter("reached").select(key, F.col("to").alias("second"), F.lit(None).cast("bigint").alias("to"), F.lit(True).alias("reached"))
    return _joined_up(further.unionByName(met).unionByName(done), key)


def accepted_arrivals(
    df: DataFrame,
    key: str,
    ts: str,
    ident: Sequence[str],
    ttl_seconds: int = TTL_SECONDS,
    locks: DataFrame | None = None,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """(key, second, *ident) of the arrivals that find no lock: the first of a key, then each
    first one at least ``ttl_seconds`` after the last *accepted* one. Arrivals without a time or key find none free.

    Arrivals are first reduced to the distinct seconds of a key, combined before the shuffle. Where a key is silent for
    a ttl a new chain starts, whose head is accepted. Within chains each second points to the first one a ttl later,
    and pointers are doubled from the heads on: as many rounds as the logarithm of the most acceptances in a row, whatever the calendar between
    the first and the last arrival. No row holds a key's history. ``df`` is scanned twice: store it first when it is costly to compute.
    ``locks`` (key, second) carries the last accepted second of each key over from earlier batches. ``ident`` names one
    arrival within its key.
    """
    timed = df.select(key, epoch_seconds(df, ts).alias("second"), ts, *ident).filter(F.col("second").isNotNull() & F.col(key).isNotNull())
    seconds = timed.select(key, "second").distinct()
    if locks is not None:
        held = locks.groupBy(key).agg(F.max("second").alias("_locked"))
        free = F.col("_locked").isNull() | (F.col("second") >= F.col("_locked") + ttl_seconds)
        seconds = seconds.join(held, key, "left").filter(free).select(key, "second")
    going = F.count("to").alias("going")
    pointers, found = stored_observed(_pointers(seconds, key, ttl_seconds, max(slice_seconds, 2 * ttl_seconds)), "chains", going)
    while found["going"]:
        pointers, found = stored_observed(_doubled(pointers, key), "chains", going)
    taken = pointers.filter("reached").select(key, "second")
    # Of the arrivals within one accepted second the first is the one; the join leaves few of them.
    return (
        timed.join(taken, [key, "second"])
        .groupBy(key, "second").agg(F.min(F.struct(ts, *ident)).alias("_first"))
        .select(key, "second", *[F.col(f"_first.{c}").alias(c) for c in ident])
    )


def dedup_ttl(
    df: DataFrame,
    key: str,
    ts: str,
    ident: Sequence[str],
    ttl_seconds: int = TTL_SECONDS,
    locks: DataFrame | None = None,
) -> DataFrame:
    """Every arrival with ``is_accepted``. Joined on the arrival's identity, so a busy key spreads."""
    taken = accepted_arrivals(df, key, ts, ident, ttl_seconds, locks)
    winners = taken.select(key, *ident, F.lit(True).alias("is_accepted"))
    return df.join(winners, [key, *ident], "left").withColumn(
        "is_accepted", F.coalesce("is_accepted", F.lit(False)))


def route_events(
    parsed: DataFrame,
    bucket: str,
    prefixes: Sequence[str],
    ts: str,
    ident: Sequence[str],
    ttl_seconds: int = TTL_SECONDS,
    locks: DataFrame | None = None,
) -> DataFrame:
    """Status per arrival, tried in the order malformed, skipped, duplicate, accepted; only valid arrivals lock."""
    checked = validate_events(parsed, bucket, prefixes)
    taken = accepted_arrivals(
        checked.filter(F.col("reason").isNull()), "key", ts, ident, ttl_seconds, locks)
    winners = taken.select("key", *ident, F.lit(True).alias("_taken"))
    malformed = F.col("malformed") if "malformed" in parsed.columns else F.lit(False)
    status = (
        F.when(malformed, MALFORMED).when(F.col("reason").isNotNull(), SKIPPED).when(F.col("_taken"), ACCEPTED).otherwise(DUPLICATE)
    )
    return checked.join(winners, ["key", *ident], "left").withColumn("status", status).drop("_taken")


def live_locks(
    locks: DataFrame | None, accepted: DataFrame, key: str = "key", expired_at: int | None = None
) -> DataFrame:
    """Newest lock per key after a batch, without those that ended before ``expired_at``."""
    both = accepted.select(key, "second")
    if locks is not None:
        both = both.unionByName(locks.select(key, "second"))
    newest = both.groupBy(key).agg(F.max("second").alias("second"))
    return newest if expired_at is None else newest.filter(F.col("second") > expired_at)


def outcome_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("status").agg(F.count(F.lit(1)).alias("row_count"))


def dates_to_run(routed: DataFrame) -> DataFrame:
    """The partition dates that accepted arrivals call for."""
    return routed.filter(F.col("status") == ACCEPTED).select("partition_date").distinct()


def alert_windows(
    df: DataFrame,
    ts: str,
    metric: Column | None = None,
    seconds: int = ALERT_SECONDS,
    threshold: float = ALERT_THRESHOLD,
) -> DataFrame:
    """Tumbling windows whose summed metric (default: rows) reaches the threshold.

    Windows without data raise no alert. Works on batches, and on streams with a watermark.
    """
    metric = F.lit(1) if metric is None else metric
    return (
        df.groupBy(F.window(ts, f"{seconds} seconds").alias("_w"))
        .agg(F.sum(metric).alias("metric_sum"))
        .filter(F.col("metric_sum") >= threshold)
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "metric_sum")
    )
