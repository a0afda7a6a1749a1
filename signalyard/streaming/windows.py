"""Streams on Spark's own stateful operators: dedupe, windows, sessions, joins, latest values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalyard.functions.payload import merged_map, props_of
from signalyard.operators.delivery import row_digest
from signalyard.operators.keys import row_order, with_tenant
from signalyard.plans.trailing import width_us
from signalyard.schemas import ERROR_LEVEL
from signalyard.streaming.stateful import NO_LEVEL, NO_TIME, NearLogs


def _marked(df: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    return df.withWatermark(ts, delay)


def dedupe_stream(df: DataFrame, delay: str = "1 hour", columns: Sequence[str] | None = None) -> DataFrame:
    """Drop redelivered rows that arrive within ``delay`` of each other; older state is let go.

    Rows are compared by digest, which keeps the state small and spreads it evenly.
    """
    digest = row_digest(list(columns or df.columns))
    return _marked(df.withColumn("_digest", digest), delay).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def tumbling(
    df: DataFrame, size: str = "10 seconds", *agg: Column, by: Sequence[str] = (), delay: str = "10 minutes"
) -> DataFrame:
    """Aggregates per fixed window (and ``by``); the count when no aggregate is given."""
    return sliding(df, size, None, *agg, by=by, delay=delay)


def sliding(
    df: DataFrame,
    size: str,
    slide: str | None,
    *agg: Column,
    by: Sequence[str] = (),
    delay: str = "10 minutes",
) -> DataFrame:
    """Aggregates per overlapping window of ``size`` every ``slide``."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    measures = agg or (F.count("*").alias("n"),)
    grouped = _marked(df, delay).groupBy(window.alias("_w"), *by).agg(*measures)
    values = [c for c in grouped.columns if c not in ("_w", *by)]
    return grouped.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by, *values
    )


def session_stream(
    df: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes", user: str = "user_id"
) -> DataFrame:
    """Sessions by silence, the stream form of ``gap_sessions``: a silence of exactly ``gap`` ends a session."""
    # A session window reaches to the end of its gap and joins what begins there; one microsecond less does not.
    silence = f"{width_us(gap) - 1} microseconds"
    grouped = (
        _marked(df, delay)
        .groupBy(*with_tenant(df, user), F.session_window("ts", silence).alias("_w"))
        .agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("n_events"))
    )
    return grouped.drop("_w")


def profile_stream(identifies: DataFrame, user: str = "user_id", payload: str = "payload") -> DataFrame:
    """Latest value per user and trait, kept up to date; last write by event time wins.

    A plain streaming aggregation, so it is combined on the map side and runs in the JVM. Write it in
    ``update`` mode; ``profiles.latest_traits`` is the batch form.
    """
    keys, order = with_tenant(identifies, user), row_order(identifies)
    pairs = identifies.select(*keys, *order, F.explode(merged_map(props_of(payload))).alias("trait", "_v"))
    rows = pairs.filter(~F.col("trait").isin("user_id")).select(
        *keys, "trait", F.struct(*order, F.to_json("_v").alias("_text")).alias("_set")
    )
    return (
        rows.groupBy(*keys, "trait")
        .agg(F.max("_set").alias("_set"))
        .select(*keys, "trait", F.col("_set._text").alias("value"), F.col(f"_set.{order[0]}").alias("set_at"))
    )


# Events travel to the state processor as JSON; the default formats would cut times to milliseconds.
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "mode": "FAILFAST"}


def join_streams(
    events: DataFrame,
    logs: DataFrame,
    before: str = "5 minutes",
    after: str = "5 minutes",
    slot: str = "1 minute",
    delay: str = "10 minutes",
    on: Sequence[str] = ("session_id",),
    buckets: int = 16,
) -> DataFrame:
    """Each event once, with the logs of its session from ``before`` to ``after`` its time: the stream form of ``logs_near_event``.

    Adds ``n_logs``, ``n_errors`` and ``worst_level``; both ends of the range belong to it. Time is cut into blocks as long as the range, in
    whole ``slot``, and sessions are spread over ``buckets`` by hash. An event is held in its own block, a log in the two or three whose
    events can reach it. When a block is complete, the logs of a bucket are sorted and each event finds its range by binary search,
    so a busy session costs no more than others. A task holds the logs of one bucket and block, and its events in parts: with more
    rows per range, give more buckets.

    An event comes out once both streams are past its block and ``after``, by ``delay``. Rows later than that are dropped by Spark; an event
    without logs, or without a session, has zeros and a null level, and so has one without a time, which comes out at once. Equal
    events come out as often as they came in. Columns of ``events`` must be expressible in JSON (no intervals, map keys are
    strings). The result has no watermark.
    """
    keys = with_tenant(events, *on)
    before_us, after_us, slot_us = width_us(before), width_us(after), width_us(slot)
    block_us = max(1, -(-(before_us + after_us) // slot_us)) * slot_us
    whole_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    none = F.lit(0).cast("bigint")

    def shaped(df: DataFrame, low: int, high: int, is_event: bool, **values: Column) -> DataFrame:
        us, width = F.unix_micros("ts"), F.lit(block_us)
        first, last = (F.call_function("div", us + edge - F.pmod(us + edge, width), width) for edge in (low, high))
        blocks = F.when(us.isNull(), F.array(F.lit(NO_TIME))).otherwise(F.sequence(first, last))
        session = F.to_json(F.struct(*[F.col(k).cast(events.schema[k].dataType).alias(k) for k in keys]), _EXACT)
        # Pandas knows the years 1678 to 2261; times beyond are kept in ``us`` and move the watermark to the edge of that.
        early, far = (F.lit(edge).cast("timestamp") for edge in ("1678-01-01", "2262-01-01"))
        seen = F.when(us.isNotNull(), F.least(F.greatest("ts", early), far))
        rows = df.select(
            seen.alias("_seen"), F.coalesce(us, F.lit(NO_TIME)).alias("us"), blocks.alias("_blocks"),
            F.when(whole_key, session).otherwise("").alias("session"), F.lit(is_event).alias("is_event"),
            *[values[n].alias(n) for n in ("row", "error", "level")],
        )
        bucket = F.pmod(F.xxhash64("session"), F.lit(buckets)).alias("bucket")
        return _marked(rows, delay, "_seen").select(bucket, F.explode("_blocks").alias("block"), "*").drop("_blocks")

    rest = [c for c in events.columns if c != "ts"]
    row = F.to_json(F.struct(*rest), _EXACT)
    error, level = F.coalesce(F.col("level") <= ERROR_LEVEL, F.lit(False)).cast("bigint"), F.col("level").cast("bigint")
    both = shaped(events, 0, 0, True, row=row, error=none, level=none).unionByName(
        shaped(
            logs.filter(whole_key & F.col("ts").isNotNull()), -after_us, before_us, False,
            row=F.lit(""), error=error, level=F.coalesce(level, F.lit(NO_LEVEL)),
        )
    )
    met = both.groupBy("bucket", "block").transformWithStateInPandas(
        NearLogs(before_us, after_us, block_us),
        outputStructType="us bigint, row string, n_logs bigint, n_errors bigint, worst bigint",
        outputMode="append",
        timeMode="EventTime",
    )
    worst = F.when(F.col("worst") != NO_LEVEL, F.col("worst")).cast(logs.schema["level"].dataType)
    found = met.withColumn("_e", F.from_json("row", T.StructType([events.schema[c] for c in rest]), _EXACT))
    at = F.when(F.col("us") != NO_TIME, F.timestamp_micros("us"))
    return found.select(
        *[at.alias("ts") if c == "ts" else F.col("_e")[c].alias(c) for c in events.columns],
        "n_logs", "n_errors", worst.alias("worst_level"),
    )


def enrich_stream(events: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Stream-static lookup: identity map, profiles, names. ``table`` has one row per key."""
    return events.join(table, list(on), "left")
