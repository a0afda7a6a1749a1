"""Streaming operators, run over all the data there is; each must equal its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.sources import read_signals, stream_signals, stream_to_sink, write_signals
from signalyard.streaming import (
    bounded_intake,
    counter_stream,
    dedupe_stream,
    enrich_asof_stream,
    enrich_stream,
    join_streams,
    late_split,
    profile_stream,
    route_stream,
    session_stream,
    sliding,
    super_props_stream,
    tumbling,
)
from workloads.aggregates import _STEPS_SQL
from workloads.behaviors import GAP_SESSIONS_SQL
from workloads.deliveries import _LANDED_SQL, event_signals, landed_summary
from workloads.joins import LOGS_NEAR_EVENT_SQL, SUPER_PROPS_SQL, changes_of
from workloads.registry import num, query, us


def drain(t, stream: DataFrame, mode: str = "append", until_idle: bool = False) -> DataFrame:
    """Run a stream until its input is used up and return what it wrote, with the ``flush`` it was in.

    In ``complete`` mode only the last result counts, in ``update`` mode the last one per key. ``until_idle``: for sources
    that plan one trigger at a time.
    """
    path = t.scratch()
    empty = t.spark.createDataFrame([], stream.schema).withColumn("flush", F.lit(0))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/flush={batch_id}")

    # A stream keeps the number of state partitions it starts with: one per core of the cluster.
    partitions = t.spark.conf.get("spark.sql.shuffle.partitions")
    t.spark.conf.set("spark.sql.shuffle.partitions", str(t.spark.sparkContext.defaultParallelism))
    try:
        run = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{path}/checkpoint")
        if until_idle:
            started = run.start()
            try:
                started.processAllAvailable()
            finally:
                started.stop()
        else:
            run.trigger(availableNow=True).start().awaitTermination()
    finally:
        t.spark.conf.set("spark.sql.shuffle.partitions", partitions)
    out = t.spark.read.schema(empty.schema).parquet(f"{path}/out")
    if mode == "complete":
        newest = out.agg(F.max("flush").alias("newest"))  # one row
        return out.join(F.broadcast(newest), out["flush"] == newest["newest"], "left_semi")
    return out


# Rows of the events that a replay puts into one file: one task writes it.
_FILE_ROWS = 500_000


def replay(t, *parts: DataFrame) -> DataFrame:
    """The given tables as a stream, one after the other: each is one micro-batch, of as many files as there are events for.

    The source takes that many files at a time, so a part with fewer that others follow is filled up with empty ones.
    """
    path = t.scratch()
    n = max(1, -(-t.base("events").count() // _FILE_ROWS))
    none = t.spark.createDataFrame([], parts[0].schema).coalesce(1)
    for place, part in enumerate(parts, 1):
        laid_out = part.coalesce(1) if n == 1 else part.repartition(n)
        laid_out.write.mode("append").parquet(path)
        if place < len(parts):
            there = len(t.spark.read.schema(part.schema).parquet(path).inputFiles())
            for _ in range(place * n - there):
                none.write.mode("append").parquet(path)
    return t.spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", n).parquet(path)


@query("stream_signals", _LANDED_SQL, "fx_track")
def _(t):
    landed, out = t.scratch(), t.scratch()
    write_signals(event_signals(t), landed)
    stream = stream_signals(t.spark, landed, "event", max_files=100)
    stream_to_sink(stream, f"{out}/table", f"{out}/checkpoint", flush_interval=None).awaitTermination()
    return landed_summary(read_signals(t.spark, f"{out}/table", "event"))


@query(
    "bounded_intake",
    "SELECT event_name, COUNT(*) AS n FROM fx_track GROUP BY 1",
    "fx_track",
)
def _(t):
    landed = t.scratch()
    event_signals(t).repartition(3).write.parquet(landed)
    rows = drain(t, bounded_intake(t.spark, landed, "event", max_files=1))
    return rows.groupBy("event_name").agg(F.count("*").alias("n"))


@query("bounded_rows", _LANDED_SQL, "fx_track")
def _(t):
    landed, index = t.scratch(), t.scratch()
    write_signals(event_signals(t), landed)
    # Five triggers or so, which end within files.
    most = t.view("fx_track").count() // 5 + 1
    rows = drain(t, bounded_intake(t.spark, landed, "event", max_rows=most, index=index), until_idle=True)
    return landed_summary(rows)


@query("dedupe_stream", "SELECT seq, user_id, event_name FROM fx_track", "fx_track")
def _(t):
    rows = t.view("fx_track").select("seq", "ts", "user_id", "event_name")
    once = dedupe_stream(replay(t, rows, rows.filter("value > 10")), delay="60 days")
    return drain(t, once).select("seq", "user_id", "event_name")


@query(
    "tumbling",
    """SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_us, event_name, COUNT(*) AS n, round(sum(value), 2) AS total
       FROM fx_track GROUP BY 1, 2""",
    "fx_track",
)
def _(t):
    counts = tumbling(
        t.stream_view("fx_track"), "1 hour", F.count("*").alias("n"), F.sum("value").alias("total"), by=["event_name"]
    )
    rows = drain(t, counts, "complete")
    return rows.select(us("window_start").alias("window_us"), "event_name", "n", num("total", 2).alias("total"))


@query(
    "sliding",
    """, w AS (SELECT level, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) - 3600000000 * o.i AS window_us
         FROM fx_log, (SELECT unnest([0, 1]) AS i) o)
       SELECT window_us, COUNT(*) AS n, round(COUNT(*) FILTER (level <= 3) / COUNT(*), 6) AS error_rate FROM w GROUP BY 1""",
    "fx_log",
)
def _(t):
    rate = (F.count_if(F.col("level") <= 3) / F.count("*")).alias("error_rate")
    rows = drain(t, sliding(t.stream_view("fx_log"), "2 hours", "1 hour", F.count("*").alias("n"), rate), "complete")
    return rows.select(us("window_start").alias("window_us"), "n", num("error_rate").alias("error_rate"))


@query("session_stream", GAP_SESSIONS_SQL, "fx_track")
def _(t):
    rows = drain(t, session_stream(t.stream_view("fx_track"), "6 hours"), "complete")
    return rows.select("user_id", us("session_start").alias("start_us"), us("session_end").alias("end_us"), "n_events")


@query(
    "late_split",
    """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' AND ts < (SELECT max(ts) FROM fx_track) - INTERVAL 10 DAY THEN 'late'
       ELSE 'on_time' END AS part, COUNT(*) AS n FROM fx_track GROUP BY 1""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").select("seq", "ts")
    stream = replay(t, rows.filter("ts >= '2024-01-16'"), rows.filter("ts < '2024-01-16'"))
    path = t.scratch()
    late_split(stream, path, f"{path}/checkpoint", "10 days").awaitTermination()
    parts = [t.spark.read.parquet(f"{path}/{p}").withColumn("part", F.lit(p)) for p in ("on_time", "late")]
    return parts[0].unionByName(parts[1]).groupBy("part").agg(F.count("*").alias("n"))


@query("counter_stream", _STEPS_SQL + " SELECT source, epoch_us(ts) AS us, value, step FROM steps", "fx_counter")
def _(t):
    samples = t.view("fx_counter").withColumn("series_key", F.col("source"))
    rows = drain(t, counter_stream(replay(t, samples), ttl="40 days"))
    return rows.select(F.col("series_key").alias("source"), us("ts").alias("us"), "value", "step")


@query(
    "profile_stream",
    """SELECT user_id, 'plan' AS trait, '"' || arg_max(plan, ts) || '"' AS value FROM fx_identify GROUP BY 1
       UNION ALL SELECT user_id, 'k', CAST(arg_max(k, ts) AS VARCHAR) FROM fx_identify GROUP BY 1""",
    "fx_identify",
)
def _(t):
    built = op.identify_payload(t.stream_view("fx_identify").withColumn("traits", F.struct("plan", "k")))
    rows = drain(t, profile_stream(built), "complete")
    return rows.select("user_id", "trait", "value")


@query("super_props_stream", SUPER_PROPS_SQL, "fx_track")
def _(t):
    events = t.stream_view("fx_track").filter("event_name = 'Feature Used'").select(
        "seq", "ts", F.col("device_id").alias("client_id"), F.to_json(F.struct("user_id")).alias("row")
    )
    rows = drain(t, super_props_stream(changes_of(t.stream_view("fx_track")), events))
    merged = op.extract_props(rows.withColumn("payload", op.merge_properties("super_props", "row")), "p0 int, p1 int, p2 int, user_id string")
    return merged.select("seq", "p0", "p1", "p2", "user_id")


@query("join_streams", LOGS_NEAR_EVENT_SQL, "fx_track fx_log")
def _(t):
    events = t.view("fx_track").select("seq", "ts", "session_id")
    logs = t.view("fx_log").select("ts", "session_id", "level")
    # A row far ahead moves the watermark past the data, so that every event is done.
    ahead = F.expr("TIMESTAMP '2030-01-01'").alias("ts")
    last_event = t.spark.range(1).select(F.lit(-1).cast("bigint").alias("seq"), ahead, F.lit("end").alias("session_id"))
    last_log = t.spark.range(1).select(ahead, F.lit("other").alias("session_id"), F.lit(8).alias("level"))
    joined = join_streams(
        replay(t, events, last_event), replay(t, logs, last_log), "4 hours", "30 minutes", "20 minutes", "1 hour"
    )
    return drain(t, joined).filter("seq >= 0").select("seq", "n_logs", "n_errors", "worst_level")


@query(
    "enrich_stream",
    """SELECT t.seq, i.plan FROM fx_track t LEFT JOIN (SELECT user_id, arg_max(plan, ts) AS plan FROM fx_identify GROUP BY 1) i
       USING (user_id)""",
    "fx_track fx_identify",
)
def _(t):
    plans = t.view("fx_identify").groupBy("user_id").agg(F.max_by("plan", "ts").alias("plan"))
    return drain(t, enrich_stream(t.stream_view("fx_track"), plans, ["user_id"])).select("seq", "plan")


@query(
    "enrich_asof_stream",
    """SELECT e.seq, i.plan AS profile_plan, CAST(i.k AS INT) AS profile_k FROM fx_track e
       ASOF LEFT JOIN fx_identify i ON e.user_id = i.user_id AND e.ts >= i.ts""",
    "fx_track fx_identify",
)
def _(t):
    events = t.view("fx_track").select("seq", "ts", "user_id")
    changes = t.view("fx_identify").select("seq", "ts", "user_id", "plan", "k")
    # Three micro-batches by time, every fifth change a day late; a last row far ahead lets all events go.
    edges = ("2024-01-01", "2024-01-11", "2024-01-21", "2025-01-01")
    arrives = F.when(F.col("seq") % 5 == 0, F.expr("ts + INTERVAL 1 DAY")).otherwise(F.col("ts"))
    spans = [(F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp")) for a, b in zip(edges, edges[1:], strict=False)]
    end = t.spark.range(1).select(F.lit(-1).cast("bigint").alias("seq"), F.expr("TIMESTAMP '2030-01-01'").alias("ts"), F.lit("end").alias("user_id"))
    table = op.ValidityTable(t.spark, t.scratch(), {"user_id": "string"}, {"plan": "string", "k": "int"}, buckets=8)
    path = t.scratch()
    run = enrich_asof_stream(
        replay(t, *[events.filter((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in spans], end),
        replay(t, *[changes.filter((arrives >= a) & (arrives < b)) for a, b in spans]),
        table, path, f"{path}/checkpoint", "2 days",
    )
    run.awaitTermination()
    out = t.spark.read.parquet(f"{path}/out").filter("seq >= 0")
    return out.select("seq", F.col("plan").alias("profile_plan"), F.col("k").alias("profile_k"))


@query(
    "route_stream",
    """SELECT 'event' AS sink, COUNT(*) AS n FROM fx_bad WHERE user_id <> '' AND event_name <> '' AND strlen(event_name) <= 256
       UNION ALL SELECT 'log', COUNT(*) FROM fx_log WHERE message <> ''
       UNION ALL SELECT 'metric', COUNT(*) FROM fx_gauge
       UNION ALL SELECT 'quarantine ' || field, COUNT(*) FROM (
         SELECT CASE WHEN user_id = '' THEN 'userId' ELSE 'eventName' END AS field FROM fx_bad
           WHERE user_id = '' OR event_name = '' OR strlen(event_name) > 256
         UNION ALL SELECT 'message' FROM fx_log WHERE message = '') GROUP BY field""",
    "fx_bad fx_log fx_gauge",
)
def _(t):
    none = F.lit(None).cast("string")
    fields = ("ts", "seq", "event_type", "event_name", "session_id", "level", "name", "value", "payload")

    def shaped(rows: DataFrame) -> DataFrame:
        kinds = {"level": "int", "value": "double", "ts": "timestamp"}
        return rows.select(
            *[F.col(f) if f in rows.columns else none.cast(kinds.get(f, "string")).alias(f) for f in fields]
        )

    bad = t.view("fx_bad").join(t.view("fx_track").select("seq", "ts"), "seq")
    events = shaped(op.track_payload(bad.withColumn("event_type", F.lit("track"))))
    logs = shaped(op.log_payload(t.view("fx_log")))
    metrics = shaped(t.view("fx_gauge"))
    packed = [op.pack_batches(df, kind, 100, "1 day") for kind, df in (("event", events), ("log", logs), ("metric", metrics))]
    path = t.scratch()
    stream = replay(t, packed[0].unionByName(packed[1]).unionByName(packed[2]))
    route_stream(stream, path, f"{path}/checkpoint").awaitTermination()
    out = t.spark.read.parquet(f"{path}/quarantine").groupBy(F.concat(F.lit("quarantine "), "field").alias("sink")).agg(F.count("*").alias("n"))
    for kind in ("event", "log", "metric"):
        landed = t.spark.read.parquet(f"{path}/{kind}")
        out = out.unionByName(landed.agg(F.count("*").alias("n")).select(F.lit(kind).alias("sink"), "n"))
    return out
