"""Landing, packing, redelivery, gaps, retention of signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.sources import quarantine, read_signals, write_clustered, write_signals
from workloads.registry import big, query

_LANDED_SQL = "SELECT event_name, service, COUNT(*) AS n, CAST(sum(k) AS BIGINT) AS total_k FROM fx_track GROUP BY 1, 2"


def event_signals(t):
    """The whole events table as event signals, two tenants."""
    rows = op.track_payload(t.view("fx_track"))
    return rows.select(
        F.unhex(F.md5(F.when(F.col("k") < 50, "tenant-a").otherwise("tenant-b"))).alias("tenant"),
        F.lit("track").alias("event_type"),
        "ts",
        "service",
        "device_id",
        "session_id",
        "event_name",
        "payload",
    )


def landed_summary(rows):
    """What the landed rows hold, by event and service."""
    typed = op.extract_props(rows.select("event_name", "service", "payload"), "k bigint")
    return typed.groupBy("event_name", "service").agg(F.count("*").alias("n"), F.sum("k").alias("total_k"))


@query("read_signals", _LANDED_SQL, "fx_track")
def _(t):
    path = t.scratch()
    write_signals(event_signals(t), path, type_column="event_type")
    return landed_summary(read_signals(t.spark, path, "event"))


@query("read_signals_json", _LANDED_SQL, "fx_track")
def _(t):
    path = t.scratch()
    write_signals(event_signals(t), path, fmt="json")
    return landed_summary(read_signals(t.spark, path, "event", "json"))


@query(
    "logs_near_landed_event",
    """, e AS (SELECT *, k < 50 AS a FROM fx_track), l AS (SELECT fx_log.*, k < 50 AS a FROM fx_log JOIN fx_track USING (seq)),
       n AS (SELECT e.seq, e.event_name, COUNT(l.seq) AS n_logs, COUNT(l.seq) FILTER (l.level <= 3) AS n_errors
         FROM e LEFT JOIN l ON e.a = l.a AND e.session_id = l.session_id
           AND l.ts >= e.ts - INTERVAL 4 HOUR AND l.ts <= e.ts + INTERVAL 30 MINUTE GROUP BY 1, 2)
       SELECT event_name, COUNT(*) AS n, CAST(sum(n_logs) AS BIGINT) AS n_logs, CAST(sum(n_errors) AS BIGINT) AS n_errors
       FROM n GROUP BY 1""",
    "fx_track fx_log",
)
def _(t):
    events, logs = t.scratch(), t.scratch()
    write_signals(event_signals(t), events)
    tenants = t.view("fx_track").select("seq", F.unhex(F.md5(F.when(F.col("k") < 50, "tenant-a").otherwise("tenant-b"))).alias("tenant"))
    kept = op.log_payload(t.view("fx_log")).join(tenants, "seq")
    write_signals(kept.select("tenant", "session_id", F.col("level").cast("tinyint").alias("level"), "ts", "payload"), logs)
    landed = op.with_row_id(read_signals(t.spark, events, "event"))
    near = op.logs_near_event(landed, read_signals(t.spark, logs, "log"), "4 hours", "30 minutes")
    return near.groupBy("event_name").agg(
        F.count("*").alias("n"), F.sum("n_logs").alias("n_logs"), F.sum("n_errors").alias("n_errors")
    )


@query(
    "write_signals",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_name, COUNT(*) AS n FROM fx_track GROUP BY 1, 2""",
    "fx_track",
)
def _(t):
    path = t.scratch()
    write_signals(event_signals(t), path, type_column="event_name", rows_per_file=1000)
    landed = t.spark.read.parquet(path)
    day = F.col("day").cast("string").alias("day")
    return landed.groupBy(day, "event_name").agg(F.count("*").alias("n"))


@query(
    "write_clustered",
    """SELECT 'all' AS selection, COUNT(*) AS n, CAST(sum(k) AS BIGINT) AS total_k FROM fx_track
       UNION ALL SELECT 'time', COUNT(*), CAST(sum(k) AS BIGINT) FROM fx_track
         WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'
       UNION ALL SELECT 'name', COUNT(*), CAST(sum(k) AS BIGINT) FROM fx_track WHERE event_name = 'Order Completed'
       UNION ALL SELECT 'user', COUNT(*), CAST(sum(k) AS BIGINT) FROM fx_track WHERE user_id = 'u7'
       UNION ALL SELECT 'service', COUNT(*), CAST(sum(k) AS BIGINT) FROM fx_track WHERE service = 'svc2'""",
    "fx_track",
)
def _(t):
    path = t.scratch()
    write_clustered(t.view("fx_track"), path, ["service", "ts", "event_name", "user_id"], rows_per_file=2000)
    landed = t.spark.read.parquet(path)
    parts = {
        "all": landed,
        "time": op.where_signal(landed, start="2024-01-10", end="2024-01-12"),
        "name": op.where_signal(landed, names=["Order Completed"]),
        "user": landed.filter("user_id = 'u7'"),
        "service": op.where_signal(landed, service="svc2"),
    }
    out = None
    for name, part in parts.items():
        row = part.agg(F.count("*").alias("n"), big(F.sum("k")).alias("total_k")).withColumn("selection", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "quarantine",
    """SELECT 'userId' AS field, COUNT(*) AS n FROM fx_bad WHERE user_id = ''
       UNION ALL SELECT 'eventName', COUNT(*) FROM fx_bad WHERE user_id <> '' AND (event_name = '' OR strlen(event_name) > 256)
       UNION ALL SELECT 'kept', COUNT(*) FROM fx_bad WHERE user_id <> '' AND event_name <> '' AND strlen(event_name) <= 256""",
    "fx_bad",
)
def _(t):
    path = t.scratch()
    kept = quarantine(op.validate_track(t.view("fx_bad")), path)
    bad = t.spark.read.parquet(path).groupBy(F.col("error.field").alias("field")).agg(F.count("*").alias("n"))
    return bad.unionByName(kept.agg(F.count("*").alias("n")).withColumn("field", F.lit("kept")))


def _packed(t, size=100, interval="1 day"):
    rows = t.view("fx_track").select(F.col("service").alias("tenant"), "ts", "seq", "event_name")
    return op.pack_batches(rows, "event", size, interval)


_PACK_SQL = """, p AS (SELECT service, seq, date_trunc('day', ts) AS f,
      (row_number() OVER (PARTITION BY service, date_trunc('day', ts) ORDER BY ts, seq) - 1) // 50 AS part,
      (row_number() OVER (PARTITION BY service, date_trunc('day', ts) ORDER BY ts, seq) - 1) % 50 AS position FROM fx_track),
    b AS (SELECT *, dense_rank() OVER (PARTITION BY service ORDER BY f, part) AS batch_id FROM p)"""


@query(
    "pack_batches",
    _PACK_SQL
    + """ SELECT service AS tenant, 'event' AS schema_type, batch_id, COUNT(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq
      FROM b GROUP BY 1, 3""",
    "fx_track",
)
def _(t):
    rows = _packed(t, 50)
    seqs = F.transform("data", lambda d: d["seq"])
    return rows.select(
        "tenant", "schema_type", big("batch_id").alias("batch_id"), big(F.size("data")).alias("n"),
        F.array_min(seqs).alias("first_seq"), F.array_max(seqs).alias("last_seq"),
    )


@query("unpack_batches", _PACK_SQL + " SELECT service AS tenant, batch_id, position, seq FROM b", "fx_track")
def _(t):
    rows = op.unpack_batches(_packed(t, 50))
    return rows.select("tenant", big("batch_id").alias("batch_id"), big("position").alias("position"), "seq")


@query(
    "route_by_schema",
    """SELECT CASE WHEN k % 4 = 3 THEN 'quarantine' ELSE ['event', 'log', 'metric'][k % 4 + 1] END AS route, COUNT(*) AS n
       FROM fx_track GROUP BY 1""",
    "fx_track",
)
def _(t):
    kinds = F.array(*[F.lit(x) for x in ("event", "log", "metric", "other")])
    rows = t.view("fx_track").select("seq", F.element_at(kinds, F.col("k") % 4 + 1).alias("schema_type"))
    tables = op.route_by_schema(rows)
    out = None
    for name, part in tables.items():
        counted = part.agg(F.count("*").alias("n")).select(F.lit(name).alias("route"), "n")
        out = counted if out is None else out.unionByName(counted)
    return out


@query("dedupe_exact", "SELECT seq, user_id, value FROM fx_track", "fx_track")
def _(t):
    rows = t.view("fx_track").select("seq", "user_id", "value")
    again = rows.unionByName(rows.filter("value > 10")).unionByName(rows.filter("user_id = 'u7'"))
    return op.dedupe_exact(again)


@query(
    "dedupe_texts",
    "SELECT md5(text) AS digest, length(text) AS n FROM documents GROUP BY text",
)
def _(t):
    rows = op.dedupe_exact(t.base("documents").select("text"), wide=True)
    return rows.select(F.md5("text").alias("digest"), big(F.length("text")).alias("n"))


@query(
    "dedupe_batches",
    _PACK_SQL + " SELECT service AS tenant, batch_id, COUNT(*) AS n FROM b GROUP BY 1, 2",
    "fx_track",
)
def _(t):
    packed = _packed(t, 50)
    rows = op.dedupe_batches(packed.unionByName(packed.filter("tenant <> 'svc1'")))
    return rows.select("tenant", big("batch_id").alias("batch_id"), big(F.size("data")).alias("n"))


@query(
    "batch_gaps",
    """, d AS (SELECT DISTINCT ts, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN batch_id - 700 ELSE batch_id END AS id FROM fx_batch),
       p AS (SELECT *, lag(id) OVER (ORDER BY ts, id) AS prev FROM d),
       r AS (SELECT id, CAST(sum(CASE WHEN id < prev THEN 1 ELSE 0 END) OVER (ORDER BY ts, id) AS BIGINT) AS run FROM p),
       n AS (SELECT run, id, lead(id) OVER (PARTITION BY run ORDER BY id) AS nx FROM (SELECT DISTINCT run, id FROM r))
       SELECT run, id + 1 AS missing_from, nx - 1 AS missing_to, nx - id - 1 AS n_missing FROM n WHERE nx - id > 1""",
    "fx_batch",
)
def _(t):
    rows = t.view("fx_batch").withColumn(
        "batch_id", F.expr("CASE WHEN ts >= '2024-01-16' THEN batch_id - 700 ELSE batch_id END")
    )
    gaps = op.batch_gaps(rows)
    return gaps.select(big("run").alias("run"), "missing_from", "missing_to", "n_missing")


@query(
    "retain_newest_bytes",
    """SELECT doc_id FROM (SELECT doc_id, sum(strlen(text) + 4) OVER w AS newer, row_number() OVER w AS rn FROM documents
       WINDOW w AS (PARTITION BY source ORDER BY doc_id DESC)) WHERE newer <= 100000 OR rn = 1""",
)
def _(t):
    rows = op.retain_newest_bytes(t.base("documents"), 100_000, F.octet_length("text"), by=["source"], order=("doc_id",))
    return rows.select("doc_id")


