"""Streams over several micro-batches, and the sinks."""

from __future__ import annotations

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalyard import operators as op
from signalyard.schemas import batch_schema, signal_schema
from signalyard.sources import quarantine, read_signals, stream_signals, stream_to_sink, write_signals
from signalyard.sources.files import MALFORMED
from signalyard.streaming import (
    route_stream,
    session_stream,
    IntakeListener,
    bounded_intake,
    counter_stream,
    dedupe_stream,
    late_split,
    profile_stream,
    super_props_stream,
)

T0 = dt.datetime(2024, 1, 1)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def test_counter_state_across_batches(table, feed, drain, rows_of):
    ddl = "name string, source string, ts timestamp, value double"
    parts = [
        table(ddl, ("c", "s", at(0), 5.0), ("c", "s", at(10), 8.0), ("c", "x", at(0), 1.0)),
        table(ddl, ("c", "s", at(20), 2.0), ("c", "s", at(5), 6.0), ("c", "x", at(9), 4.0)),
        table(ddl, ("c", "s", at(30), 9.0)),
    ]
    rows = drain(counter_stream(feed(*parts)))
    got = sorted((r["ts"], r["value"], r["step"], r["late"]) for r in rows.collect() if '"s"' in r["series_key"])
    assert got == [
        (at(0), 5.0, 0.0, False), (at(5), 6.0, 0.0, True), (at(10), 8.0, 3.0, False), (at(20), 2.0, 2.0, False), (at(30), 9.0, 7.0, False),
    ]


def test_super_properties_across_batches(table, feed, drain):
    changes = "client_id string, ts timestamp, seq bigint, op string, key string, value string"
    events = "client_id string, ts timestamp, seq bigint, row string"
    c = feed(
        table(changes, ("c", at(0), 1, "register", "app_version", '"2.1"'), ("c", at(0), 2, "register", "env", '"prod"')),
        table(changes, ("c", at(2), 4, "register", "extra", "7")),
        table(changes, ("c", at(4), 6, "unregister", "env", None)),
    )
    e = feed(table(events, ("c", at(1), 3, "{}")), table(events, ("c", at(3), 5, "{}")), table(events, ("c", at(4), 7, "{}")))
    rows = drain(super_props_stream(c, e)).orderBy("seq").collect()
    assert [json.loads(r["super_props"]) for r in rows] == [
        {"app_version": "2.1", "env": "prod"}, {"app_version": "2.1", "env": "prod", "extra": 7}, {"app_version": "2.1", "extra": 7},
    ]


def test_profile_updates_go_by_event_time(table, feed, drain):
    ddl = "user_id string, ts timestamp, payload string"
    parts = [
        table(ddl, ("u", at(5), '{"user_id":"u","plan":"pro"}')),
        table(ddl, ("u", at(1), '{"user_id":"u","plan":"free","city":"Oslo"}')),
    ]
    rows = drain(profile_stream(feed(*parts)), "update")
    newest = rows.groupBy("trait").agg(F.max_by("value", "flush").alias("value"))
    assert {r["trait"]: r["value"] for r in newest.collect()} == {"plan": '"pro"', "city": '"Oslo"'}


def test_dedupe_across_batches(table, feed, drain):
    part = table("ts timestamp, n int", (at(0), 1), (at(1), 2), (at(1), 2))
    again = table("ts timestamp, n int", (at(1), 2), (at(2), 3))
    assert drain(dedupe_stream(feed(part, again), "1 hour")).count() == 3


def test_late_rows_go_aside_and_a_restart_goes_on(spark, table, tmp_path, feed):
    ddl = "ts timestamp, n int"
    stream = feed(table(ddl, (at(0), 1), (at(600), 2)), table(ddl, (at(10), 3), (at(550), 4)))
    path = str(tmp_path / "late")
    for _ in range(2):  # the second run finds nothing new
        assert late_split(stream, path, f"{path}/checkpoint", "2 minutes").awaitTermination(120)
    late = [r["n"] for r in spark.read.parquet(f"{path}/late").collect()]
    on_time = sorted(r["n"] for r in spark.read.parquet(f"{path}/on_time").collect())
    assert (late, on_time) == ([3], [1, 2, 4])


def _signals(spark, n=40):
    return spark.range(n).select(
        F.unhex(F.md5((F.col("id") % 2).cast("string"))).alias("tenant"),
        F.lit("track").alias("event_type"),
        F.timestamp_seconds(F.col("id") * 7200).alias("ts"),
        F.lit("svc").alias("service"),
        F.lit("d").alias("device_id"),
        F.lit(None).cast("string").alias("session_id"),
        F.lit("E").alias("event_name"),
        F.concat(F.lit('{"user_id":"u'), "id", F.lit('"}')).alias("payload"),
    )


def test_write_and_read_signals(spark, tmp_path, rows_of):
    rows = _signals(spark)
    path = str(tmp_path / "signals")
    write_signals(rows, path, rows_per_file=5)
    assert rows_of(read_signals(spark, path, "event"), *rows.columns) == rows_of(rows)
    folders = {p.name for p in (tmp_path / "signals").iterdir() if p.name.startswith("tenant_id=")}
    assert len(folders) == 2
    assert all(len(f) == len("tenant_id=") + 64 for f in folders)  # a digest, not the key
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "signals").rglob("*.parquet")]
    assert max(sizes) <= 5


def test_sink_is_restart_safe(spark, tmp_path, rows_of):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = _signals(spark)
    rows.write.parquet(landed)
    for _ in range(2):
        query = stream_to_sink(stream_signals(spark, landed, "event"), f"{out}/t", f"{out}/c", flush_interval=None)
        assert query.awaitTermination(120)
    assert rows_of(read_signals(spark, f"{out}/t", "event"), *rows.columns) == rows_of(rows)


def test_malformed_lines_are_kept_as_data(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '{"name":"h","metric_type":"histogram","value":0,"histogram":{"count":1,"buckets":[{"upper_bound":"Infinity","count":1}]}}\n'
        "{broken\n"
    )
    rows = read_signals(spark, str(tmp_path), "metric", "json").cache()
    assert rows.filter(F.col(MALFORMED).isNotNull()).count() == 1
    assert rows.filter("name = 'h'").first()["histogram"]["buckets"][0]["upper_bound"] == float("inf")
    with pytest.raises(ValueError, match="format"):
        read_signals(spark, str(tmp_path), "metric", "csv")


def test_quarantine(spark, table, tmp_path):
    df = op.validate_identify(table("user_id string", ("u",), ("",), (None,)))
    told = []
    kept = quarantine(df, str(tmp_path / "bad"), on_error=told.append)
    assert [r["user_id"] for r in kept.collect()] == ["u"]
    assert told == [{"rejected": 2}]
    assert {r["error"]["field"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == {"userId"}


def test_intake_is_bounded(spark, tmp_path, drain):
    landed = str(tmp_path / "in")
    _signals(spark).repartition(4).write.parquet(landed)
    listener = IntakeListener()
    spark.streams.addListener(listener)
    try:
        rows = drain(bounded_intake(spark, landed, "event", max_files=1))
        assert rows.count() == 40
        assert rows.select("flush").distinct().count() == 4
        deadline = time.time() + 20
        while sum(listener.rows) < 40 and time.time() < deadline:
            time.sleep(0.2)
        assert sum(listener.rows) == 40 and max(listener.rows) < 40
    finally:
        spark.streams.removeListener(listener)
    with pytest.raises(ValueError, match="max_files"):
        bounded_intake(spark, landed, "event", 0)


def test_stateless_operators_run_on_streams(spark, table, feed, drain, rows_of):
    df = table("user_id string, event_name string, props string", ("u", "E", '{"a":1}'), ("", "E", "{}"))
    chain = lambda rows: op.validate_track(op.track_payload(rows)).select("payload", "error.field")
    assert rows_of(drain(chain(feed(df))), "payload", "field") == rows_of(chain(df))


def test_shared_folder(spark):
    from signalyard.session import shared_dir

    assert shared_dir(spark) == shared_dir(spark)


def test_no_side_table_holds_the_tenant_key(feed, spark, tmp_path):
    import base64

    fields = {f.name: f for kind in ("event", "log", "metric") for f in signal_schema(kind).fields}
    schema = batch_schema("event")
    schema["data"].dataType = T.ArrayType(T.StructType(list(fields.values())))
    key = bytes(range(16))
    item = {n: None for n in fields} | {"tenant": key, "service": "svc", "ts": T0}
    row = {f.name: None for f in schema.fields} | {"tenant": key, "schema_type": "hologram", "batch_id": 7}
    batches = spark.createDataFrame([row | {"data": [item]}], schema)
    query = route_stream(feed(batches), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(60)
    side = spark.read.parquet(str(tmp_path / "out/quarantine")).collect()
    assert [(r["kind"], r["reason"]) for r in side] == [("hologram", "is unknown")]
    assert "svc" in side[0]["row"] and base64.b64encode(key).decode() not in side[0]["row"]


def test_a_silence_of_exactly_the_gap_ends_a_session(spark):
    rows = [("u", at(0)), ("u", at(1800)), ("u", at(3599.9))]
    df = spark.createDataFrame(rows, "user_id string, ts timestamp")
    got = sorted((r["session_start"], r["n_events"]) for r in session_stream(df, "30 minutes").collect())
    assert got == [(at(0), 1), (at(1800), 2)]


def test_intake_is_bounded_by_bytes(spark, tmp_path, drain):
    landed = str(tmp_path / "in")
    _signals(spark).repartition(4).write.parquet(landed)
    rows = drain(bounded_intake(spark, landed, "event", max_bytes=1))
    assert rows.count() == 40 and rows.select("flush").distinct().count() == 4
    with pytest.raises(ValueError, match="max_bytes"):
        bounded_intake(spark, landed, "event", max_bytes=0)
    with pytest.raises(ValueError, match="max_files or max_bytes"):
        bounded_intake(spark, landed, "event")


def test_properties_of_a_silent_client_expire(table, feed, drain):
    ddl = "client_id string, ts timestamp, seq long, op string, key string, value string"
    day = 86_400
    none = (None, None, None)
    both = [
        [("c", at(0), 1, "register", "a", "1"), ("c", at(1), 2, *none)],
        [("d", at(40 * day), 3, *none)],
        [("d", at(41 * day), 4, *none)],
        [("c", at(42 * day), 5, *none), ("d", at(42 * day), 6, *none)],
    ]
    rows = feed(*[table(ddl, *part) for part in both])
    events = rows.filter("op IS NULL").select("client_id", "ts", "seq", F.lit("{}").alias("row"))
    got = drain(super_props_stream(rows.filter("op IS NOT NULL"), events, ttl="10 days"))
    assert sorted((r["seq"], r["super_props"]) for r in got.collect()) == [
        (2, '{"a":1}'), (3, "{}"), (4, "{}"), (5, "{}"), (6, "{}"),
    ]
