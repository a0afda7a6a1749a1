"""Stream state against plain Python: keys with more rows than a batch, initial state, exact joins at the edges."""

from __future__ import annotations

import datetime as dt
import json
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from signalyard.streaming import counter_stream, join_streams, super_props_stream

T0 = dt.datetime(2024, 1, 1)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture
def small_batches(spark):
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_counter_samples_of_one_time_go_by_seq(spark, feed, drain):
    """Six samples of one series and time that arrive last first, in runs that are merged."""
    df = spark.createDataFrame([("c", "s", dt.datetime(2024, 1, 1), k, 10.0 * k) for k in range(6, 0, -1)], "name string, series_key string, ts timestamp, seq long, value double")
    got = {r["value"]: r["step"] for r in drain(counter_stream(feed(df), block_rows=2)).collect()}
    assert got == {10.0: 0.0, **{10.0 * k: 10.0 for k in range(2, 7)}}


def test_counter_of_many_batches_is_in_time_order(spark, feed, drain, small_batches):
    draw = random.Random(1)
    rows = [("c", s, k, float(draw.choice([k % 97, k % 13, 5]))) for s in "xy" for k in range(500)]
    draw.shuffle(rows)
    df = spark.createDataFrame([(n, s, at(k), v) for n, s, k, v in rows], "name string, source string, ts timestamp, value double")
    later = [(k, v) for k, v in ((498, 3.0), (501, 8.0), (500, 2.0))]
    more = spark.createDataFrame([("c", "x", at(k), v) for k, v in later], df.schema)
    got = drain(counter_stream(feed(df, more), delay="10 days", block_rows=7)).collect()
    steps = {(r["series_key"], r["ts"], r["value"], r["late"]): r["step"] for r in got}
    assert len(got) == 1003
    for s in "xy":
        own = sorted((k, v) for _, x, k, v in rows if x == s)
        own += [(500, 2.0), (501, 8.0)] if s == "x" else []
        key = next(r["series_key"] for r in got if f'"{s}"' in r["series_key"])
        for (_, a), (k, b) in zip([(0, own[0][1]), *own], own, strict=False):
            assert steps[key, at(k), b, False] == (b if b < a else b - a)
    assert [r["step"] for r in got if r["late"]] == [0.0]


def test_counter_begins_with_what_is_known(spark, feed, drain):
    ddl = "name string, source string, ts timestamp, value double"
    known = spark.createDataFrame([("c", "x", at(0), 4.0), ("c", "x", at(9), 7.0), ("c", "z", at(1), 1.0)], ddl)
    df = spark.createDataFrame([("c", "x", at(20), 10.0), ("c", "y", at(20), 10.0), ("c", "x", at(5), 9.0)], ddl)
    got = drain(counter_stream(feed(df), initial=known)).collect()
    found = {(json.loads(r["series_key"])["source"] if r["series_key"].startswith("{") else r["series_key"], r["ts"]): (r["step"], r["late"]) for r in got}
    assert sorted(found.values()) == [(0.0, False), (0.0, True), (3.0, False)]


def test_super_properties_of_many_batches(spark, feed, drain, small_batches):
    draw = random.Random(4)
    rows, seq = [], 0
    for k in range(600):
        seq += 1
        op = draw.choice(["register", "register", "unregister", None, None])
        name = draw.choice(["a", 'b"', "é"]) if op else None
        rows.append(("c", k // 3, seq, op, name, str(draw.randint(0, 9)) if op == "register" and draw.random() < 0.9 else None))
    held, want = {"kept": "1", "a": '"old"'}, {}
    for _, _, seq, op, name, value in sorted(rows, key=lambda r: (r[1], r[3] is None, r[2])):
        if op == "register":
            held[name] = value or "null"
        elif op == "unregister":
            held.pop(name, None)
        else:
            want[seq] = json.loads("{" + ",".join(f"{json.dumps(n)}:{v}" for n, v in held.items()) + "}")
    draw.shuffle(rows)
    ddl = "client_id string, ts timestamp, seq long, op string, key string, value string"
    df = spark.createDataFrame([(c, at(k), *rest) for c, k, *rest in rows], ddl)
    stream = feed(df)
    events = stream.filter("op IS NULL").select("client_id", "ts", "seq", F.lit("{}").alias("row"))
    initial = spark.createDataFrame([("c", at(-5), "kept", "1"), ("c", at(-9), "a", '"old"')], "client_id string, ts timestamp, key string, value string")
    got = drain(super_props_stream(stream.filter("op IS NOT NULL"), events, initial=initial, block_rows=9)).collect()
    assert {r["seq"]: json.loads(r["super_props"]) for r in got} == want and len(got) == len(want)


def test_streams_meet_exactly(spark, feed, drain):
    """Events and logs in mixed batches, some late but in time, some at the very ends of the range, equal events, no session."""
    draw = random.Random(7)
    micro = 1e-6
    events = [(k, at(60 * k + draw.choice([0, 30, 59.999999])), f"s{k % 2}") for k in range(60)]
    events += [(100, at(600), None), (101, at(700), "s9"), (102, at(300), "s0"), (102, at(300), "s0")]
    logs = [(at(draw.randint(0, 3600 * 10**3) / 1000), f"s{draw.randint(0, 2)}", draw.randint(0, 8)) for _ in range(400)]
    for k, ts, s in events[:20]:
        logs += [(ts - dt.timedelta(seconds=90), s, 1), (ts - dt.timedelta(seconds=90 + micro), s, 0)]
        logs += [(ts + dt.timedelta(seconds=200), s, 7), (ts + dt.timedelta(seconds=200 + micro), s, 2)]
    logs += [(at(600), None, 0)]
    want = defaultdict(list)
    for k, ts, s in events:
        near = [v for when, x, v in logs if x is not None and x == s and ts - dt.timedelta(seconds=90) <= when <= ts + dt.timedelta(seconds=200)]
        want[k].append((len(near), sum(v <= 3 for v in near), min(near, default=None)))
    e_ddl, l_ddl = "seq long, ts timestamp, session_id string", "ts timestamp, session_id string, level int"
    draw.shuffle(events)
    draw.shuffle(logs)
    end = at(10**7)
    e = feed(*[spark.createDataFrame(events[k::3], e_ddl) for k in range(3)], spark.createDataFrame([(-1, end, "end")], e_ddl))
    lo = feed(*[spark.createDataFrame(logs[k::3], l_ddl) for k in range(3)], spark.createDataFrame([(end, "other", 8)], l_ddl))
    got = defaultdict(list)
    for r in drain(join_streams(e, lo, "90 seconds", "200 seconds", "1 minute", "2 hours")).filter("seq >= 0").collect():
        got[r["seq"]].append((r["n_logs"], r["n_errors"], r["worst_level"]))
    assert got == want


def test_an_event_is_held_once_however_many_slots_it_reaches(spark, feed, tmp_path):
    """240 slots in the range: what is put into the state goes with the rows that come in."""
    events = spark.range(300).selectExpr("id AS seq", "timestamp_seconds(1704067200 + id * 60) AS ts", "concat('s', id % 5) AS session_id")
    logs = events.selectExpr("ts", "session_id", "CAST(seq % 9 AS INT) AS level")
    joined = join_streams(feed(events), feed(logs), "3 hours", "1 hour", "1 minute", "1 hour")
    run = joined.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert run.awaitTermination(120)
    assert sum(s.numRowsUpdated for p in run.recentProgress for s in p.stateOperators) <= 4 * 600


def test_joined_events_keep_their_columns(spark, feed, drain):
    """Big integers beside nulls, microseconds, NaN, decimals, bytes, nested values; an event without a time, one far in the future."""
    big, cent = 2**63 - 1, Decimal("12345678901234567890.12")
    ddl = ("seq long, ts timestamp, session_id string, tenant binary, big long, wide decimal(22,2), x double, "
           "seen timestamp, day date, inner struct<a:array<long>,b:string>, named map<string,int>")  # fmt: skip
    rows = [
        (1, at(10), "s", b"\xff\x00", big, cent, float("nan"), at(1.000001), dt.date(2024, 2, 29), ([big, None], 'q"é\n'), {"k": 1}),
        (2, at(10), "s", b"\xff\x01", None, None, None, None, None, None, None),
        (3, None, "s", b"\xff\x00", -big, -cent, float("-inf"), at(0), None, (None, None), {}),
        (4, at(10), None, b"\xff\x00", 2**53 + 1, None, -0.0, None, None, None, None),
        (5, at(10), "s", None, 0, None, 0.1, None, None, None, None),
    ]
    end = (-1, at(10**7), "end", None, *[None] * 7)
    logs = [(at(s), "s", t, v) for s, t, v in [(5, b"\xff\x00", 4), (15, b"\xff\x00", None), (15, b"\xff\x01", 2), (15, None, 0)]]
    logs += [(None, "s", b"\xff\x00", 0), (at(10), None, b"\xff\x00", 0)]
    l_ddl = "ts timestamp, session_id string, tenant binary, level tinyint"
    e = feed(spark.createDataFrame(rows, ddl), spark.createDataFrame([end], ddl))
    lo = feed(spark.createDataFrame(logs, l_ddl), spark.createDataFrame([(end[1], "end", b"", 8), (dt.datetime(2300, 1, 1), "end", b"", 8)], l_ddl))
    out = drain(join_streams(e, lo, "5 seconds", "5 seconds", "7 seconds", "1 minute")).filter("seq >= 0")
    assert out.schema["worst_level"].dataType.simpleString() == "tinyint"
    got = {r["seq"]: r for r in out.collect()}
    assert {k: (r["n_logs"], r["n_errors"], r["worst_level"]) for k, r in got.items()} == {
        1: (2, 0, 4), 2: (1, 1, 2), 3: (0, 0, None), 4: (0, 0, None), 5: (0, 0, None),
    }
    for want in rows:
        assert repr(tuple(got[want[0]])[: len(want)]) == repr(tuple(spark.createDataFrame([want], ddl).first()))
