"""Stored validity intervals: late changes, versions, and streams that read them while they change."""

from __future__ import annotations

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.session import shared_dir
from signalyard.streaming import enrich_asof_stream

T0 = dt.datetime(2024, 1, 1)
CHANGE = "user_id string, ts timestamp, seq long, plan string"
EVENT = "user_id string, ts timestamp, seq long"


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def _valid(changes, user, ts):
    """The values of the last change at or before a time."""
    own = [(c[1], c[2], c[3]) for c in changes if c[0] == user and c[1] <= ts]
    return max(own)[2] if own else None


def test_late_changes_cut_intervals(spark, tmp_path, rows_of):
    table = op.ValidityTable(spark, str(tmp_path / "v"), {"user_id": "string"}, {"plan": "string"}, buckets=3)
    first = [("a", at(10), 1, "free"), ("a", at(50), 2, "pro"), ("b", at(5), 3, "free"), (None, at(1), 4, "none")]
    late = [("a", at(30), 5, "trial"), ("a", at(50), 2, "changed"), ("c", at(9), 6, None), ("a", at(30), 7, "x"), ("a", at(30), 7, "w")]
    assert table.fold(spark.createDataFrame(first, CHANGE)) == 1
    assert table.fold(spark.createDataFrame(late, CHANGE)) == 2
    assert table.fold(spark.createDataFrame([], CHANGE)) == 3
    never = dt.datetime(9999, 12, 31)
    got = rows_of(table.intervals(), "user_id", "plan", "valid_from", "seq", "valid_to")
    assert got == sorted([
        ("a", "free", at(10), 1, at(30)), ("a", "trial", at(30), 5, at(30)), ("a", "x", at(30), 7, at(50)), ("a", "pro", at(50), 2, never),
        ("b", "free", at(5), 3, never), ("c", None, at(9), 6, never), (None, "none", at(1), 4, never),
    ], key=repr)
    assert ("a", at(10), at(50)) in rows_of(table.intervals(1), "user_id", "valid_from", "valid_to")
    # New rows and the one interval that was cut; b and the null key are left alone.
    assert {r["version"]: r["n_rows"] for r in table.versions().collect()} == {1: 4, 2: 4, 3: 0}
    events = spark.createDataFrame([("a", at(s), s) for s in (9, 10, 40, 50)] + [("c", at(20), 1), ("z", at(1), 1)], EVENT)
    assert rows_of(table.at_time(events), "user_id", "seq", "plan") == sorted([
        ("a", 9, None), ("a", 10, "free"), ("a", 40, "x"), ("a", 50, "pro"), ("c", 1, None), ("z", 1, None),
    ], key=repr)


def test_events_keep_what_was_valid_while_the_table_changes(spark, feed, tmp_path, rows_of):
    draw = random.Random(5)
    users = [f"u{k}" for k in range(6)]
    changes = [(draw.choice(users), at(draw.randint(0, 1000)), k, f"p{k}") for k in range(120)]
    events = [(draw.choice(users), at(draw.randint(0, 1000)), 1000 + k) for k in range(200)]
    # Each row comes with the micro-batch of its time or, up to 100 seconds late, of a later one.
    batch = {r[2]: min(3, int(((r[1] - T0).total_seconds() + draw.choice([0, 0, 99])) // 300)) for r in [*changes, *events]}
    end = [("end", at(10**6), -1)]
    e = feed(*[spark.createDataFrame([r for r in events if batch[r[2]] == k], EVENT) for k in range(4)], spark.createDataFrame(end, EVENT))
    c = feed(*[spark.createDataFrame([r for r in changes if batch[r[2]] == k], CHANGE) for k in range(4)])
    table = op.ValidityTable(spark, str(tmp_path / "v"), {"user_id": "string"}, {"plan": "string"}, buckets=2)
    path = str(tmp_path / "flow")
    for _ in range(2):  # the second run finds nothing new
        assert enrich_asof_stream(e, c, table, path, f"{path}/checkpoint", "100 seconds").awaitTermination(300)
    out = spark.read.parquet(f"{path}/out").filter("seq >= 0")
    assert rows_of(out, "user_id", "seq", "plan") == sorted(((u, k, _valid(changes, u, ts)) for u, ts, k in events), key=repr)
    assert out.select("flush").distinct().count() >= 3
    assert table.intervals().filter(F.col("valid_from") < F.col("valid_to")).count() <= len(changes)


def test_history_is_computed_once(spark, tmp_path, monkeypatch):
    """However often the scan counts before it runs."""
    table = op.ValidityTable(spark, str(tmp_path / "v"), {"user_id": "string"}, {"plan": "string"}, buckets=2)
    table.fold(spark.createDataFrame([("a", at(k), k, f"p{k}") for k in range(40)], CHANGE))
    seen, stored = spark.sparkContext.accumulator(0), table.intervals

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def intervals(version=None, near=None):
        found = stored(version, near)
        return found.mapInArrow(counted, found.schema)

    monkeypatch.setattr(table, "intervals", intervals)
    events = spark.createDataFrame([("a", at(k + 0.5), k) for k in range(40)], EVENT)
    assert {r["seq"]: r["plan"] for r in table.at_time(events).collect()} == {k: f"p{k}" for k in range(40)}
    assert seen.value == 40


def test_a_micro_batch_leaves_no_tables_behind(spark, feed, tmp_path):
    folder = f"{shared_dir(spark)}/tables"
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    e = feed(spark.createDataFrame([("a", at(1), 1)], EVENT), spark.createDataFrame([("end", at(1000), -1)], EVENT))
    c = feed(spark.createDataFrame([("a", at(0), 0, "free")], CHANGE))
    table = op.ValidityTable(spark, str(tmp_path / "v"), {"user_id": "string"}, {"plan": "string"}, buckets=2)
    path = str(tmp_path / "flow")
    assert enrich_asof_stream(e, c, table, path, f"{path}/checkpoint", "10 seconds").awaitTermination(120)
    assert [r["plan"] for r in spark.read.parquet(f"{path}/out").filter("seq = 1").collect()] == ["free"]
    assert set(os.listdir(folder)) <= before
