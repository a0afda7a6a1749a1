"""Two tenants that share user ids, session ids and sequence numbers never meet."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from signalyard import operators as op

T0 = dt.datetime(2024, 1, 1)
DDL = "tenant string, seq long, ts timestamp, user_id string, session_id string, event_name string"


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture
def events(table):
    """Tenant A goes from X to Y and comes back a day later; tenant B stops after X."""
    return table(
        DDL,
        ("A", 1, at(0), "u", "s", "X"), ("A", 2, at(10), "u", "s", "Y"), ("A", 3, at(86_400), "u", "s2", "X"),
        ("B", 1, at(0), "u", "s", "X"),
    )


def test_logs_near_event(events, table, rows_of):
    logs = table("tenant string, seq long, ts timestamp, session_id string, level int", ("A", 1, at(1), "s", 3))
    got = rows_of(op.logs_near_event(events.filter("seq = 1"), logs), "tenant", "n_logs", "n_errors")
    assert got == [("A", 1, 1), ("B", 0, 0)]


def test_metrics_align(table, rows_of):
    ddl = "tenant string, seq long, ts timestamp, value double"
    a, b = table(ddl, ("A", 1, at(0), 1.0), ("B", 1, at(0), 2.0)), table(ddl, ("B", 1, at(1), 9.0))
    assert rows_of(op.metrics_align(a, b, "1 minute"), "tenant", "other_value") == [("A", None), ("B", 9.0)]


def test_funnel(events, rows_of):
    got = rows_of(op.funnel(events, ["X", "Y"]), "tenant", "step", "users", "rate_from_first")
    assert got == [("A", 1, 1, 1.0), ("A", 2, 1, 1.0), ("B", 1, 1, 1.0)]


def test_paths(events, rows_of):
    got = rows_of(op.paths(events).withColumn("path", F.array_join("path", ">")), "tenant", "path", "n")
    assert got == [("A", "X", 1), ("A", "X>Y", 1), ("B", "X", 1)]


def test_retention_table(events, rows_of):
    wide = op.retention_table(op.retention(events, period="day"), [0, 1])
    assert rows_of(wide, "tenant", "cohort_size", "p0", "p1") == [("A", 1, 1.0, 1.0), ("B", 1, 1.0, None)]
