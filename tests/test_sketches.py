"""Stored sketches against exact counts and ranks, also where they no longer hold every row."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from signalyard import operators as op


def test_theta_sketches_beyond_their_size(spark):
    """Two days of 40,000 users each that share 10,000, in sketches of 2^10 entries."""
    day = F.when(F.col("id") < 40_000, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02"))
    user = F.when(F.col("id") < 40_000, F.col("id")).otherwise(F.col("id") - 10_000)
    events = spark.range(80_000).select(day.cast("timestamp").alias("ts"), F.concat(F.lit("u"), user).alias("user_id"))
    sketches = op.user_sketches(events.unionByName(events.limit(500)), lg_k=10)
    got = op.compare_periods(sketches, lg_k=10).collect()
    assert len(got) == 1
    row = got[0]
    assert 0 < row["bound"] < 12_000
    for name, exact in (("n_both", 10_000), ("n_lost", 30_000), ("n_gained", 30_000)):
        assert abs(row[name] - exact) <= row["bound"], name
    month = op.merge_user_sketches(sketches, lg_k=10).select(op.estimated_users().alias("n"), op.user_bound("users", lg_k=10).alias("b")).first()
    assert abs(month["n"] - 70_000) <= month["b"] and month["b"] > 0


def test_small_sketches_are_exact_per_tenant(spark):
    rows = [("t", d, u) for d, us in ((1, "abc"), (2, "bcd"), (3, "x")) for u in us] + [("v", 1, "a"), ("v", 2, "b"), ("v", 2, None)]
    events = spark.createDataFrame([(t, dt.datetime(2024, 1, d, 5), u) for t, d, u in rows], "tenant string, ts timestamp, user_id string")
    got = {(r["tenant"], r["period"].day): (r["n_both"], r["n_lost"], r["n_gained"], r["bound"]) for r in op.compare_periods(op.user_sketches(events)).collect()}
    assert got == {("t", 1): (2, 1, 1, 0), ("t", 2): (0, 3, 1, 0), ("v", 1): (0, 1, 1, 0)}


def test_sketches_of_all_periods_count_a_user_once(spark):
    """Users of two months, one of them in both, another service apart."""
    rows = [("s", 1, "a"), ("s", 1, "b"), ("s", 2, "b"), ("s", 2, "c"), ("s", 2, None), ("z", 2, "b")]
    events = spark.createDataFrame([(v, dt.datetime(2024, m, 3, 5), u) for v, m, u in rows], "service string, ts timestamp, user_id string")
    merged = op.merge_user_sketches(op.user_sketches(events, by=["service"]), period=None, by=["service"])
    assert merged.columns == ["service", "users"]
    assert {r["service"]: r["n"] for r in merged.select("service", op.estimated_users().alias("n")).collect()} == {"s": 3, "z": 1}


def test_day_sketches_merge_to_months(spark):
    draw = np.random.default_rng(3)
    values = [(dt.datetime(2024, 1 + k % 2, 1 + k % 28), "s", float(v)) for k, v in enumerate(draw.lognormal(3, 2, 20_000))]
    df = spark.createDataFrame([*values, (dt.datetime(2024, 1, 1), "s", None)], "ts timestamp, name string, value double")
    days = op.value_sketches(df, by=["name"])
    assert days.count() == 28  # even days of one month, odd days of the other
    months = op.sketched_quantiles(op.merge_value_sketches(days, by=["name"]))
    assert months.columns == ["period", "name", "n", "p50", "p95", "p99"]
    rows = {r["period"].month: r for r in months.collect()}
    keyed = df.filter("value IS NOT NULL").withColumn("period", F.date_trunc("month", "ts"))
    for month in (1, 2):
        own = np.array([v for ts, _, v in values if ts.month == month])
        assert rows[month]["n"] == len(own)
        for name, rank in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert abs((own <= rows[month][name]).mean() - rank) < 0.03
    off = op.rank_error(keyed, months, ["name", "period"], "p95", 0.95).collect()
    assert len(off) == 2 and all(0 <= r["rank_error"] < 0.03 for r in off)
