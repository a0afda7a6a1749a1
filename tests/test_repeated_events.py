"""Tables in which events repeat: many samples of a series at one time, sums that meet a bound exactly."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import add

from pyspark.sql import functions as F

from __spark_entry__ import queries
from signalyard import operators as op
from signalyard.plans import trailing
from workloads import streams
from workloads.tables import Tables


def test_moving_gauge_interval_gives_every_sample(spark, rows_of, forced_split):
    """Samples of one time share their figures; those without a time are their own frame."""
    at = [dt.datetime(2024, 1, 1, h) for h in range(10)]
    rows = [("a", at[0], 1.0), ("a", at[0], 3.0), ("a", at[4], 8.0), ("a", at[4], 8.0), ("a", at[9], 1.0), ("a", None, 5.0), ("a", None, 7.0), (None, at[4], 2.0)]
    samples = spark.createDataFrame(rows, "series_key string, ts timestamp, value double")
    wanted = [
        ("a", at[0], 1.0, 2, 2.0, 1.0, 3.0), ("a", at[0], 3.0, 2, 2.0, 1.0, 3.0), ("a", at[4], 8.0, 4, 5.0, 1.0, 8.0),
        ("a", at[4], 8.0, 4, 5.0, 1.0, 8.0), ("a", at[9], 1.0, 3, 17 / 3, 1.0, 8.0), ("a", None, 5.0, 2, 6.0, 5.0, 7.0),
        ("a", None, 7.0, 2, 6.0, 5.0, 7.0), (None, at[4], 2.0, 1, 2.0, 2.0, 2.0),
    ]
    assert rows_of(op.moving_gauge(samples, interval="5 hours")) == sorted(wanted, key=repr)
    with forced_split(rows=2):
        assert rows_of(op.moving_gauge(samples, interval="5 hours")) == sorted(wanted, key=repr)


def test_rank_users_counts_to_the_cent(spark, tmp_path):
    """120 purchases of 0.1 and ten of 2.8 are 40; added up as doubles they are a little less."""
    amounts = [0.1] * 120 + [2.8] * 10
    assert reduce(add, amounts) < 40  # sum() makes up for lost digits
    when = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(i, when, 1, "purchase", a, '{"k":1}') for i, a in enumerate(amounts)],
        "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert [r["points"] for r in queries()["rank_users"](spark, str(tmp_path)).collect()] == [1]


def test_a_part_of_a_replay_is_one_micro_batch_of_several_files(spark, tmp_path, monkeypatch):
    """Parts of many rows, of fewer rows than files, of none, and of one."""
    spark.range(10).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(streams, "_FILE_ROWS", 3)
    t = Tables(spark, str(tmp_path))
    monkeypatch.setattr(t, "scratch", lambda n=iter(range(9)): f"{tmp_path}/scratch{next(n)}")
    parts = [spark.range(*span) for span in ((0, 100), (100, 102), (102, 102), (102, 150), (150, 151))]
    rows = streams.drain(t, streams.replay(t, *parts))
    assert len(spark.read.parquet(f"{tmp_path}/scratch0").inputFiles()) > len(parts)
    got = {r["flush"]: (r["a"], r["b"], r["n"]) for r in rows.groupBy("flush").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n")).collect()}
    assert got == {0: (0, 99, 100), 1: (100, 101, 2), 3: (102, 149, 48), 4: (150, 150, 1)}


def test_trailing_rows_are_spread_over_blocks(spark, rows_of, monkeypatch):
    """One series, ten cells a task: the same figures, and no task has them all."""
    samples = spark.range(0, 200, 1, 3).select(F.lit("a").alias("series_key"), F.col("id").alias("seq"), (F.col("id") * 37 % 101).cast("double").alias("value"), F.timestamp_seconds("id").alias("ts"))
    whole = rows_of(op.moving_gauge(samples, rows=7))
    monkeypatch.setattr(trailing, "_TASK_CELLS", 10)
    spread = op.moving_gauge(samples, rows=7)
    assert rows_of(spread) == whole
    assert spread.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_packed_signals_do_not_meet_in_the_task_that_numbers_batches(spark):
    """Three intervals of 25 signals in batches of ten, without a tenant: ids 1 to 9 in order, in more than one partition."""
    signals = spark.range(75).select(F.timestamp_seconds(F.col("id") * 40).alias("ts"), F.col("id").alias("seq"))
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        packed = op.pack_batches(signals, "event", 10, "1000 seconds").withColumn("p", F.spark_partition_id())
        got = sorted((r["batch_id"], [s["seq"] for s in r["data"]], r["p"]) for r in packed.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    edges = [0, 10, 20, 25, 35, 45, 50, 60, 70, 75]
    assert [(i, seqs) for i, seqs, _ in got] == [(k + 1, list(range(a, b))) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert len({p for _, _, p in got}) > 1
