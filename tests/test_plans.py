"""Split keys must give exactly what ordinary windows give."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from signalyard.plans import (
    Ordered,
    asof_backward,
    asof_forward,
    hot_keys,
    last_seen,
    lookup,
    next_row,
    next_seen,
    prev_row,
    running_max,
    running_min,
    running_sum,
    suffix_max,
    suffix_min,
    suffix_sum,
)
from signalyard.plans import skew
from signalyard.plans.trailing import trailing_range, trailing_rows, width_us

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of all rows, a NULL key, ties in time, and gaps in the values."""
    rng = random.Random(7)
    rows = []
    for seq in range(600):
        key = "hot" if seq % 3 == 0 else rng.choice(["a", "b", "c", "d", None])
        value = None if rng.random() < 0.3 else rng.randint(-50, 50)
        rows.append((key, T0 + dt.timedelta(seconds=rng.randint(0, 200)), seq, value))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, ts timestamp, seq int, v int").cache()
    frame.count()  # cached rows have a known size
    return frame


SCANS = {
    "prev": lambda: prev_row("v"),
    "next": lambda: next_row("v"),
    "last": lambda: last_seen("v"),
    "later": lambda: next_seen("v"),
    "rsum": lambda: running_sum("v"),
    "rmin": lambda: running_min("v"),
    "rmax": lambda: running_max("v"),
    "ssum": lambda: suffix_sum("v"),
    "smin": lambda: suffix_min("v"),
    "smax": lambda: suffix_max("v"),
    "pos": lambda: running_sum(F.lit(1)),
}


def test_keys_that_fit_a_task_are_not_hot(skewed):
    assert hot_keys(skewed, ["k"]) is None


def test_one_large_key_in_a_tiny_file_is_split_by_default(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5_000_000).select(F.lit("u").alias("k"), F.timestamp_seconds(F.col("id") / 1000).alias("ts"), "id").withColumn(
        "ts", F.date_trunc("day", "ts")
    ).drop("id").repartition(1).write.parquet(path)
    assert sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")) < 1 << 20
    rows = spark.read.parquet(path).withColumn("seq", F.monotonically_increasing_id())
    done = Ordered.of(rows, ["k"], ["ts", "seq"])
    assert done.hot is not None and done.hot.select("_chunk").distinct().count() >= 2
    last = done.scan(n=running_sum(F.lit(1))).frame().agg(F.max("n"), F.count("*")).first()
    assert tuple(last) == (5_000_000, 5_000_000)


def test_few_rows_of_many_bytes_are_hot(spark):
    wide = spark.range(40).select(F.lit("k").alias("k"), F.repeat(F.lit("x"), 1000).alias("payload"))
    spark.conf.set(skew.HOT_BYTES_CONF, "10000")
    try:
        assert hot_keys(wide, ["k"]).pieces >= 4
    finally:
        spark.conf.unset(skew.HOT_BYTES_CONF)


def test_hot_keys_are_found_and_bounded(skewed, forced_split):
    with forced_split(rows=100, partitions=4):
        hot = hot_keys(skewed, ["k"])
        assert [r["k"] for r in hot.table.collect()] == ["hot"]
        assert hot.rows == 200
        assert hot.pieces >= 2


@pytest.mark.parametrize("keys", [["k"], []])
def test_split_scans_equal_plain_windows(skewed, forced_split, rows_of, keys):
    scans = {n: make() for n, make in SCANS.items()}
    plain = Ordered.of(skewed, keys, ["ts", "seq"]).scan(**scans)
    assert plain.hot is None
    with forced_split():
        cut = Ordered.of(skewed, keys, ["ts", "seq"])
        assert cut.hot is not None
        assert cut.hot.select("_chunk").distinct().count() > 3
        got = rows_of(cut.scan(**scans).frame())
    assert got == rows_of(plain.frame())


def test_chained_scans_on_split_keys(skewed, forced_split, rows_of):
    def chain():
        return (
            Ordered.of(skewed, ["k"], ["ts", "seq"])
            .scan(a=prev_row("v"))
            .with_columns(b=F.coalesce(F.col("a"), F.lit(1)))
            .filter(F.col("seq") % 2 == 0)
            .scan(c=running_sum("b"), a=next_seen("b"))
            .frame()
        )

    expected = rows_of(chain())
    with forced_split():
        assert rows_of(chain()) == expected


def test_chained_scans_shuffle_once(skewed):
    rows = Ordered.of(skewed, ["k"], ["ts", "seq"]).scan(a=prev_row("v"))
    plan = rows.scan(b=running_sum("a"), c=next_seen("a")).frame()._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange") == 1
    assert physical.count("Sort ") == 2  # one per direction


def test_lookup_keeps_every_row(spark, skewed, forced_split, rows_of):
    names = spark.createDataFrame([("hot", 1), ("a", 2), ("zz", 3)], "k string, n int")
    for how in ("left", "inner"):
        expected = rows_of(skewed.join(names, ["k"], how))
        with forced_split():
            assert rows_of(lookup(skewed, names, ["k"], how)) == expected


def test_asof_against_brute_force(spark, skewed, forced_split, rows_of):
    left = skewed.select("k", "ts", "seq")
    right = skewed.filter("seq % 7 = 0").select("k", "ts", "seq", F.col("v").alias("rv"))
    l, r = left.collect(), right.collect()

    def brute(keep, best):
        out = []
        for a in l:
            hits = [b for b in r if b["k"] == a["k"] and keep(b["ts"], a["ts"])]
            pick = best(hits, key=lambda b: (b["ts"], b["seq"])) if hits else None
            out.append((a["k"], a["ts"], a["seq"], pick["rv"] if pick else None))
        return sorted(out, key=repr)

    back = brute(lambda b, a: b <= a, max)
    forward = brute(lambda b, a: b >= a, min)
    after = brute(lambda b, a: b > a, min)

    def check():
        assert rows_of(asof_backward(left, right, ["k"], ["rv"])) == back
        assert rows_of(asof_forward(left, right, ["k"], ["rv"])) == forward
        assert rows_of(asof_forward(left, right, ["k"], ["rv"], inclusive=False)) == after

    check()
    with forced_split(rows=20):
        check()


def test_trailing_rows(skewed, forced_split, rows_of):
    window = Window.partitionBy("k").orderBy("ts", "seq").rowsBetween(-4, 0)
    expected = rows_of(
        skewed.select("k", "seq", F.count("v").over(window), F.min("v").over(window), F.max("v").over(window), F.avg("v").over(window))
    )
    got = trailing_rows(skewed, ["k"], ["ts", "seq"], 5, "v").select("k", "seq", "n", "min", "max", "mean")
    assert rows_of(got) == expected
    with forced_split(rows=20):
        got = trailing_rows(skewed, ["k"], ["ts", "seq"], 5, "v").select("k", "seq", "n", "min", "max", "mean")
        assert rows_of(got) == expected


@pytest.mark.parametrize("width", ["10 seconds", "1 second", "5 minutes"])
def test_trailing_range_against_brute_force(skewed, forced_split, rows_of, width):
    rows = skewed.collect()
    span = dt.timedelta(microseconds=width_us(width))
    expected = []
    for key, ts in {(r["k"], r["ts"]) for r in rows}:
        inside = [r["v"] for r in rows if r["k"] == key and ts - span <= r["ts"] <= ts and r["v"] is not None]
        expected.append(
            (key, ts, len(inside), sum(inside) if inside else None, min(inside, default=None), max(inside, default=None))
        )
    expected.sort(key=repr)
    assert rows_of(trailing_range(skewed, ["k"], width, "v")) == expected
    with forced_split(rows=20):
        assert rows_of(trailing_range(skewed, ["k"], width, "v")) == expected


def test_width_us():
    assert width_us("1 day 2 hours") == (86_400 + 7_200) * 10**6
    assert width_us("250 milliseconds") == 250_000
