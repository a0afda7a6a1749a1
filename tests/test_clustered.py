"""Clustered writes: same rows, fewer row groups per selection; and tables that a scope removes."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from signalyard.session import durable, durable_scope
from signalyard.sources import write_clustered

BY = ["tenant", "ts", "name", "user"]


@pytest.fixture(scope="module")
def events(spark):
    """40,000 rows; one tenant has a third of them."""
    h = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10_000)) for k in range(4)]
    return spark.range(40_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), h[0] % 40)).alias("tenant"),
        F.timestamp_seconds(F.lit(1_704_067_200) + h[1] * 250).alias("ts"),
        F.concat(F.lit("name "), h[2] % 30).alias("name"),
        F.concat(F.lit("user-with-a-long-common-prefix-"), F.lpad((h[3] % 5000).cast("string"), 6, "0")).alias("user"),
    )


def _groups(path, column, lo, hi):
    """Row groups whose least and greatest value allow a value between ``lo`` and ``hi``, and all row groups."""
    hit = total = 0
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= hi and stats.max >= lo
    return hit, total


def test_every_column_prunes_and_no_row_is_lost(spark, events, tmp_path):
    plain, path = str(tmp_path / "plain"), str(tmp_path / "clustered")
    events.repartition(100).write.parquet(plain)
    write_clustered(events, path, BY, rows_per_file=400)
    back = spark.read.parquet(path)
    assert back.count() == 40_000 and back.exceptAll(events).count() == 0
    day = dt.datetime(2024, 1, 15, tzinfo=dt.UTC)
    selections = {
        "tenant": ("t7", "t7"), "ts": (day, day + dt.timedelta(hours=6)), "name": ("name 7", "name 7"),
        "user": ("user-with-a-long-common-prefix-001234",) * 2,
    }
    # 100 files are 6.6 cuts in two for four columns together: each column is cut once or twice, and files may lie across a cut.
    shares = []
    for column, (lo, hi) in selections.items():
        before, all_before = _groups(plain, column, lo, hi)
        after, total = _groups(path, column, lo, hi)
        assert before == all_before and total >= 80
        shares.append(after / total)
    assert max(shares) < 0.75 and sum(shares) / 4 < 0.5, shares
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in Path(path).glob("*.parquet")]
    assert max(sizes) <= 800


def test_nulls_equal_rows_and_empty_tables(spark, tmp_path, rows_of):
    rows = [(None, None), ("a", 1.0), ("a", 1.0), ("", float("nan")), ("é", -1.0), ("z" * 500, None)] * 3
    df = spark.createDataFrame(rows, "s string, d double")
    write_clustered(df, str(tmp_path / "a"), ["s", "d"], rows_per_file=4, bits=2)
    assert repr(rows_of(spark.read.parquet(str(tmp_path / "a")))) == repr(sorted(rows, key=repr))
    write_clustered(df.limit(0), str(tmp_path / "b"), ["s", "d"])
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "b")).count() == 0
    with pytest.raises(ValueError, match="no order"):
        write_clustered(df.select(F.array("s").alias("s")), str(tmp_path / "c"), ["s"])
    with pytest.raises(ValueError, match="62 bits"):
        write_clustered(df, str(tmp_path / "c"), ["s", "d"], bits=32)


def test_a_scope_removes_its_own_tables(spark):
    def folder(df):
        return Path(df.inputFiles()[0].removeprefix("file:")).parent

    kept = durable(spark.range(3))
    with durable_scope(spark):
        outer = folder(durable(spark.range(4)))
        with durable_scope(spark):
            inner = folder(durable(spark.range(5)))
        assert outer.exists() and not inner.exists()
    assert not outer.exists() and folder(kept).exists() and kept.count() == 3
    with pytest.raises(RuntimeError), durable_scope(spark):
        lost = folder(durable(spark.range(2)))
        raise RuntimeError
    assert not lost.exists()
