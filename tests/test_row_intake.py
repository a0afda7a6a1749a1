"""Intake bounded by rows: triggers, restarts, late files, partition folders."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from signalyard.sources import stream_rows
from signalyard.sources.row_intake import FileList
from signalyard.streaming import bounded_intake


def _take(stream, out, checkpoint):
    query = (
        stream.writeStream.foreachBatch(lambda df, k: df.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{out}/b={k}"))
        .option("checkpointLocation", checkpoint).start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_no_trigger_above_the_bound_and_nothing_lost_over_restarts(spark, tmp_path):
    path, index, out, checkpoint = (str(tmp_path / n) for n in ("in", "index", "out", "cp"))
    rows = spark.range(0, 1000, 1, 1).select("id", F.concat(F.lit("v"), "id").alias("name"), F.timestamp_micros("id").alias("ts"))
    # One large file of several row groups, in a partition folder.
    rows.write.option("parquet.block.size", 2048).option("parquet.page.size", 512).parquet(f"{path}/day=2024-01-01")
    ddl = spark.createDataFrame([], "id long, name string, ts timestamp, day date, missing double").schema
    _take(stream_rows(spark, path, ddl, 300, index), out, checkpoint)
    # Later files, one of them with an earlier name and one empty, and a new run with another bound.
    rows.filter("id < 50").withColumn("id", F.col("id") + 1000).coalesce(1).write.parquet(f"{path}/day=2023-12-31")
    rows.filter("id < 0").coalesce(1).write.parquet(f"{path}/day=2024-01-02")
    _take(stream_rows(spark, path, ddl, 20, index), out, checkpoint)
    got = spark.read.parquet(*[str(p) for p in (tmp_path / "out").iterdir()])
    per_batch = {r["batch"]: r["count"] for r in got.groupBy("batch").count().collect()}
    assert sum(per_batch.values()) == 1050 and got.select("id").distinct().count() == 1050
    assert [per_batch[k] for k in sorted(per_batch)] == [300, 300, 300, 100, 20, 20, 10]
    assert got.filter("missing IS NOT NULL OR name IS NULL OR day IS NULL").count() == 0
    assert got.filter("id < 1000 AND (name <> concat('v', id) OR ts <> timestamp_micros(id) OR day <> '2024-01-01')").count() == 0
    assert got.filter("id >= 1000 AND day = '2023-12-31'").count() == 50


def test_offsets_are_places_in_a_list_written_once(spark, tmp_path):
    path, index = str(tmp_path / "in"), str(tmp_path / "index")
    none = FileList(path, index)
    none.look()
    assert none.files == [] and none.after({"file": 0, "row": 0}, 5) == {"file": 0, "row": 0}
    spark.range(0, 10, 1, 1).write.parquet(path)
    first = FileList(path, index)
    first.look()
    spark.range(10, 17, 1, 1).write.mode("append").parquet(path)
    first.look()
    again = FileList(path, index)
    again.load()
    assert again.files == first.files and [sum(rows) for _, rows in again.files] == [10, 7]
    at, seen, triggers = {"file": 0, "row": 0}, [], 0
    while (end := again.after(at, 4)) != at:
        ranges = list(again.between(at, end))
        assert 0 < sum(r[3] for r in ranges) <= 4
        assert ranges == list(again.between(json.loads(json.dumps(at)), end))
        seen += [(r[0], r[2] + k) for r in ranges for k in range(r[3])]
        at, triggers = end, triggers + 1
    assert len(seen) == len(set(seen)) == 17 and triggers == 5
    for more in ({}, {"index": index, "fmt": "json"}, {"index": index, "max_files": 1}):
        with pytest.raises(ValueError, match="max_rows"):
            bounded_intake(spark, path, "event", max_rows=5, **more)
    with pytest.raises(ValueError, match="max_rows"):
        stream_rows(spark, path, spark.range(1).schema, 0, index)
