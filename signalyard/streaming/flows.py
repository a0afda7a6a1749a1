"""Whole streaming flows: bounded intake, late rows aside, three sinks and a quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from signalyard.operators.delivery import route_by_schema, unpack_batches
from signalyard.operators.validation import split_valid, validate_signals
from signalyard.operators.validity import ValidityTable
from signalyard.schemas import signal_schema
from signalyard.session import durable_scope
from signalyard.sources.files import stream_signals
from signalyard.sources.row_intake import stream_rows
from signalyard.sources.sinks import write_signals


def bounded_intake(
    spark: SparkSession,
    path: str,
    kind: str,
    max_files: int | None = None,
    fmt: str = "parquet",
    max_bytes: int | None = None,
    max_rows: int | None = None,
    index: str | None = None,
) -> DataFrame:
    """A signal stream that takes at most ``max_files`` files, ``max_bytes`` bytes of files or ``max_rows`` rows per trigger.

    It waits instead of dropping. Give one of the three; a file that alone is larger than ``max_bytes`` is a trigger of its own.
    ``max_rows`` cuts files (Parquet only) and needs a folder ``index``, see ``sources.stream_rows``.
    """
    bounds = {"max_files": max_files, "max_bytes": max_bytes, "max_rows": max_rows}
    for name, bound in bounds.items():
        if bound is not None and bound < 1:
            raise ValueError(f"{name} must be at least 1")
    if sum(bound is not None for bound in bounds.values()) != 1:
        raise ValueError("give max_files or max_bytes or max_rows")
    if max_rows is not None:
        if fmt != "parquet" or index is None:
            raise ValueError("max_rows needs Parquet files and an index folder")
        return stream_rows(spark, path, signal_schema(kind), max_rows, index)
    return stream_signals(spark, path, kind, max_files, fmt, max_bytes)


class IntakeListener(StreamingQueryListener):
    """Remembers the rows taken in by every trigger, newest last."""

    def __init__(self, keep: int = 1000) -> None:
        self.rows: list[int] = []
        self._keep = keep

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows.append(event.progress.numInputRows)
        del self.rows[: -self._keep]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _run(df: DataFrame, step, checkpoint: str, trigger: str | None) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (
        writer.trigger(availableNow=True).start()
        if trigger is None
        else writer.trigger(processingTime=trigger).start()
    )


def late_split(df: DataFrame, path: str, checkpoint: str, delay: str, trigger: str | None = None) -> StreamingQuery:
    """On-time rows to ``path/on_time``, late rows to ``path/late``.

    Late means older than the latest time seen before this micro-batch minus ``delay``; a time in the future counts as
    the time it arrived. That mark is
    one row per micro-batch in ``path/marks``, so a restart goes on where it stopped and a repeated
    micro-batch writes the same folders again.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            seen = None
            if batch_id > 0:
                seen = spark.read.parquet(f"{path}/marks/flush={batch_id - 1}").first()["mark"]
            newest = rows.agg(F.least(F.max("ts"), F.current_timestamp()).alias("mark")).first()["mark"]
            mark = max((t for t in (seen, newest) if t is not None), default=None)
            if seen is None:
                late = F.lit(False)
            else:
                late = F.coalesce(F.col("ts") < F.lit(seen) - F.expr(f"INTERVAL {delay}"), F.lit(False))
            rows.filter(~late).write.mode("overwrite").parquet(f"{path}/on_time/flush={batch_id}")
            rows.filter(late).write.mode("overwrite").parquet(f"{path}/late/flush={batch_id}")
            marks = spark.range(1).select(F.lit(mark).cast("timestamp").alias("mark"))
            marks.write.mode("overwrite").parquet(f"{path}/marks/flush={batch_id}")
        finally:
            rows.unpersist()

    return _run(df, step, checkpoint, trigger)


def enrich_asof_stream(
    events: DataFrame, changes: DataFrame, table: ValidityTable, path: str, checkpoint: str, delay: str, trigger: str | None = None
) -> StreamingQuery:
    """Events with the values of their key that were valid at their time, to ``path/out``; the stream form of ``asof_profile``.

    ``events`` has the table's keys, ts and seq; ``changes`` also its values. Each micro-batch adds its changes to ``table`` as a
    version, then lets go the events that are older than the newest time seen on either stream by ``delay`` or more; the rest
    is held in ``path/held``. So a change counts for every event at or after its time if it comes at most ``delay`` late,
    and changes of the table never rewrite what an earlier event had. Later changes still get into the table.
    Folders and versions are per micro-batch, so a repeat writes the same again. An event without a time has no values.
    """
    empty = {n: F.lit(None).cast(df.select(F.struct(*df.columns)).schema[0].dataType) for n, df in (("event", events), ("change", changes))}
    both = events.select(F.struct(*events.columns).alias("event"), empty["change"].alias("change")).unionByName(
        changes.select(empty["event"].alias("event"), F.struct(*changes.columns).alias("change"))
    )
    schema = events.schema

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            # What is written down on the way goes with the micro-batch.
            with durable_scope(spark):
                version = table.fold(rows.filter("change IS NOT NULL").select("change.*"), batch_id + 1)
                held = rows.filter("event IS NOT NULL").select("event.*")
                seen = None
                if batch_id > 0:
                    held = held.unionByName(spark.read.schema(schema).parquet(f"{path}/held/flush={batch_id - 1}"))
                    seen = spark.read.parquet(f"{path}/marks/flush={batch_id - 1}").first()["mark"]
                newest = rows.agg(F.max(F.coalesce("event.ts", "change.ts")).alias("mark")).first()["mark"]
                mark = max((t for t in (seen, newest) if t is not None), default=None)
                waits = F.coalesce(F.col("ts") > F.lit(mark) - F.expr(f"INTERVAL {delay}"), F.lit(False))
                table.at_time(held.filter(~waits), version=version).write.mode("overwrite").parquet(f"{path}/out/flush={batch_id}")
                held.filter(waits).write.mode("overwrite").parquet(f"{path}/held/flush={batch_id}")
                marks = spark.range(1).select(F.lit(mark).cast("timestamp").alias("mark"))
                marks.write.mode("overwrite").parquet(f"{path}/marks/flush={batch_id}")
        finally:
            rows.unpersist()

    return _run(both, step, checkpoint, trigger)


def _without_tenant(batches: DataFrame) -> Column:
    """The signals of an envelope without the tenant's key: it is a credential and stays out of side tables."""
    if "tenant" not in batches.schema["data"].dataType.elementType.fieldNames():
        return F.col("data")
    return F.transform("data", lambda signal: signal.dropFields("tenant"))


def route_stream(batches: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Envelopes to ``path/event``, ``path/log``, ``path/metric``, and bad rows to ``path/quarantine``.

    ``data`` holds signals of all kinds, with the fields of the other kinds NULL. Each signal is
    unpacked and validated; a row with an error keeps its kind, field and reason. Folders are per
    micro-batch, so a repeat writes nothing twice.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            routes = route_by_schema(rows)
            rejected = []
            for kind in ("event", "log", "metric"):
                signals = unpack_batches(routes[kind])
                have = [f.name for f in signal_schema(kind).fields if f.name in signals.columns]
                good, bad = split_valid(validate_signals(signals.select(*have), kind))
                write_signals(good, f"{path}/{kind}/flush={batch_id}", mode="overwrite")
                rejected.append(bad.select(F.lit(kind).alias("kind"), "error.field", "error.reason", F.to_json(F.struct(*[c for c in have if c != "tenant"])).alias("row")))
            unknown = routes["quarantine"]
            rejected.append(
                unknown.select(
                    F.coalesce("schema_type", F.lit("unknown")).alias("kind"),
                    F.lit("schemaType").alias("field"),
                    F.lit("is unknown").alias("reason"),
                    F.to_json(F.struct("batch_id", _without_tenant(unknown).alias("data"))).alias("row"),
                )
            )
            side = rejected[0]
            for part in rejected[1:]:
                side = side.unionByName(part)
            side.write.mode("overwrite").parquet(f"{path}/quarantine/flush={batch_id}")
        finally:
            rows.unpersist()

    return _run(batches, step, checkpoint, trigger)
