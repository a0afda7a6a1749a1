"""Writing signals: partitioned appends, timed streams, a side table for bad rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalyard.operators.stamping import tenant_digest

ROWS_PER_FILE = 2_000_000


def _laid_out(df: DataFrame, type_column: str | None) -> tuple[DataFrame, list[str]]:
    """Rows with the folder columns: tenant digest (never the key itself), type and day."""
    folders = []
    if "tenant" in df.columns:
        df = tenant_digest(df)
        folders.append("tenant_id")
    if type_column and type_column in df.columns:
        folders.append(type_column)
    return df.withColumn("day", F.to_date("ts")), [*folders, "day"]


def write_signals(
    df: DataFrame,
    path: str,
    type_column: str | None = None,
    fmt: str = "parquet",
    rows_per_file: int = ROWS_PER_FILE,
    mode: str = "append",
) -> None:
    """Append by tenant, type and day with a bounded number of rows per file.

    ``REBALANCE`` brings the rows of a folder together and lets adaptive execution split folders that
    are too big for one task, so a busy tenant is written by many tasks and a quiet one by few.
    """
    laid_out, folders = _laid_out(df, type_column)
    (
        laid_out.hint("rebalance", *[F.col(c) for c in folders])
        .write.mode(mode)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*folders)
        .format(fmt)
        .save(path)
    )


def stream_to_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    flush_interval: str | None = "10 seconds",
    type_column: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Timed micro-batches into ``path``; without an interval, everything there is and then stop.

    The checkpoint holds unsent work across restarts. A micro-batch that is repeated after a failure
    replaces its own folder, so nothing is written twice. ``transform`` runs on every micro-batch.
    """

    def flush(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        write_signals(rows, f"{path}/flush={batch_id}", type_column, mode="overwrite")

    writer = df.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    if flush_interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=flush_interval).start()


def quarantine(
    df: DataFrame, path: str, by: Sequence[str] = (), on_error: Callable[[dict], None] | None = None
) -> DataFrame:
    """Append rows with an ``error`` to a side table and return the good rows.

    Never fails the job: bad rows are data. ``on_error`` gets the number of rejected rows, counted while
    they are written.
    """
    bad = df.filter("error IS NOT NULL")
    if "tenant" in bad.columns:  # the raw key is a credential and stays out of side tables
        bad = tenant_digest(bad).drop("tenant")
    seen = Observation()
    observed = bad.observe(seen, F.count("*").alias("rejected"))
    writer = observed.write.mode("append")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    if on_error:
        on_error(dict(seen.get))
    return df.filter("error IS NULL").drop("error")
