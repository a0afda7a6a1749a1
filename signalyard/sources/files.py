"""Landed signals: Parquet and JSON lines with a fixed schema, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from signalyard.schemas import batch_schema, signal_schema

# Column with the text of JSON lines that do not fit the schema.
MALFORMED = "_malformed"
FORMATS = ("parquet", "json", "orc")


def _reader(reader, schema: T.StructType, fmt: str):
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")
    if fmt == "json":
        # Keep bad lines as data instead of failing; "Infinity" is how a bucket bound is written.
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
        reader = reader.option("allowNonNumericNumbers", "true")
    return reader.schema(schema).format(fmt)


def read_signals(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """Scan landed signals of one kind. Partition folders such as ``day=...`` become columns."""
    return _reader(spark.read, signal_schema(kind), fmt).load(path)


def read_batches(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """Scan landed envelopes with signals of one kind."""
    return _reader(spark.read, batch_schema(kind), fmt).load(path)


def _stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str, max_files: int | None, max_bytes: int | None
) -> DataFrame:
    if max_files and max_bytes:
        raise ValueError("bound the intake by files or by bytes, not by both")
    reader = _reader(spark.readStream, schema, fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def stream_signals(
    spark: SparkSession, path: str, kind: str, max_files: int | None = 1000, fmt: str = "parquet",
    max_bytes: int | None = None,
) -> DataFrame:
    """The same as an unbounded table. ``max_files`` or ``max_bytes`` per trigger bounds the intake: nothing is dropped."""
    return _stream(spark, path, signal_schema(kind), fmt, max_files, max_bytes)


def stream_batches(
    spark: SparkSession, path: str, kind: str, max_files: int | None = 1000, fmt: str = "parquet",
    max_bytes: int | None = None,
) -> DataFrame:
    """Envelopes as an unbounded table."""
    return _stream(spark, path, batch_schema(kind), fmt, max_files, max_bytes)
