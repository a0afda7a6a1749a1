"""Fallbacks, stamps and code/time normalization. All stateless, so they run on streams as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.functions.enums import code_of, name_of
from signalyard.functions.scalars import decode_key, null_if_empty, to_timestamp
from signalyard.schemas import DEFAULT_VERSION, ENUMS

NO_SESSION_TYPES = ("identify", "group", "alias")


def stamp_service(df: DataFrame, default: str | None, override: str | None = None) -> DataFrame:
    """``service`` from the configured default, or, for logs, from the row's override first.

    An empty override counts as missing.
    """
    fallback = F.lit(default).cast("string")
    value = fallback if override is None else F.coalesce(null_if_empty(override), fallback)
    return df.withColumn("service", value)


def stamp_source(df: DataFrame, default: str | None, component: str | None = None) -> DataFrame:
    """``source`` from the configured default, or, for logs, from the component first.

    Unlike a service, an empty component is kept as it is.
    """
    fallback = F.lit(default).cast("string")
    value = fallback if component is None else F.coalesce(F.col(component), fallback)
    return df.withColumn("source", value)


def stamp_session(
    df: DataFrame, call: str | None = None, process: str | Column | None = None, kind: str = "event"
) -> DataFrame:
    """``session_id``: the call's own, else the process's if there is one, else NULL.

    Identity events and metrics never carry a session.
    """
    if kind == "metric":
        return df.withColumn("session_id", F.lit(None).cast("string"))
    options = [F.col(call)] if call else []
    if process is not None:
        options.append(F.col(process) if isinstance(process, str) else process)
    value = F.coalesce(*options, F.lit(None)).cast("string")
    if kind == "event":
        value = F.when(F.col("event_type").isin(*NO_SESSION_TYPES), None).otherwise(value)
    return df.withColumn("session_id", value)


def decode_tenant_key(df: DataFrame, key: str = "api_key", out: str = "tenant") -> DataFrame:
    """32 hex characters to the 16-byte tenant; anything else is NULL (see ``validate_tenant_key``).

    The key is a credential, so the text column is dropped.
    """
    return df.withColumn(out, decode_key(key)).drop(*([key] if key != out else []))


def tenant_digest(df: DataFrame, tenant: str = "tenant", out: str = "tenant_id") -> DataFrame:
    """A SHA-256 of the tenant key, safe for paths and logs."""
    return df.withColumn(out, F.sha2(F.col(tenant).cast("binary"), 256))


def normalize_ts(df: DataFrame, kind: str, epoch: str = "timestamp", out: str = "ts") -> DataFrame:
    """Epoch milliseconds (events, logs) or nanoseconds (metrics) to a timestamp."""
    return df.withColumn(out, to_timestamp(epoch, kind))


def decode_enums(df: DataFrame) -> DataFrame:
    """Code columns to names. ``level`` keeps its code and gains ``level_name``."""
    columns = {}
    for enum in ENUMS:
        if enum in df.columns:
            columns["level_name" if enum == "level" else enum] = name_of(enum, enum)
    return df.withColumns(columns) if columns else df


def encode_enums(df: DataFrame) -> DataFrame:
    """Name columns to codes; ``level`` is taken from ``level_name``."""
    columns = {}
    for enum in ENUMS:
        source = "level_name" if enum == "level" else enum
        if source in df.columns:
            columns[enum] = code_of(enum, source)
    return df.withColumns(columns) if columns else df


def metric_defaults(df: DataFrame) -> DataFrame:
    """Temporality and value as the metric calls set them.

    A gauge is unspecified, a counter is delta unless stated, a histogram is cumulative with value 0.
    """
    kind = F.col("metric_type")
    given = F.col("temporality") if "temporality" in df.columns else F.lit(None).cast("string")
    temporality = (
        F.when(kind == "gauge", "unspecified")
        .when(kind == "counter", F.coalesce(given, F.lit("delta")))
        .when(kind == "histogram", "cumulative")
        .otherwise(F.coalesce(given, F.lit("unspecified")))
    )
    value = F.when(kind == "histogram", F.lit(0.0)).otherwise(F.col("value"))
    return df.withColumns({"temporality": temporality, "value": value})


def envelope_defaults(df: DataFrame) -> DataFrame:
    """Version 0 means the default version; batch id 0 means there is none."""
    version = F.coalesce(F.nullif(F.col("version"), F.lit(0)), F.lit(DEFAULT_VERSION)).cast("smallint")
    return df.withColumns({"version": version, "batch_id": F.nullif(F.col("batch_id"), F.lit(0))})


def canonical_labels(labels: str | Column) -> Column:
    """Labels as an array sorted by key, one entry per key, the last of equal keys winning."""
    c = F.col(labels) if isinstance(labels, str) else labels
    as_map = F.map_from_entries(F.coalesce(c, F.array().cast("array<struct<key:string,value:string>>")))
    return F.array_sort(F.map_entries(as_map))


def series_key(df: DataFrame, out: str = "series_key", max_bytes: int = 256) -> DataFrame:
    """Identity of a time series: name, source, service and the canonical labels.

    Readable JSON when short, a SHA-256 of it when long.
    """
    parts = {
        "name": F.col("name"),
        "source": F.col("source") if "source" in df.columns else F.lit(None).cast("string"),
        "service": F.col("service") if "service" in df.columns else F.lit(None).cast("string"),
        "labels": canonical_labels("labels") if "labels" in df.columns else F.array().cast(
            "array<struct<key:string,value:string>>"
        ),
    }
    text = F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()]))
    return df.withColumn(out, F.when(F.octet_length(text) <= max_bytes, text).otherwise(F.sha2(text, 256)))
