"""Building and reading property payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalyard.functions.payload import (
    PROPS_TYPE,
    as_props,
    finite_or_null,
    merge_properties,
    merged_map,
    props_of,
    typed_props,
)
from signalyard.schemas import CATEGORY_OF, ORDER_COMPLETED

__all__ = [
    "alias_payload",
    "event_category",
    "explode_props",
    "extract_props",
    "group_payload",
    "identify_payload",
    "log_payload",
    "merge_properties",
    "payload_size",
    "props_column",
    "revenue_payload",
    "track_payload",
]


def props_column(df: DataFrame, name: str) -> Column:
    """A column of any serializable shape as a property map; a column that is absent adds nothing.

    JSON text, structs, maps and variants are all accepted.
    """
    if name not in df.columns:
        return F.lit(None).cast(PROPS_TYPE)
    kind = df.schema[name].dataType
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.VariantType):
        return df[name]
    if isinstance(kind, T.StringType):
        return props_of(df[name])
    return props_of(F.to_json(df[name]))


def _payload(df: DataFrame, out: str, reserved: dict[str, Column], super_props: str | None, props: str):
    sources = [as_props(reserved), props_column(df, props)]
    if super_props is not None and super_props in df.columns:
        sources.insert(0, props_column(df, super_props))
    return df.withColumn(out, F.to_json(merged_map(*sources)))


def track_payload(df: DataFrame, props: str = "props", super_props: str = "super_props", out: str = "payload"):
    """Super properties, then ``user_id``, then the call's own properties."""
    return _payload(df, out, {"user_id": F.col("user_id")}, super_props, props)


def identify_payload(df: DataFrame, traits: str = "traits", out: str = "payload") -> DataFrame:
    """``user_id`` and the traits, flat. Super properties never apply here."""
    return _payload(df, out, {"user_id": F.col("user_id")}, None, traits)


def group_payload(df: DataFrame, props: str = "props", super_props: str = "super_props", out: str = "payload"):
    """Super properties, then ``group_id`` and ``user_id``, then the call's own properties."""
    reserved = {"group_id": F.col("group_id"), "user_id": F.col("user_id")}
    return _payload(df, out, reserved, super_props, props)


def revenue_payload(df: DataFrame, props: str = "props", super_props: str = "super_props", out: str = "payload"):
    """A track row named ``Order Completed`` with the order's fields in the payload."""
    reserved = {
        "user_id": F.col("user_id"),
        "amount": finite_or_null("amount"),
        "currency": F.col("currency"),
        "order_id": F.col("order_id"),
    }
    named = df.withColumns({"event_type": F.lit("track"), "event_name": F.lit(ORDER_COMPLETED)})
    return _payload(named, out, reserved, super_props, props)


def alias_payload(df: DataFrame, out: str = "payload") -> DataFrame:
    """``previous_id`` and ``user_id``, nothing else."""
    return df.withColumn(out, F.to_json(F.struct("previous_id", "user_id"), {"ignoreNullFields": "false"}))


def log_payload(df: DataFrame, data: str = "data", out: str = "payload") -> DataFrame:
    """``message`` and the log's data, flat."""
    return _payload(df, out, {"message": F.col("message")}, None, data)


def extract_props(df: DataFrame, ddl: str, payload: str = "payload") -> DataFrame:
    """Typed columns out of the payload; fields that are missing or of another type are NULL."""
    return df.withColumn("_typed", typed_props(payload, ddl)).select(*df.columns, "_typed.*")


def explode_props(df: DataFrame, ids: list[str], payload: str = "payload") -> DataFrame:
    """Long form: one row per property with its value as text and its JSON type."""
    pairs = df.select(*ids, F.explode(merged_map(props_of(payload))).alias("key", "_value"))
    text = F.when(~F.is_variant_null("_value"), F.coalesce(F.try_variant_get("_value", "$", "string"), F.to_json("_value")))
    kind = F.schema_of_variant("_value")
    json_type = (
        F.when(kind == "VOID", "null")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .otherwise("number")
    )
    return pairs.select(*ids, "key", text.alias("value"), json_type.alias("json_type"))


def event_category(df: DataFrame, name: str = "event_name", out: str = "category") -> DataFrame:
    """Category of a standard name, else ``custom``. The 44 names are a literal map, not a join."""
    table = F.create_map(*[F.lit(x) for pair in CATEGORY_OF.items() for x in pair])
    return df.withColumn(out, F.coalesce(F.try_element_at(table, F.col(name)), F.lit("custom")))


# Fixed sizes of an encoded event: root offset, field table, record and the closing slack, and what
# each variable field adds on top of its bytes.
_EVENT_FIXED = 4 + 18 + 36 + 16
_ID_SIZE = 4 + 16


def payload_size(df: DataFrame) -> DataFrame:
    """``payload_bytes`` and ``wire_bytes`` (the size estimate of the encoded event)."""

    def present(column: str, size: Column | int) -> Column:
        if column not in df.columns:
            return F.lit(0)
        return F.when(df[column].isNull(), 0).otherwise(size)

    def length(column: str) -> Column | int:
        return F.octet_length(column) if column in df.columns else 0

    wire = (
        F.lit(_EVENT_FIXED)
        + present("device_id", _ID_SIZE)
        + present("session_id", _ID_SIZE)
        + present("service", length("service") + 5)
        + present("event_name", length("event_name") + 5)
        + present("payload", length("payload") + 4)
    )
    payload_bytes = F.coalesce(F.octet_length("payload"), F.lit(0)) if "payload" in df.columns else F.lit(0)
    return df.withColumns({"payload_bytes": payload_bytes.cast("bigint"), "wire_bytes": wire.cast("bigint")})
