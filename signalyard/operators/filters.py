"""Row selection. Stateless; plain filters so that they reach the scan where the source allows it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.functions.enums import code_of
from signalyard.functions.payload import props_of
from signalyard.schemas import ENUMS, STANDARD_NAMES

COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def where_signal(
    df: DataFrame,
    event_type: str | Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    tenant: bytes | str | None = None,
    service: str | None = None,
    start=None,
    end=None,
    ts: str = "ts",
) -> DataFrame:
    """Basic selection; ``start`` is inclusive, ``end`` exclusive.

    If the table is partitioned by ``day`` (see ``write_signals``), a time range also bounds the day, so
    that whole folders are skipped.
    """
    if event_type is not None:
        kinds = [event_type] if isinstance(event_type, str) else list(event_type)
        df = df.filter(F.col("event_type").isin(*kinds))
    if names is not None:
        name = "event_name" if "event_name" in df.columns else "name"
        df = df.filter(F.col(name).isin(*names))
    if tenant is not None:
        df = df.filter(F.col("tenant") == F.lit(tenant))
    if service is not None:
        df = df.filter(F.col("service") == service)
    partitioned = "day" in df.columns
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start))
        if partitioned:
            df = df.filter(F.col("day") >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.filter(F.col(ts) < F.lit(end))
        if partitioned:
            df = df.filter(F.col("day") <= F.to_date(F.lit(end)))
    return df


def level_code(level: int | str) -> int:
    if isinstance(level, int):
        return level
    return {name: code for code, name in ENUMS["level"].items()}[level.lower()]


def min_severity(logs: DataFrame, level: int | str) -> DataFrame:
    """Logs at least as severe as ``level``; lower codes are more severe."""
    if "level" in logs.columns:
        return logs.filter(F.col("level") <= level_code(level))
    return logs.filter(code_of("level", "level_name") <= level_code(level))


def where_prop(df: DataFrame, key: str, op: str, value=None, payload: str = "payload") -> DataFrame:
    """Predicate on a property: a comparison, ``exists`` or ``missing``.

    The property is read as the type of ``value``; one that cannot be read so does not match.
    """
    prop = F.try_element_at(props_of(payload), F.lit(key))
    if op == "exists":
        return df.filter(prop.isNotNull())
    if op == "missing":
        return df.filter(prop.isNull())
    kind = "boolean" if isinstance(value, bool) else "double" if isinstance(value, (int, float)) else "string"
    return df.filter(COMPARE[op](F.try_variant_get(prop, "$", kind), F.lit(value).cast(kind)))


def where_label(metrics: DataFrame, key: str, op: str, value: str | None = None, labels: str = "labels"):
    """Label match: ``=``, ``!=``, ``regex``, ``exists`` or ``missing``.

    ``!=`` also holds for a series without the label.
    """

    def some(test: Callable[[Column], Column]) -> Column:
        present = F.coalesce(F.col(labels), F.array().cast("array<struct<key:string,value:string>>"))
        return F.exists(present, lambda l: (l["key"] == key) & test(l["value"]))

    conditions = {
        "=": lambda: some(lambda v: v == value),
        "!=": lambda: ~some(lambda v: v == value),
        "regex": lambda: some(lambda v: v.rlike(value)),
        "exists": lambda: some(lambda v: F.lit(True)),
        "missing": lambda: ~some(lambda v: F.lit(True)),
    }
    return metrics.filter(conditions[op]())


def standard_only(df: DataFrame, name: str = "event_name") -> DataFrame:
    """Rows whose name is one of the standard ones."""
    return df.filter(F.col(name).isin(*STANDARD_NAMES))


def custom_only(df: DataFrame, name: str = "event_name") -> DataFrame:
    """Rows with any other name; custom names are legal."""
    return df.filter(~F.col(name).isin(*STANDARD_NAMES))
