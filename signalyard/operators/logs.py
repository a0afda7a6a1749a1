"""Log volumes and error shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.operators.events import time_bucket
from signalyard.schemas import ENUMS, ERROR_LEVEL


def _keys(by: Sequence[str], window: str | None) -> list:
    keys: list = list(by)
    if window:
        keys.append(time_bucket("ts", window).alias("window_start"))
    return keys


def log_counts(logs: DataFrame, by: Sequence[str] = ("service",), window: str | None = None) -> DataFrame:
    """Logs per group with one column per level."""
    levels = ENUMS["level"]
    return logs.groupBy(*_keys(by, window)).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("level") == code).alias(name) for code, name in levels.items()],
    )


def error_rate(logs: DataFrame, by: Sequence[str] = ("service",), window: str | None = None) -> DataFrame:
    """Share of logs at level error or more severe."""
    errors = F.count_if(F.col("level") <= ERROR_LEVEL)
    return logs.groupBy(*_keys(by, window)).agg(
        F.count("*").alias("n"), errors.alias("errors"), (errors / F.count("*")).alias("error_rate")
    )
