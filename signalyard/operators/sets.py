"""Set operations over users and signals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.operators.keys import with_tenant


def unified_timeline(
    events: DataFrame | None = None, logs: DataFrame | None = None, metrics: DataFrame | None = None
) -> DataFrame:
    """All three signals in one table with a ``kind`` column; fields a signal lacks are NULL."""
    parts = {"event": events, "log": logs, "metric": metrics}
    tables = [df.withColumn("kind", F.lit(kind)) for kind, df in parts.items() if df is not None]
    if not tables:
        raise ValueError("no signals given")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _users(df: DataFrame, user: str) -> DataFrame:
    return df.select(*with_tenant(df, user))


def users_in_both(a: DataFrame, b: DataFrame, user: str = "user_id") -> DataFrame:
    """Users in both periods or segments."""
    return _users(a, user).intersect(_users(b, user))


def users_lost(a: DataFrame, b: DataFrame, user: str = "user_id") -> DataFrame:
    """Users in the first but not in the second."""
    return _users(a, user).subtract(_users(b, user))


def mixed_metrics(*metrics: DataFrame) -> DataFrame:
    """Gauges, counters and histograms in one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), metrics)
