"""Which columns identify an actor and put its rows in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def with_tenant(df: DataFrame, *keys: str) -> list[str]:
    """The given keys, inside the tenant when the table has one."""
    return (["tenant"] if "tenant" in df.columns else []) + list(keys)


def row_order(df: DataFrame, order: Sequence[str] = ("ts", "seq")) -> list[str]:
    """The order columns the table has; ``ts`` alone when there is no tie-break.

    Landed rows get their tie-break from ``with_row_id``; without it, rows of one time are in no fixed order.
    """
    return [c for c in order if c in df.columns]
