"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workloads.tables import Tables, view_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "", recursive: bool = False):
    """Register a query. ``sql`` starts with SELECT, or with ``, name AS (...)`` for further CTEs."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            if views:
                head = "WITH RECURSIVE " if recursive else "WITH "
                ORACLES[name] = f"{head}{view_ctes(*views.split())} {sql.strip()}"
            else:
                ORACLES[name] = sql.strip()
        return fn

    return register


def us(column: str | Column) -> Column:
    """A time as microseconds since the epoch, the form all results show times in."""
    c = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(c.cast("timestamp"))


def day_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def num(column: str | Column, digits: int = 6) -> Column:
    """A double rounded for comparison: the order of additions differs between engines."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c.cast("double"), digits)


def big(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("bigint")
