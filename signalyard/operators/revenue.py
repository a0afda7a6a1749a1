"""Revenue. Amounts of different currencies are never added together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.functions.scalars import epoch_us
from signalyard.operators.keys import row_order, with_tenant
from signalyard.plans import Ordered, prev_row, running_sum


def revenue_summary(orders: DataFrame, by: Sequence[str] = (), amount: str = "amount", user: str = "user_id"):
    """Orders, revenue, average order value and paying users per currency (and ``by``).

    Summed per user first: the count of payers then needs no distinct set.
    """
    keys = [*by, "currency"]
    per_user = orders.groupBy(*keys, user).agg(F.count("*").alias("_n"), F.sum(amount).alias("_sum"))
    return per_user.groupBy(*keys).agg(
        F.sum("_n").alias("orders"),
        F.sum("_sum").alias("revenue"),
        (F.sum("_sum") / F.sum("_n")).alias("avg_order_value"),
        F.count(user).alias("payers"),
    )


def revenue_cube(orders: DataFrame, dims: Sequence[str], mode: str = "rollup", amount: str = "amount"):
    """Orders and revenue per currency over rollup, cube or explicit grouping sets of ``dims``.

    ``mode`` is ``rollup``, ``cube``, or a list of column lists. ``grouping_id`` has a bit per
    dimension, set when the dimension is summed over; the currency is always part of the group.
    """
    # The finest groups are built once; the coarser ones are sums of those.
    base = orders.groupBy("currency", *dims).agg(F.count("*").alias("_n"), F.sum(amount).alias("_sum"))
    totals = [F.sum("_n").alias("orders"), F.sum("_sum").alias("revenue")]
    if mode == "rollup":
        sets = [list(dims[:i]) for i in range(len(dims), -1, -1)]
    elif mode == "cube":
        sets = [[d for j, d in enumerate(dims) if not i >> (len(dims) - 1 - j) & 1] for i in range(2 ** len(dims))]
    else:
        sets = [list(s) for s in mode]
    grouped = base.groupingSets([[F.col("currency"), *map(F.col, s)] for s in sets], "currency", *dims)
    return grouped.agg(*totals, F.grouping_id("currency", *dims).cast("bigint").alias("grouping_id"))


def running_revenue(orders: DataFrame, amount: str = "amount", user: str = "user_id") -> DataFrame:
    """Each order with its number, the user's revenue so far, and the days since the order before.

    Per user and currency.
    """
    keys = with_tenant(orders, user, "currency")
    rows = (
        Ordered.of(orders, keys, row_order(orders))
        .scan(order_no=running_sum(F.lit(1)), revenue_to_date=running_sum(amount), _prev=prev_row("ts"))
        .frame()
    )
    days = (epoch_us("ts") - epoch_us("_prev")) / 86_400e6
    return rows.withColumn("days_since_previous", days).drop("_prev")
