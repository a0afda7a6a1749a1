"""Sorts, limits and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalyard.operators.keys import row_order
from signalyard.plans import Ordered, last_seen, prev_row, running_sum, suffix_sum

# Up to this many rows per group Spark itself limits each group before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000


def timeline(df: DataFrame, order: Sequence[str] = ("ts", "event_type", "seq"), within: bool = False) -> DataFrame:
    """Order by time, then type, then tie-break; arrival order is not time order.

    ``within`` sorts inside partitions only, which is what a file sink needs.
    """
    columns = [c for c in order if c in df.columns]
    return df.sortWithinPartitions(*columns) if within else df.orderBy(*columns)


def first_n(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows per key, numbered from 1 in ``_rn``."""
    if n > _GROUP_LIMIT:
        return Ordered.of(df, keys, order).scan(_rn=running_sum(F.lit(1))).frame().filter(F.col("_rn") <= n)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n)


def latest_n(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str] | None = None) -> DataFrame:
    """The most recent ``n`` rows per key."""
    order = list(order or row_order(df))
    if n > _GROUP_LIMIT:
        return Ordered.of(df, keys, order).scan(_rn=suffix_sum(F.lit(1))).frame().filter(F.col("_rn") <= n).drop("_rn")
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def top_k(df: DataFrame, by: str, k: int, groups: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent values of ``by``, overall or per group; equal counts go by value."""
    counts = df.groupBy(*groups, by).agg(F.count("*").alias("n"))
    if not groups:
        return counts.orderBy(F.desc("n"), by).limit(k)
    order = counts.withColumn("_neg", -F.col("n"))
    return first_n(order, groups, k, ["_neg", by]).select(*groups, by, "n", F.col("_rn").alias("rank"))


def rank_users(df: DataFrame, metric: str, by: Sequence[str] = (), user: str = "user_id", tiles: int = 4) -> DataFrame:
    """Rank, dense rank, percent rank and tile of users by a metric, highest first.

    ``df`` has one row per user (and group). Users with equal metric share a rank; tiles break ties by
    user. A group of any size is ranked in pieces, so ``by`` may be empty.
    """
    rows = (
        Ordered.of(df.withColumn("_neg", -F.col(metric)), list(by), ["_neg", user])
        .scan(_no=running_sum(F.lit(1)), _left=suffix_sum(F.lit(1)), _prev=prev_row(F.struct(F.col(metric).alias("v"))))
        .with_columns(_new=F.col("_prev").isNull() | ~F.equal_null("_prev.v", F.col(metric)))
        .with_columns(_start=F.when(F.col("_new"), F.col("_no")), _one=F.col("_new").cast("int"))
        .scan(rank=last_seen("_start"), dense_rank=running_sum("_one"))
        .frame()
    )
    total = F.col("_no") + F.col("_left") - 1
    size, more = F.call_function("div", total, F.lit(tiles)), F.pmod(total, F.lit(tiles))
    big = more * (size + 1)
    small_tile = more + F.ceil((F.col("_no") - big) / F.nullif(size, F.lit(0)))
    tile = F.when(F.col("_no") <= big, F.ceil(F.col("_no") / (size + 1))).otherwise(small_tile)
    percent = F.when(total == 1, F.lit(0.0)).otherwise((F.col("rank") - 1) / (total - 1))
    return rows.withColumns({"percent_rank": percent, "tile": tile}).drop(
        "_neg", "_no", "_left", "_prev", "_new", "_start", "_one"
    )
