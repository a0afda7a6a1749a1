"""Finding keys that are too big for one task, and joining around them.

A hot key is one with more rows, or more bytes of text, than a task should take: a fixed target that depends
neither on the size of the table nor on the number of partitions, and never on an estimate. No key has more rows or bytes than
the table, so the table is counted first, without a shuffle; only beyond a limit are rows counted per key, combined on the map side. At most ``_COLLECTED`` hot keys are collected and broadcast; a longer list is written down and joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalyard.session import durable

# What one task handles comfortably; no key below both is ever called hot.
HOT_ROWS_CONF, HOT_ROWS_DEFAULT = "signalyard.hotKeyRows", 2_000_000
HOT_BYTES_CONF, HOT_BYTES_DEFAULT = "signalyard.hotKeyBytes", 512 * 1024 * 1024
# Hot keys that may travel through the driver; more of them stay in a table.
_COLLECTED = 10_000


@dataclass(frozen=True)
class HotKeys:
    """The hot keys of a table, how many rows they hold, and a fair number of pieces for them."""

    keys: tuple[str, ...]
    table: DataFrame
    rows: int
    pieces: int
    small: bool = True  # short enough to broadcast


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on every key: a NULL key is a group like any other."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys], F.lit(True))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> HotKeys | None:
    """Keys of ``df`` that must be split, or None when an ordinary shuffle is fine: one counting job, or two for a large table."""
    spark = df.sparkSession
    most_rows = int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))
    most_bytes = int(spark.conf.get(HOT_BYTES_CONF, str(HOT_BYTES_DEFAULT)))
    long = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in long), F.lit(0)).cast("bigint")
    total = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    if total["rows"] <= most_rows and total["bytes"] <= most_bytes:
        return None
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"), F.sum(size).alias("_bytes"))
    pieces = F.greatest(F.ceil(F.col("_rows") / most_rows), F.ceil(F.col("_bytes") / most_bytes)).cast("bigint")
    big = counts.filter((F.col("_rows") > most_rows) | (F.col("_bytes") > most_bytes)).withColumn("_pieces", pieces)
    found = big.limit(_COLLECTED + 1).collect()
    if not found:
        return None
    if len(found) <= _COLLECTED:
        table = spark.createDataFrame(found, big.schema)
        rows, n = sum(r["_rows"] for r in found), sum(r["_pieces"] for r in found)
    else:
        table = durable(big)
        rows, n = table.agg(F.sum("_rows"), F.sum("_pieces")).first()
    return HotKeys(tuple(keys), table.select(*keys), rows, len(found) + n, len(found) <= _COLLECTED)


def split(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys); both are map-side filters."""
    if not hot.keys:  # the whole table is one group
        return df.filter(F.lit(False)), df
    small = F.broadcast(hot.table) if hot.small else hot.table
    on = same_key(df, hot.table, hot.keys)
    return df.join(small, on, "left_anti"), df.join(small, on, "left_semi")


def lookup(
    df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", hot: HotKeys | None = None
) -> DataFrame:
    """Join ``df`` to ``table``, which has one row per key, without sending a hot key to one task.

    Ordinary keys take the join Spark picks. Rows of a hot key stay where they are and meet the
    table's rows for the hot keys, which are no more than the hot keys themselves.
    """
    keys = list(keys)
    hot = hot or hot_keys(df, keys)
    if hot is None:
        return df.join(table, keys, how)
    cold_rows, hot_rows = split(df, hot)
    _, hot_table = split(table, hot)
    return cold_rows.join(table, keys, how).unionByName(hot_rows.join(F.broadcast(hot_table) if hot.small else hot_table, keys, how))
