"""Trailing aggregates over the last n rows or the last stretch of time of each key.

A sliding frame costs rows times frame length. Here the line of each key is cut into blocks as long as
the frame, so that every frame is the end of one block plus the start of the next: running values give
the start, suffix values of the block before give the end. The work is linear however long the frame
is, and a key with very many rows spreads over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.functions.scalars import epoch_us
from signalyard.plans.ordered import (
    Ordered,
    next_seen,
    running_max,
    running_min,
    running_sum,
    suffix_max,
    suffix_min,
    suffix_sum,
)
from signalyard.plans.skew import hot_keys

_UNITS_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}

# Cells per task, which sorts them four times over. Counted, since a task's bytes say little: such rows are small only when packed.
_TASK_CELLS = 500_000


def width_us(width: str) -> int:
    """A fixed interval such as ``10 minutes`` or ``1 day 2 hours`` in microseconds."""
    words = width.lower().split()
    return sum(int(float(n) * _UNITS_US[u.rstrip("s")]) for n, u in zip(words[::2], words[1::2], strict=True))


def _cell(value: Column) -> dict[str, Column]:
    """A single value as the sums a frame is made of."""
    number = value.cast("double")
    return {"_n": F.when(value.isNull(), 0).otherwise(1).cast("bigint"), "_s": number, "_lo": value, "_hi": value}


def _spread(df: DataFrame, rows: int, columns: Sequence[str]) -> DataFrame:
    """A table of more than one task's rows dealt out by ``columns``, else as it is."""
    return df if rows <= _TASK_CELLS else df.repartition(-(-rows // _TASK_CELLS), *columns)


def _trailing(cells: DataFrame, keys: Sequence[str], span: int, check: bool, most: int) -> DataFrame:
    """``_row`` of every cell with n, sum, min and max over the cells from ``_at - span`` to ``_at``.

    ``_at`` is a whole number, unique per key; null for rows without a time. There are at most ``most`` cells. Few are scanned
    where they lie, by key; more are spread over the blocks, so that a key's rows need not fit into one task.
    """
    width = F.lit(span)
    block = F.call_function("div", F.col("_at") - F.pmod("_at", width), width)
    inside = (
        Ordered.of(_spread(cells.withColumn("_block", block), most, [*keys, "_block"]), [*keys, "_block"], ["_at"], check)
        .scan(
            _rn=running_sum("_n"),
            _rs=running_sum("_s"),
            _rlo=running_min("_lo"),
            _rhi=running_max("_hi"),
            _fn=suffix_sum("_n"),
            _fs=suffix_sum("_s"),
            _flo=suffix_min("_lo"),
            _fhi=suffix_max("_hi"),
        )
        .frame()
    )
    # Each cell stays in its block as a possible frame start, and asks the block before for its own.
    start = F.struct("_row", "_rn", "_rs", "_rlo", "_rhi")
    end = F.struct("_fn", "_fs", "_flo", "_fhi")
    # Cells without a place are their own frame.
    is_end, no_start, no_end = F.col("_at").isNotNull(), F.when(F.lit(False), start), F.when(F.lit(False), end)
    both = F.array(
        F.struct(F.col("_block").alias("b"), F.col("_at").alias("at"), F.lit(1).alias("rank"), no_start.alias("start"), F.when(is_end, end).alias("end")),
        F.struct((F.col("_block") - 1).alias("b"), (F.col("_at") - width).alias("at"), F.lit(0).alias("rank"), F.when(F.lit(True), start).alias("start"), no_end.alias("end")),
    )
    line = inside.select(*keys, F.explode(both).alias("p")).select(
        *keys,
        F.col("p.b").alias("_block"),
        F.col("p.at").alias("_at"),
        F.col("p.rank").alias("_rank"),
        F.col("p.start").alias("_start"),
        F.col("p.end").alias("_end"),
    )
    found = (
        Ordered.of(_spread(line, 2 * most, [*keys, "_block"]), [*keys, "_block"], ["_at", "_rank"], check)
        .scan(_tail=next_seen("_end"))
        .filter(F.col("_start").isNotNull())
        .frame()
    )
    return found.select(
        *keys,
        "_start._row",
        (F.col("_start._rn") + F.coalesce("_tail._fn", F.lit(0))).alias("n"),
        F.coalesce(F.col("_start._rs") + F.col("_tail._fs"), "_start._rs", "_tail._fs").alias("sum"),
        F.least("_start._rlo", "_tail._flo").alias("min"),
        F.greatest("_start._rhi", "_tail._fhi").alias("max"),
    )


def trailing_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, value: str) -> DataFrame:
    """Every row with count, mean, min and max of ``value`` over it and the ``n - 1`` rows before it."""
    keys = list(keys)
    placed = Ordered.of(df, keys, order).scan(_at=running_sum(F.lit(1)))
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    cells = placed.frame().select(*keys, "_at", row.alias("_row"), *[c.alias(a) for a, c in _cell(F.col(value)).items()])
    if n == 1:
        result = cells.select(*keys, "_row", F.col("_n").alias("n"), F.col("_s").alias("sum"), F.col("_lo").alias("min"), F.col("_hi").alias("max"))
    else:
        result = _trailing(cells, keys, n - 1, check=placed.hot is not None, most=df.count())
    mean = F.col("sum") / F.nullif("n", F.lit(0))
    return result.select(*keys, "_row.*", "n", mean.alias("mean"), "min", "max").select(
        *df.columns, "n", "mean", "min", "max"
    )


def trailing_range(
    df: DataFrame, keys: Sequence[str], width: str, value: str | None = None, ts: str = "ts"
) -> DataFrame:
    """One row per key and time: n, sum, min and max of ``value`` from ``width`` before up to that time.

    Both ends are included. Without ``value`` rows are counted.
    """
    keys = list(keys)
    cell = _cell(F.lit(0) if value is None else F.col(value))
    rows = df.select(*keys, ts, epoch_us(ts).alias("_at"), *[c.alias(a) for a, c in cell.items()])
    big, most = hot_keys(rows, keys) is not None, rows.count()
    if keys and not big:
        # One exchange on the key serves the sums per time and everything after.
        rows = rows.repartition(*keys)
    moments = rows.groupBy(*keys, ts, "_at").agg(
        F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    cells = moments.select(*keys, "_at", F.struct(ts).alias("_row"), "_n", "_s", "_lo", "_hi")
    result = _trailing(cells, keys, width_us(width), check=big, most=most)
    return result.select(*keys, f"_row.{ts}", "n", "sum", "min", "max")
