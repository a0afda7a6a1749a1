"""Ordered scans per key that do not depend on a key fitting into one task.

``Ordered`` is a table with a key and a row order. ``scan`` adds columns computed along that
order: the previous row's value, a running sum, the last value seen, and so on. For ordinary keys
these are plain window functions, and consecutive scans share one exchange and one sort. Keys that
are too big for a task are cut into consecutive pieces by a range partitioning on (key, order);
each piece is scanned on its own and then receives what the pieces before (or after) it carry over.
The carried values are one row per piece.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from signalyard.plans.skew import hot_keys, same_key, split
from signalyard.session import durable

_CHUNK = "_chunk"
_UPTO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Scan:
    """One scanned column.

    within:   value inside a run of rows, given the ordered window
    digest:   what a whole piece passes on, given the order as a struct
    carry:    what reaches a piece from those before it, given the window over pieces
    join:     the final value from (within, carried, ordered window of the piece)
    backward: scan from the last row to the first; windows then run in descending order

    Only frames that start at the beginning of the window are used: Spark extends those row by row,
    while it computes frames that end at its end anew for every row.
    """

    within: Callable[[WindowSpec], Column]
    digest: Callable[[Column], Column]
    carry: Callable[[Column, WindowSpec], Column]
    join: Callable[[Column, Column, WindowSpec], Column]
    backward: bool = False


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def prev_row(value: str | Column) -> Scan:
    """The value in the row before (NULL in the first row)."""
    c = _col(value)
    return Scan(
        within=lambda w: F.lag(c).over(w),
        digest=lambda o: F.max_by(F.struct(c.alias("v")), o),
        carry=lambda d, w: F.lag(d).over(w),
        join=lambda v, carried, w: F.when(F.row_number().over(w) == 1, carried["v"]).otherwise(v),
    )


def next_row(value: str | Column) -> Scan:
    """The value in the row after (NULL in the last row)."""
    c = _col(value)
    return Scan(
        within=lambda w: F.lead(c).over(w),
        digest=lambda o: F.min_by(F.struct(c.alias("v")), o),
        carry=lambda d, w: F.lead(d).over(w),
        join=lambda v, carried, w: F.when(F.lead(F.lit(1)).over(w).isNull(), carried["v"]).otherwise(v),
    )


def last_seen(value: str | Column) -> Scan:
    """The latest non-NULL value up to and including this row."""
    c = _col(value)
    return Scan(
        within=lambda w: F.last(c, ignorenulls=True).over(w.rowsBetween(*_UPTO)),
        digest=lambda o: F.max_by(c, F.when(c.isNotNull(), o)),
        carry=lambda d, w: F.last(d, ignorenulls=True).over(w.rowsBetween(*_BEFORE)),
        join=lambda v, carried, w: F.coalesce(v, carried),
    )


def next_seen(value: str | Column) -> Scan:
    """The earliest non-NULL value strictly after this row."""
    c = _col(value)
    return Scan(
        within=lambda w: F.last(c, ignorenulls=True).over(w.rowsBetween(*_BEFORE)),
        digest=lambda o: F.min_by(c, F.when(c.isNotNull(), o)),
        carry=lambda d, w: F.last(d, ignorenulls=True).over(w.rowsBetween(*_BEFORE)),
        join=lambda v, carried, w: F.coalesce(v, carried),
        backward=True,
    )


def _fold(fn: Callable[[Column], Column], pick: Callable[[Column, Column], Column], backward: bool):
    def make(value: str | Column) -> Scan:
        c = _col(value)
        return Scan(
            within=lambda w: fn(c).over(w.rowsBetween(*_UPTO)),
            digest=lambda o: fn(c),
            carry=lambda d, w: fn(d).over(w.rowsBetween(*_BEFORE)),
            join=lambda v, carried, w: F.coalesce(pick(v, carried), v, carried),
            backward=backward,
        )

    return make


def _plus(a: Column, b: Column) -> Column:
    return a + b


# Over all rows up to this one, and over all rows from this one on.
running_sum = _fold(F.sum, _plus, backward=False)
running_min = _fold(F.min, F.least, backward=False)
running_max = _fold(F.max, F.greatest, backward=False)
suffix_sum = _fold(F.sum, _plus, backward=True)
suffix_min = _fold(F.min, F.least, backward=True)
suffix_max = _fold(F.max, F.greatest, backward=True)


def _window(keys: Sequence[str], order: Sequence[str], backward: bool) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*[F.desc(c) if backward else F.asc(c) for c in order])


@dataclass(frozen=True)
class Ordered:
    """Rows with a key and an order. Build with :meth:`of`, finish with :meth:`frame`."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cold: DataFrame
    hot: DataFrame | None = field(default=None)
    small: bool = True  # few hot keys

    @staticmethod
    def of(df: DataFrame, keys: Sequence[str], order: Sequence[str], check: bool = True) -> Ordered:
        """``order`` should break all ties, otherwise the order of tied rows is arbitrary.

        ``check=False`` is for callers that already know that no key is too big.
        """
        keys, order = tuple(keys), tuple(order)
        hot = hot_keys(df, keys) if check else None
        if hot is None:
            return Ordered(keys, order, df)
        cold, warm = split(df, hot)
        ranged = warm.repartitionByRange(hot.pieces, *keys, *order)
        # The piece numbers are sampled, so they are written down before two plans read them.
        return Ordered(keys, order, cold, durable(ranged.withColumn(_CHUNK, F.spark_partition_id())), hot.small)

    def with_columns(self, **columns: Column) -> Ordered:
        """Row-wise columns; keys and order must stay as they are."""
        return self._map(lambda df: df.withColumns(columns))

    def filter(self, condition: Column) -> Ordered:
        return self._map(lambda df: df.filter(condition))

    def _map(self, fn: Callable[[DataFrame], DataFrame]) -> Ordered:
        return Ordered(self.keys, self.order, fn(self.cold), None if self.hot is None else fn(self.hot), self.small)

    def scan(self, **scans: Scan) -> Ordered:
        """Add one column per scan."""
        def windows(keys: Sequence[str], order: Sequence[str]) -> dict[bool, WindowSpec]:
            return {back: _window(keys, order, back) for back in (False, True)}

        whole = windows(self.keys, self.order)
        cold = self.cold.withColumns({n: s.within(whole[s.backward]) for n, s in scans.items()})
        if self.hot is None:
            return Ordered(self.keys, self.order, cold)

        piece = (*self.keys, _CHUNK)
        order = F.struct(*self.order)
        digests = self.hot.groupBy(*piece).agg(*[s.digest(order).alias(n) for n, s in scans.items()])
        across = windows(self.keys, [_CHUNK])
        carried = digests.select(
            *piece, *[s.carry(F.col(n), across[s.backward]).alias(f"_carry_{n}") for n, s in scans.items()]
        )
        inside = windows(piece, self.order)
        local = self.hot.withColumns({f"_in_{n}": s.within(inside[s.backward]) for n, s in scans.items()})
        # One carried row per (hot key, piece): sent to all tasks only where the hot keys themselves were few.
        joined = local.join(F.broadcast(carried) if self.small else carried, same_key(local, carried, piece), "left")
        joined = joined.select(*[local[c] for c in local.columns], *[carried[f"_carry_{n}"] for n in scans])
        values = {
            n: s.join(F.col(f"_in_{n}"), F.col(f"_carry_{n}"), inside[s.backward]) for n, s in scans.items()
        }
        extra = [f"_{part}_{n}" for n in scans for part in ("in", "carry")]
        return Ordered(self.keys, self.order, cold, joined.withColumns(values).drop(*extra), self.small)

    def frame(self) -> DataFrame:
        """The rows as one DataFrame."""
        if self.hot is None:
            return self.cold
        return self.cold.unionByName(self.hot.drop(_CHUNK))
