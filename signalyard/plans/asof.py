"""As-of joins: one union, one ordered scan, no per-row range join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.plans.ordered import Ordered, last_seen, next_seen


def _side(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: int, name: str, tie_type: str
) -> DataFrame:
    tie = df[order[1]].cast(tie_type) if len(order) > 1 else F.lit(0).cast("bigint")
    return df.select(
        *[df[k] for k in keys],
        df[order[0]].alias("_at"),
        F.lit(rank).alias("_rank"),
        tie.alias("_tie"),
        F.struct(*df.columns).alias(name),
    )


def _union(
    left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str], ranks: tuple[int, int]
) -> DataFrame:
    """Both sides in one table; at equal times the side with the smaller rank comes first."""
    # Row ids of landed rows are text, sequence numbers are numbers.
    text = len(order) > 1 and "string" in (dict(left.dtypes)[order[1]], dict(right.dtypes)[order[1]])
    tie_type = "string" if text else "bigint"
    l = _side(left, keys, order, ranks[0], "_left", tie_type)
    r = _side(right, keys, order, ranks[1], "_right", tie_type)
    return l.unionByName(r, allowMissingColumns=True)


def _result(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    hit = rows.filter(F.col("_left").isNotNull())
    return hit.select("_left.*", *[F.col("_hit")[c].alias(c) for c in columns])


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] = ("ts", "seq"),
) -> DataFrame:
    """Each left row with ``columns`` of the latest right row at or before its time.

    ``order`` names the time column and, optionally, a tie-break among equal times of one side; a
    right row at the left row's own time counts as before it. Left rows without a match get NULL.
    """
    both = _union(left, right, keys, order, (1, 0))
    rows = Ordered.of(both, keys, ["_at", "_rank", "_tie"]).scan(_hit=last_seen("_right")).frame()
    return _result(rows, columns)


def asof_forward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] = ("ts", "seq"),
    inclusive: bool = True,
) -> DataFrame:
    """Each left row with ``columns`` of the earliest right row at or after its time.

    With ``inclusive=False`` a right row at exactly the left row's time does not count.
    """
    both = _union(left, right, keys, order, (0, 1) if inclusive else (1, 0))
    rows = Ordered.of(both, keys, ["_at", "_rank", "_tie"]).scan(_hit=next_seen("_right")).frame()
    return _result(rows, columns)
