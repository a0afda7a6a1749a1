"""Writes along a space-filling curve, so that a filter on any of several columns skips files and row groups.

Each column is cut into ranges of about equally many rows; the bits of a row's range numbers, interleaved, are its place on
the curve. Files hold stretches of the curve, and the footers' least and greatest values do the pruning: readers need nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalyard.plans import Ordered, running_sum
from signalyard.sources.sinks import ROWS_PER_FILE

# Bounds of texts are cut to this many characters, so that a list of them stays small.
_BOUND_CHARS = 128


def _text_bounds(df: DataFrame, column: str, n_rows: int, ranges: int) -> list:
    """Greatest value of each range but the last, from the counts of all distinct values."""
    counts = df.select(F.substring(column, 1, _BOUND_CHARS).alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
    upto = Ordered.of(counts, [], ["v"]).scan(upto=running_sum("n")).frame()
    number = F.floor((F.col("upto") - 1) * ranges / F.lit(n_rows))
    bounds = upto.groupBy(number.alias("number")).agg(F.max("v").alias("bound")).collect()  # at most ``ranges`` rows
    return sorted(r["bound"] for r in bounds)[:-1]


def range_bounds(df: DataFrame, by: Sequence[str], ranges: int) -> tuple[int, dict[str, list]]:
    """Rows of the table, and per column the values that cut it into at most ``ranges`` ranges.

    All rows count: numbers and times by mergeable percentile summaries in one pass, texts by the counts of their values.
    """
    texts = [c for c in by if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))]
    others = [c for c in by if c not in texts]
    cuts = [k / ranges for k in range(1, ranges)]
    summed = df.agg(F.count("*").alias("_rows"), *[F.percentile_approx(c, cuts, 100 * ranges).alias(f"_{k}") for k, c in enumerate(others)]).first()
    n_rows = summed[0]
    found = {c: sorted(set(summed[f"_{k}"] or [])) for k, c in enumerate(others)}
    for c in texts:
        found[c] = _text_bounds(df, c, n_rows, ranges)
    return n_rows, found


def _number(column: Column, bounds: list, kind: T.DataType, lo: int = 0, hi: int | None = None) -> Column:
    """How many bounds lie below the value, by binary search; nulls come last."""
    hi = len(bounds) if hi is None else hi
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    below = _number(column, bounds, kind, lo, mid)
    return F.when(column <= F.lit(bounds[mid]).cast(kind), below).otherwise(_number(column, bounds, kind, mid + 1, hi))


def with_curve(df: DataFrame, by: Sequence[str], bounds: dict[str, list], bits: int, out: str) -> DataFrame:
    """A column ``out`` with the place on the curve: the bits of the columns' range numbers in turn, the highest first."""
    numbers = {f"{out}_{j}": _number(F.col(c), bounds[c], df.schema[c].dataType).cast("bigint") for j, c in enumerate(by)}
    place = F.lit(0).cast("bigint")
    for j, number in enumerate(numbers):
        for bit in range(bits):
            moved = F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), bit * len(by) + len(by) - 1 - j)
            place = place.bitwiseOR(moved)
    return df.withColumns(numbers).withColumn(out, place).drop(*numbers)


def write_clustered(
    df: DataFrame, path: str, by: Sequence[str], rows_per_file: int = ROWS_PER_FILE, bits: int = 6, mode: str = "append"
) -> None:
    """Write ``df`` as Parquet in files of about ``rows_per_file`` rows, clustered by all of ``by`` alike.

    Each column is cut into 2^``bits`` ranges. One place on the curve with very many rows (a hot tenant in one hour) is cut further by
    the columns' values and a hash of the row, so no task gets more than its share unless rows are equal. Rows with nulls
    in a column are its last range; an empty table is an empty write. The input is read for the bounds, for the ranges of
    the shuffle and for the write: write expensive input first. Times prune only where they are written as 64-bit numbers, as
    ``session.configure`` sets it; 96-bit times have no least and greatest value in the footers.
    """
    by = list(by)
    if not by or bits < 1 or bits * len(by) > 62:
        raise ValueError("give at least one column, and at most 62 bits for all columns")
    bad = [c for c in by if not isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))]
    if bad:
        raise ValueError(f"columns {bad} have no order on a curve")
    n_rows, bounds = range_bounds(df, by, 1 << bits)
    hashed = [c.name for c in df.schema.fields if not isinstance(c.dataType, (T.MapType, T.VariantType))]
    out = "_curve"
    while any(c.lower().startswith(out) for c in df.columns):
        out = "_" + out
    files = max(1, -(-n_rows // rows_per_file))
    placed = with_curve(df, by, bounds, bits, out)
    dealt = placed.repartitionByRange(files, out, *by, F.xxhash64(*hashed)).sortWithinPartitions(out, *by).drop(out)
    dealt.write.mode(mode).option("maxRecordsPerFile", 2 * rows_per_file).parquet(path)
