"""Batches as they are delivered: packing, redelivery, gaps, byte budgets.

Delivery is best effort: frames can be lost, repeated and reordered, and there is no event id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalyard.operators.events import time_bucket
from signalyard.operators.keys import row_order, with_tenant
from signalyard.plans import Ordered, next_row, prev_row, running_sum, suffix_sum
from signalyard.schemas import FRAME_OVERHEAD

__all__ = [
    "batch_gaps",
    "dedupe_batches",
    "dedupe_exact",
    "frame_bytes",
    "pack_batches",
    "retain_newest_bytes",
    "route_by_schema",
    "row_digest",
    "unpack_batches",
    "with_row_id",
]

# The default text of a time stops at milliseconds.
_EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Equal rows that are numbered from one array.
_REPEATS = 65_536


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the row as JSON, times to the microsecond; 64-bit hashes would collide at this scale."""
    return F.sha2(F.to_json(F.struct(*columns), _EXACT_TIMES), 256)


def with_row_id(df: DataFrame, out: str = "seq") -> DataFrame:
    """Landed rows with an identity: the digest of the row and a number among equal rows, as text.

    The wire carries none, and ordered operators need it to break ties the same way on every run. Equal rows are counted
    on the map side and laid out again, so a row repeated very often is no hot key. A column called ``out`` is replaced.
    (Batch only.)
    """
    columns = [c for c in df.columns if c != out]
    counted = df.groupBy(row_digest(columns).alias("_digest")).agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*columns)).alias("_row")
    ).select("_row.*", "_digest", "_n")
    # Two steps keep the arrays short however often a row repeats.
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_n - 1) DIV {_REPEATS}"))))
    last = F.least(F.col("_n") - 1, (F.col("_block") + 1) * _REPEATS - 1)
    laid_out = blocks.withColumn("_number", F.explode(F.sequence(F.col("_block") * _REPEATS, last)))
    return laid_out.select(*columns, F.concat_ws("-", "_digest", F.lpad(F.col("_number").cast("string"), 12, "0")).alias(out))


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    return True


def dedupe_exact(df: DataFrame, columns: Sequence[str] | None = None, wide: bool = False) -> DataFrame:
    """Keep one of each set of equal rows (equal in ``columns`` when given).

    Copies meet on the map side first, so a row with very many copies is no hot spot. ``wide`` compares
    a digest instead of the columns; tables with maps or variants always do.
    """
    columns = list(columns or df.columns)
    if wide or not all(_comparable(df.schema[c].dataType) for c in columns):
        return df.withColumn("_digest", row_digest(columns)).dropDuplicates(["_digest"]).drop("_digest")
    return df.dropDuplicates(columns)


def dedupe_batches(batches: DataFrame) -> DataFrame:
    """Keep one of each redelivered batch: same tenant, type, id and content.

    The id alone is not enough, it starts again with every process.
    """
    keys = with_tenant(batches, "schema_type", "batch_id")
    return (
        batches.withColumn("_digest", F.sha2(F.to_json("data", _EXACT_TIMES), 256))
        .dropDuplicates([*keys, "_digest"])
        .drop("_digest")
    )


def batch_gaps(batches: DataFrame, order: Sequence[str] = ("ts", "batch_id")) -> DataFrame:
    """Missing id ranges per tenant and process run.

    Ids count up through all signal types of one process; a smaller id later means that the process
    restarted and a new run begins.
    """
    keys = with_tenant(batches)
    arrived = batches.select(*keys, *order).distinct()
    runs = (
        Ordered.of(arrived, keys, list(order))
        .scan(_prev=prev_row("batch_id"))
        .with_columns(_restart=F.when(F.col("batch_id") < F.col("_prev"), 1).otherwise(0))
        .scan(run=running_sum("_restart"))
        .frame()
    )
    ids = runs.select(*keys, "run", "batch_id").distinct()
    pairs = Ordered.of(ids, [*keys, "run"], ["batch_id"]).scan(_next=next_row("batch_id")).frame()
    return pairs.filter(F.col("_next") - F.col("batch_id") > 1).select(
        *keys,
        "run",
        (F.col("batch_id") + 1).alias("missing_from"),
        (F.col("_next") - 1).alias("missing_to"),
        (F.col("_next") - F.col("batch_id") - 1).alias("n_missing"),
    )


def pack_batches(
    signals: DataFrame, schema_type: str, batch_size: int = 100, flush_interval: str = "10 seconds"
) -> DataFrame:
    """Group signals per tenant into batches of at most ``batch_size`` rows and one flush interval.

    Batch ids count up from 1 per tenant in time order. Rows are placed by their position within the
    interval, so a busy interval is split over many tasks and no array exceeds ``batch_size``.
    """
    scope = with_tenant(signals)
    order = row_order(signals)
    fields = [c for c in signals.columns if c not in scope]
    stamped = signals.withColumn("_flush", time_bucket("ts", flush_interval))
    placed = (
        Ordered.of(stamped, [*scope, "_flush"], order)
        .scan(_pos=running_sum(F.lit(1)))
        .frame()
        .withColumn("_part", F.call_function("div", F.col("_pos") - 1, F.lit(batch_size)))
    )
    batches = placed.groupBy(*scope, "_flush", "_part").agg(
        F.array_sort(F.collect_list(F.struct("_pos", F.struct(*fields).alias("_signal")))).alias("_rows")
    )
    # Ids come from counts per interval, so that no signal goes through the task that numbers a tenant's batches.
    at = [*scope, "_flush"]
    counted = stamped.groupBy(*at).agg(F.call_function("div", F.count("*") + (batch_size - 1), F.lit(batch_size)).alias("_parts"))
    upto = Ordered.of(counted, scope, ["_flush"]).scan(_upto=running_sum("_parts")).frame()
    before = upto.select(*[F.col(c).alias(f"_at_{c}") for c in at], (F.col("_upto") - F.col("_parts")).alias("_before"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in at])
    numbered = batches.join(before, same).withColumn("batch_id", F.col("_before") + F.col("_part") + 1)
    return numbered.select(
        *scope,
        F.lit(schema_type).alias("schema_type"),
        F.lit(100).cast("smallint").alias("version"),
        "batch_id",
        F.transform("_rows", lambda r: r["_signal"]).alias("data"),
    )


def unpack_batches(batches: DataFrame) -> DataFrame:
    """One row per signal, with the envelope's tenant, type, version, batch id and the position."""
    envelope = [c for c in batches.columns if c != "data"]
    item = batches.schema["data"].dataType.elementType
    inner = [F.col(f"_signal.{f.name}").alias(f.name) for f in item.fields if f.name not in envelope]
    return batches.select(*envelope, F.posexplode("data").alias("position", "_signal")).select(
        *envelope, "position", *inner
    )


def route_by_schema(batches: DataFrame, schema_type: str = "schema_type") -> dict[str, DataFrame]:
    """Batches split into ``event``, ``log``, ``metric``, and ``quarantine`` for any other type."""
    kind = F.col(schema_type)
    routes = {name: batches.filter(kind == name) for name in ("event", "log", "metric")}
    routes["quarantine"] = batches.filter(kind.isNull() | ~kind.isin(*routes))
    return routes


def frame_bytes(column: str) -> Column:
    """Bytes a frame's body takes."""
    return F.octet_length(column).cast("bigint")


def retain_newest_bytes(
    df: DataFrame,
    max_bytes: int,
    size: Column | str,
    by: Sequence[str] | None = None,
    order: Sequence[str] = ("ts", "seq"),
    overhead: int = FRAME_OVERHEAD,
) -> DataFrame:
    """First in, first out retention within a byte budget per tenant (or ``by``).

    Keeps the longest newest-first run of whole frames whose sizes plus ``overhead`` fit in
    ``max_bytes``; the newest frame stays even if it alone is too big. (Batch only.)
    """
    keys = with_tenant(df) if by is None else list(by)
    cost = (F.col(size) if isinstance(size, str) else size) + F.lit(overhead)
    return (
        Ordered.of(df.withColumn("_cost", cost.cast("bigint")), keys, row_order(df, order))
        .scan(_newer=suffix_sum("_cost"))
        .with_columns(_is_newest=F.col("_newer") == F.col("_cost"))
        .filter((F.col("_newer") <= max_bytes) | F.col("_is_newest"))
        .frame()
        .drop("_cost", "_newer", "_is_newest")
    )
