"""A stored history of attributes: which values were valid from when to when, kept up by changes that may be late.

A change opens an interval that ends with the next change of its key. Late changes only ever cut intervals, so an interval's newest
row is the one with the least end; rows are added by version and none is rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalyard.plans import Ordered, asof_backward, next_row
from signalyard.plans.skew import same_key
from signalyard.session import durable
from signalyard.sources.versions import VersionedTable

_NEVER = "TIMESTAMP '9999-12-31 00:00:00'"


class ValidityTable:
    """Intervals of ``values`` per key in one folder. ``ddl`` gives the types of keys and values."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], values: dict[str, str], buckets: int = 64) -> None:
        self._table = VersionedTable(spark, path, buckets)
        self.keys, self.values = list(keys), list(values)
        fields = ", ".join(f"`{n}` {t}" for n, t in {**keys, **values}.items())
        self._ddl = f"{fields}, valid_from timestamp, seq long, valid_to timestamp"

    def versions(self) -> DataFrame | None:
        return self._table.versions()

    def _columns(self) -> list[str]:
        return [*self.keys, *self.values, "valid_from", "seq", "valid_to"]

    def intervals(self, version: int | None = None, near: DataFrame | None = None) -> DataFrame:
        """One row per change with [valid_from, valid_to) as of a version; ``near`` limits what is read to the keys of its rows."""
        buckets = None if near is None else self._table.touched(near, *self.keys)
        rows = self._table.read("rows", self._ddl, version, buckets)
        if near is not None:
            wanted = near.select(*self.keys).distinct()
            rows = rows.join(wanted, same_key(rows, wanted, self.keys), "left_semi")
        held = F.max(F.struct(*self.values)).alias("_v")
        found = rows.groupBy(*self.keys, "valid_from", "seq").agg(F.min("valid_to").alias("valid_to"), held)
        return found.select(*self.keys, *[F.col("_v")[v].alias(v) for v in self.values], "valid_from", "seq", "valid_to")

    def fold(self, changes: DataFrame, version: int | None = None, note: str = "") -> int:
        """Add changes (keys, values, ts, seq) as a version; what is read and written are keys that changed.

        A change is known by its key, ts and seq: known ones keep their values, and of several new ones the greatest values stay. A
        version that was written before is replaced. Not for two writers at once.
        """
        version = self._table.newest() + 1 if version is None else version
        place = [*self.keys, F.col("ts").alias("valid_from"), F.col("seq").cast("long").alias("seq")]
        one = changes.groupBy(*place).agg(F.max(F.struct(*self.values)).alias("_v"))
        values = [F.col("_v")[v].alias(v) for v in self.values]
        new = durable(one.select(*self.keys, *values, "valid_from", "seq", F.lit(None).cast("timestamp").alias("valid_to")))
        known = durable(self.intervals(version - 1, new))
        unknown = new.join(known, same_key(new, known, [*self.keys, "valid_from", "seq"]), "left_anti")
        line = known.withColumn("_known", F.lit(True)).unionByName(unknown.withColumn("_known", F.lit(False)))
        ended = Ordered.of(line, self.keys, ["valid_from", "seq"]).scan(_next=next_row("valid_from")).frame()
        until = F.coalesce("_next", F.expr(_NEVER))
        changed = ended.filter(~F.col("_known") | (F.col("valid_to") != until)).withColumn("valid_to", until)
        rows = durable(changed.select(*self._columns()))
        self._table.add(version, {"rows": (rows, self.keys)}, note)
        return version

    def at_time(self, events: DataFrame, order: Sequence[str] = ("ts", "seq"), version: int | None = None) -> DataFrame:
        """Events with the values valid at their time, null where none were; a change at the event's own time counts."""
        history = self.intervals(version, events).filter("valid_from < valid_to")
        # Written down: the scan counts its rows, and those of its keys, before it runs.
        held = durable(history.select(
            *self.keys, F.col("valid_from").alias(order[0]), *([F.col("seq").alias(order[1])] if len(order) > 1 else []), *self.values
        ))
        return asof_backward(events, held, self.keys, self.values, order)
