"""Daily totals kept up as batches arrive: event counts and net revenue.

A table remembers what tells repeats apart (row ids by day, the standing row of every order, refunds seen), and keeps totals as
differences: a batch writes rows for the days it changes only, and a day's total is the sum of its rows over all versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalyard.operators.delivery import row_digest
from signalyard.operators.keys import with_tenant
from signalyard.session import durable
from signalyard.sources.versions import VersionedTable


def _same(keys: Sequence[str]) -> Column:
    """Equal keys of two tables with the aliases l and r; a null equals a null."""
    return F.expr(" AND ".join(f"l.`{k}` <=> r.`{k}`" for k in keys))


class _Maintained:
    def __init__(self, spark: SparkSession, path: str, tenant: str | None, buckets: int) -> None:
        self._table = VersionedTable(spark, path, buckets)
        self._scope = ["tenant"] if tenant else []
        self._scope_ddl = f"tenant {tenant}, " if tenant else ""

    def versions(self) -> DataFrame | None:
        return self._table.versions()

    def _begin(self, df: DataFrame, version: int | None) -> int:
        if with_tenant(df) != self._scope:
            raise ValueError(f"the table has the scope {self._scope}, the rows have {with_tenant(df)}")
        return self._table.newest() + 1 if version is None else version


class DailyCounts(_Maintained):
    """Events per day and ``by`` (names and types). ``tenant`` is the type of the tenant column, where events belong to tenants."""

    def __init__(
        self, spark: SparkSession, path: str, by: dict[str, str], row_id: str = "seq", tenant: str | None = None, buckets: int = 64
    ) -> None:
        super().__init__(spark, path, tenant, buckets)
        self._by, self._row_id = list(by), row_id
        self._by_ddl = "".join(f"{name} {kind}, " for name, kind in by.items())

    def fold(self, events: DataFrame, version: int | None = None) -> int:
        """Add a batch; rows whose id was seen on their day before, however long ago, count no more. Returns the version.

        A row that comes again is the same row, so it has the same time: only ids of the days in the batch are read. Of rows
        with one id and day the least in ``by`` stands. Rows without an id cannot be told apart and all count; rows
        without a time have the day null. The same version written again replaces itself. Not for two writers at once.
        """
        version = self._begin(events, version)
        day = F.to_date("ts").alias("day")
        rows = events.select(*self._scope, *self._by, day, F.col(self._row_id).cast("string").alias("row_id"))
        keys = [*self._scope, "day", "row_id"]
        named = rows.filter("row_id IS NOT NULL").groupBy(*keys).agg(F.min(F.struct(*self._by)).alias("_by"))
        once = durable(named.select(*keys, "_by.*"))
        days = [r["day"] for r in once.select("day").distinct().collect()]  # as many as the batch has calendar days
        known = self._table.read_folders("ids", f"{self._scope_ddl}row_id string, day date", version - 1)
        in_days = F.col("day").isin([d for d in days if d is not None])
        known = known.filter(in_days | F.col("day").isNull() if None in days else in_days)
        fresh = durable(once.alias("l").join(known.alias("r"), _same(keys), "left_anti"))
        groups = [*self._scope, *self._by, "day"]
        counted = fresh.select(*groups).unionByName(rows.filter("row_id IS NULL").select(*groups))
        totals = durable(counted.groupBy(*groups).agg(F.count("*").alias("n")))
        self._table.add(version, {"totals": (totals, ["day"])}, folders={"ids": (fresh.select(*self._scope, "row_id", "day"), "day")})
        return version

    def counts(self, version: int | None = None) -> DataFrame:
        """day, ``by`` and n as of a version, the newest by default; what ``event_counts`` gives for each row once."""
        rows = self._table.read("totals", f"{self._scope_ddl}{self._by_ddl}day date, n long", version)
        return rows.groupBy(*self._scope, "day", *self._by).agg(F.sum("n").alias("n"))



class DailyRevenue(_Maintained):
    """Orders, gross, refunded and net amounts per day of the order and currency, equal to ``net_revenue`` over all rows so far.

    ``seq`` is the type of the orders' tie-break; amounts are doubles, so a total that was corrected can differ in the last digits.
    """

    def __init__(self, spark: SparkSession, path: str, seq: str = "string", tenant: str | None = None, buckets: int = 64) -> None:
        super().__init__(spark, path, tenant, buckets)
        self._keys = [*self._scope, "order_id"]
        first = f"ts timestamp, seq {seq}, amount double, currency string"
        self._seq = seq
        self._orders_ddl = f"{self._scope_ddl}order_id string, first struct<{first}>, refunded double"
        self._refunds_ddl = f"{self._scope_ddl}order_id string, refund_id string, amount double"
        self._totals_ddl = f"{self._scope_ddl}day date, currency string, orders long, gross double, refunded double"

    def fold(self, orders: DataFrame, refunds: DataFrame, identity: Sequence[str], version: int | None = None) -> int:
        """Add orders (order_id, ts, seq, amount, currency) and refunds (order_id, amount, ``identity``); returns the version.

        Of several rows of an order the earliest stands, also if it comes later than the others: the total of the day it replaces is
        taken back. A refund counts once by ``identity``, with the least amount seen, and may come before its order.
        Rows without an order_id are left out, here and there. Both tables may be empty; the same version written again
        replaces itself. Not for two writers at once.
        """
        version = self._begin(orders, version)
        self._begin(refunds, version)
        keys = self._keys
        first = F.struct(
            F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast(self._seq).alias("seq"),
            F.col("amount").cast("double").alias("amount"), F.col("currency").cast("string").alias("currency"),
        )
        order_id = F.col("order_id").cast("string").alias("order_id")
        came = orders.filter("order_id IS NOT NULL").select(*self._scope, order_id, first.alias("first"))
        came = came.groupBy(*keys).agg(F.min("first").alias("new_first"))

        back = refunds.filter("order_id IS NOT NULL").select(
            *self._scope, order_id, row_digest(identity).alias("refund_id"), F.col("amount").cast("double").alias("amount")
        )
        own = [*keys, "refund_id"]
        back = durable(back.groupBy(*own).agg(F.min("amount").alias("amount")))
        seen = self._newest_refunds(back, version)
        least = F.least("l.amount", "r.amount")  # a null is no amount
        compared = back.alias("l").join(seen.alias("r"), _same(own), "left").select(
            *[F.col(f"l.{k}").alias(k) for k in own], least.alias("amount"), F.col("r.amount").alias("was"), F.col("r.refund_id").isNull().alias("fresh")
        )
        changed = durable(compared.filter("fresh OR NOT (amount <=> was)"))
        change = F.coalesce("amount", F.lit(0.0)) - F.coalesce("was", F.lit(0.0))
        sums = changed.groupBy(*keys).agg(F.sum(change).alias("more"))

        both = came.alias("l").join(sums.alias("r"), _same(keys), "full_outer")
        touched = durable(both.select(*[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys], "new_first", "more"))
        old = self._newest_orders(touched, version)
        merged = touched.alias("l").join(old.alias("r"), _same(keys), "left").select(
            *[F.col(f"l.{k}").alias(k) for k in keys], F.col("r.first").alias("old_first"),
            F.coalesce("r.refunded", F.lit(0.0)).alias("old_refunded"), F.least("new_first", "r.first").alias("first"),
            (F.coalesce("r.refunded", F.lit(0.0)) + F.coalesce("more", F.lit(0.0))).alias("refunded"),
        )
        moved = durable(merged.filter("NOT (first <=> old_first) OR refunded <> old_refunded"))

        def part(sign: int, first: str, refunded: str) -> Column:
            return F.struct(F.lit(sign).alias("sign"), F.col(first).alias("first"), F.col(refunded).alias("refunded"))

        steps = moved.select(*self._scope, F.inline(F.array(part(-1, "old_first", "old_refunded"), part(1, "first", "refunded"))))
        steps = steps.filter("first IS NOT NULL").groupBy(*self._scope, F.to_date("first.ts").alias("day"), F.col("first.currency").alias("currency"))
        totals = durable(
            steps.agg(
                F.sum("sign").alias("orders"), F.sum(F.col("sign") * F.col("first.amount")).alias("gross"),
                F.sum(F.col("sign") * F.col("refunded")).alias("refunded"),
            )
        )
        self._table.add(
            version,
            {
                "totals": (totals, ["day"]),
                "orders": (moved.select(*keys, "first", "refunded"), keys),
                "refunds": (changed.select(*own, "amount"), keys),
            },
        )
        return version

    def _newest_refunds(self, refunds: DataFrame, version: int) -> DataFrame:
        keys = [*self._keys, "refund_id"]
        rows = self._table.read("refunds", self._refunds_ddl, version - 1, self._table.touched(refunds, *self._keys))
        rows = rows.alias("l").join(refunds.alias("r"), _same(keys), "left_semi")
        return rows.groupBy(*keys).agg(F.min("amount").alias("amount"))

    def _newest_orders(self, touched: DataFrame, version: int) -> DataFrame:
        rows = self._table.read("orders", self._orders_ddl, version - 1, self._table.touched(touched, *self._keys))
        rows = rows.alias("l").join(touched.alias("r"), _same(self._keys), "left_semi")
        return rows.groupBy(*self._keys).agg(
            F.max_by("first", "version").alias("first"), F.max_by("refunded", "version").alias("refunded")
        )

    def changes(self, version: int) -> DataFrame:
        """What a version added to the totals and took back from them."""
        return self._table.read("totals", self._totals_ddl, version).filter(F.col("version") == version).drop("bucket", "version")

    def totals(self, version: int | None = None) -> DataFrame:
        """day, currency, orders, gross, refunded and net as of a version; days whose orders all moved are gone."""
        rows = self._table.read("totals", self._totals_ddl, version).groupBy(*self._scope, "day", "currency")
        summed = rows.agg(*[F.sum(c).alias(c) for c in ("orders", "gross", "refunded")]).filter("orders <> 0")
        refunded = F.coalesce("refunded", F.lit(0.0))
        return summed.withColumn("refunded", refunded).withColumn("net", F.col("gross") - refunded)
