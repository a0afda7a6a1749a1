"""Canonical users as a stored star forest that new alias links are added to.

The forest has a row per user: (user_id, canonical_id), the least id of its component. Canonical ids only ever fall, so a user's
newest row is the one with the least canonical id, and a root that lost its place never comes back. Rows are kept in two
layouts: by user, to find the components that new links touch, and by root, to find the members of those that are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalyard.operators.identity import resolve_identities
from signalyard.operators.keys import with_tenant
from signalyard.plans import lookup
from signalyard.session import durable
from signalyard.sources.versions import VersionedTable


class IdentityStore:
    """The map of one folder. ``tenant`` is the type of the tenant column, where users belong to tenants."""

    def __init__(self, spark: SparkSession, path: str, tenant: str | None = None, buckets: int = 64) -> None:
        self._table = VersionedTable(spark, path, buckets)
        self._scope = ["tenant"] if tenant else []
        self._ddl = (f"tenant {tenant}, " if tenant else "") + "user_id string, canonical_id string"

    def versions(self) -> DataFrame | None:
        return self._table.versions()

    def _rows(self, layout: str, upto: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        return self._table.read(layout, self._ddl, upto, buckets).select(*self._scope, "user_id", "canonical_id")

    def map(self, version: int | None = None) -> DataFrame:
        """``user_id`` to ``canonical_id`` as of a version, the newest by default; one row per user."""
        rows = self._rows("by_user", version)
        return rows.groupBy(*self._scope, "user_id").agg(F.min("canonical_id").alias("canonical_id"))

    def add_links(self, aliases: DataFrame, note: str = "") -> int:
        """Add (previous_id, user_id) links and return the version that has them.

        What is read are the buckets of the users in the links and of the roots that fall; what is written are new users and the members
        of components whose root falls. Links that are known, repeated, in either direction or to oneself do no harm;
        links with a null are left out. The result equals ``resolve_identities`` over all links so far. Not for two writers at once.
        """
        scope = with_tenant(aliases)
        if scope != self._scope:
            raise ValueError(f"the store has the scope {self._scope}, the links have {scope}")
        links = durable(
            aliases.filter("previous_id IS NOT NULL AND user_id IS NOT NULL")
            .select(*scope, F.col("previous_id").cast("string").alias("a"), F.col("user_id").cast("string").alias("b"))
            .distinct()
        )
        version = self._table.newest() + 1
        if version == 1:  # nothing to be joined with
            pairs = links.select(*scope, F.col("a").alias("previous_id"), F.col("b").alias("user_id"))
            return self._write(version, durable(resolve_identities(pairs)), note)
        ends = durable(
            links.select(*scope, F.col("a").alias("user_id"))
            .unionByName(links.select(*scope, F.col("b").alias("user_id")))
            .distinct()
        )
        seen = self._rows("by_user", buckets=self._table.touched(ends, *scope, "user_id"))
        seen = seen.join(ends, [*scope, "user_id"], "left_semi")
        roots = durable(seen.groupBy(*scope, "user_id").agg(F.min("canonical_id").alias("root")))

        # The links between components: as many as there are new links, whatever the components' sizes.
        def root_of(side: str) -> DataFrame:
            return roots.select(*scope, F.col("user_id").alias(side), F.col("root").alias(f"root_{side}"))

        between = lookup(lookup(links, root_of("a"), [*scope, "a"]), root_of("b"), [*scope, "b"])
        between = between.select(
            *scope, F.coalesce("root_a", "a").alias("previous_id"), F.coalesce("root_b", "b").alias("user_id")
        ).distinct()
        joined = durable(resolve_identities(between))  # node, least node of its component

        node = joined.select(*scope, F.col("user_id").alias("root"), F.col("canonical_id").alias("new"))
        known = roots.select(*scope, "root").distinct()
        fallen = durable(node.filter("root <> new").join(known, [*scope, "root"], "left_semi"))
        members = self._rows("by_root", buckets=self._table.touched(fallen, *scope, "root"))
        members = members.withColumnRenamed("canonical_id", "root")
        moved = lookup(members, fallen, [*scope, "root"], "inner").select(*scope, "user_id", F.col("new").alias("canonical_id"))
        fresh = ends.join(roots.select(*scope, "user_id"), [*scope, "user_id"], "left_anti")
        placed = fresh.join(joined, [*scope, "user_id"]).select(*scope, "user_id", "canonical_id")
        return self._write(version, durable(moved.unionByName(placed).distinct()), note)

    def _write(self, version: int, changed: DataFrame, note: str) -> int:
        by_user, by_root = [*self._scope, "user_id"], [*self._scope, "canonical_id"]
        self._table.add(version, {"by_user": (changed, by_user), "by_root": (changed, by_root)}, note)
        return version
