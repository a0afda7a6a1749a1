"""Alias links to canonical users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from signalyard.operators.keys import with_tenant
from signalyard.plans.skew import lookup
from signalyard.session import durable


def _large_star(links: DataFrame, scope: list[str]) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = links.select(*scope, "a", "b").unionByName(links.select(*scope, F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy(*scope, "a").agg(F.least("a", F.min("b")).alias("m"))
    larger = both.filter("b > a")
    # A hub's links are many rows against one: Spark splits them as a skewed join.
    return larger.join(smallest, [*scope, "a"]).select(*scope, F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, scope: list[str]) -> DataFrame:
    """Hang a node and all its smaller neighbours on the smallest of them."""
    smallest = links.groupBy(*scope, "a").agg(F.min("b").alias("m"))
    moved = links.join(smallest, [*scope, "a"]).filter("b <> m").select(
        *scope, F.col("b").alias("a"), F.col("m").alias("b")
    )
    own = smallest.select(*scope, "a", F.col("m").alias("b"))
    return moved.unionByName(own).distinct()


def _written(links: DataFrame, scope: list[str]) -> tuple[DataFrame, tuple]:
    """The links as a table, and their number and checksums, taken while they are written."""
    seen = Observation()
    hashes = [F.xxhash64(F.lit(salt), *scope, "a", "b").cast("decimal(38,0)") for salt in (1, 2)]
    counted = links.observe(
        seen, F.count("*").alias("n"), F.sum(hashes[0]).alias("first"), F.sum(hashes[1]).alias("second")
    )
    table = durable(counted)
    return table, (seen.get["n"], seen.get["first"], seen.get["second"])


def resolve_identities(aliases: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``user_id`` to ``canonical_id``: the smallest id of each connected component of alias links.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which handle long chains
    in few rounds and hubs without a quadratic step: every round emits at most one row per link. Links
    in both directions, repeated links and self-links are harmless. Each round is one job, which writes its links to the
    shared folder and counts them on the way; a round that changes nothing is the last. (Batch only.)
    """
    scope = with_tenant(aliases)
    pair = aliases.select(
        *scope,
        F.greatest("previous_id", "user_id").alias("a"),
        F.least("previous_id", "user_id").alias("b"),
        "previous_id",
        "user_id",
    ).filter("previous_id IS NOT NULL AND user_id IS NOT NULL")
    links, seen = _written(pair.filter("a <> b").select(*scope, "a", "b").distinct(), scope)
    before, rounds = None, 0
    while seen != before and seen[0]:
        rounds += 1
        if rounds > max_rounds:
            raise RuntimeError(f"alias links did not settle in {max_rounds} rounds")
        before = seen
        links, seen = _written(_small_star(_large_star(links, scope), scope), scope)

    moved = links.select(*scope, F.col("a").alias("user_id"), F.col("b").alias("canonical_id"))
    roots = links.select(*scope, F.col("b").alias("user_id"), F.col("b").alias("canonical_id"))
    alone = pair.filter("a = b").select(*scope, F.col("a").alias("user_id"), F.col("a").alias("canonical_id"))
    # A self-link of a user who is also linked elsewhere must not win over the real link.
    return moved.unionByName(roots).unionByName(alone).groupBy(*scope, "user_id").agg(
        F.min("canonical_id").alias("canonical_id")
    )


def apply_identity(
    events: DataFrame, idmap: DataFrame, user: str = "user_id", keep: str | None = None
) -> DataFrame:
    """Replace the user with the canonical one; users without a mapping stay as they are.

    ``keep`` names a column for the original id. The map has one row per user, so a user with very many
    events is joined in place (see ``plans.skew.lookup``). Works on a streaming left side as well, with
    the join Spark picks.
    """
    scope = with_tenant(idmap)
    table = idmap.select(*scope, F.col("user_id").alias(user), "canonical_id")
    keys = [*scope, user]
    joined = events.join(table, keys, "left") if events.isStreaming else lookup(events, table, keys)
    columns = [c for c in events.columns]
    out = [
        F.coalesce("canonical_id", user).alias(user) if c == user else F.col(c)
        for c in columns
    ]
    if keep:
        out.append(F.col(user).alias(keep))
    return joined.select(*out)
