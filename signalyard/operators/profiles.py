"""Current traits of users and groups, and who is in which group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.functions.payload import merged_map, props_of
from signalyard.operators.keys import row_order, with_tenant
from signalyard.plans import Ordered, next_row


def latest_traits(
    df: DataFrame, keys: Sequence[str], payload: str = "payload", drop: Sequence[str] = ()
) -> DataFrame:
    """Long form: for each key and trait the value (JSON text) that was set last, and when.

    Reduced on the map side, so a key with very many updates costs one row per task and trait. Equal
    order values fall back on the text, which keeps the result the same on every run.
    """
    keys, order = list(keys), row_order(df)
    pairs = df.select(*keys, *order, F.explode(merged_map(props_of(payload))).alias("trait", "_v"))
    if drop:
        pairs = pairs.filter(~F.col("trait").isin(*drop))
    text = F.to_json("_v")
    rows = pairs.select(*keys, "trait", F.struct(*order, text.alias("_text")).alias("_set"))
    return (
        rows.groupBy(*keys, "trait")
        .agg(F.max("_set").alias("_set"))
        .select(*keys, "trait", F.col("_set._text").alias("value"), F.col(f"_set.{order[0]}").alias("set_at"))
    )


def _as_profile(traits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One JSON object per key, traits in alphabetical order."""
    entries = F.array_sort(F.collect_list(F.struct("trait", "value")))
    values = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["trait"], F.parse_json(F.coalesce(e["value"], F.lit("null")))))
    )
    return traits.groupBy(*keys).agg(F.to_json(values).alias("traits"), F.max("set_at").alias("updated_at"))


def user_profiles(identifies: DataFrame, user: str = "user_id", payload: str = "payload") -> DataFrame:
    """Current profile per user: per trait the latest value; traits not mentioned again stay."""
    keys = with_tenant(identifies, user)
    return _as_profile(latest_traits(identifies, keys, payload, drop=("user_id",)), keys)


def group_profiles(groups: DataFrame, group: str = "group_id", payload: str = "payload") -> DataFrame:
    """Current profile per group, without the reserved keys."""
    keys = with_tenant(groups, group)
    return _as_profile(latest_traits(groups, keys, payload, drop=("group_id", "user_id")), keys)


def group_members(groups: DataFrame, user: str = "user_id", group: str = "group_id") -> DataFrame:
    """Per group: distinct members, first and last join, and how many are currently in it.

    A user is currently in the group they joined last. One pass: rows are reduced to (group, user), of
    which the last one per user is the current membership.
    """
    keys = with_tenant(groups, group)
    pairs = groups.groupBy(*keys, user).agg(
        F.min("ts").alias("_first"), F.max("ts").alias("_last"), F.max(F.struct(*row_order(groups))).alias("_order")
    )
    placed = Ordered.of(pairs, with_tenant(groups, user), ["_order", group]).scan(_later=next_row("_order")).frame()
    return placed.groupBy(*keys).agg(
        F.count("*").alias("members"),
        F.min("_first").alias("first_joined"),
        F.max("_last").alias("last_joined"),
        F.count_if(F.col("_later").isNull()).alias("current_members"),
    )


def current_groups(groups: DataFrame, user: str = "user_id", group: str = "group_id") -> DataFrame:
    """Per user the group joined last."""
    latest = F.max_by(group, F.struct(*row_order(groups), group))
    return groups.groupBy(*with_tenant(groups, user)).agg(latest.alias(group), F.max("ts").alias("joined_at"))
