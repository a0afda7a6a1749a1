"""What properties events carry: fill rates, types, frequent values, a schema registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.functions.payload import merged_map, props_of
from signalyard.operators.ordering import first_n
from signalyard.operators.payloads import explode_props
from signalyard.session import durable


def prop_stats(df: DataFrame, name: str = "event_name", payload: str = "payload", k: int = 5) -> DataFrame:
    """Per event name and property: rows, fill rate, distinct values, JSON types, top ``k`` values.

    Values are counted once and everything else is summed from those counts, so one frequent event
    name or value spreads over tasks.
    """
    rows = df.groupBy(name).agg(F.count("*").alias("n_rows"))
    values = explode_props(df, [name], payload).groupBy(name, "key", "json_type", "value").agg(F.count("*").alias("c"))
    # A value can occur in several JSON types; count it once as a distinct value.
    once = values.groupBy(name, "key", "value").agg(F.sum("c").alias("c"), F.collect_set("json_type").alias("types"))
    once = durable(once)  # read twice below; payloads are parsed once
    totals = once.groupBy(name, "key").agg(
        F.sum("c").alias("n_filled"),
        F.count("value").alias("n_distinct"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))).alias("json_types"),
    )
    known = once.filter("value IS NOT NULL").withColumn("_neg", -F.col("c"))
    ranked = first_n(known, [name, "key"], k, ["_neg", "value"])
    top = ranked.groupBy(name, "key").agg(F.array_sort(F.collect_list(F.struct("_rn", "value", "c"))).alias("_top"))
    return (
        totals.join(rows, name)
        .join(top, [name, "key"], "left")
        .select(
            name,
            "key",
            "n_filled",
            (F.col("n_filled") / F.col("n_rows")).alias("fill_rate"),
            "n_distinct",
            "json_types",
            F.transform("_top", lambda t: F.struct(t["value"], t["c"].alias("n"))).alias("top_values"),
        )
    )


def property_registry(df: DataFrame, name: str = "event_name", payload: str = "payload") -> DataFrame:
    """Long schema registry: event name, key, JSON type, rows. Any number of keys per name, combined on the map side."""
    return explode_props(df, [name], payload).groupBy(name, "key", "json_type").agg(F.count("*").alias("n"))


def distinct_props(df: DataFrame, name: str = "event_name", payload: str = "payload") -> DataFrame:
    """Per event name the property names and the schema seen so far, in one row.

    For names with a sane number of keys; ``property_registry`` is the form without a bound.
    """
    props = merged_map(props_of(payload))
    schema = F.schema_of_variant_agg(F.parse_json(F.to_json("_props")))
    keys = (
        df.select(name, F.explode(F.map_keys(props)).alias("key"))
        .distinct()
        .groupBy(name)
        .agg(F.array_sort(F.collect_list("key")).alias("keys"))
    )
    schemas = df.select(name, props.alias("_props")).groupBy(name).agg(schema.alias("schema"))
    return schemas.join(keys, name, "left")
