"""Property payloads: JSON objects merged flat, the later source winning.

``map<string,variant>`` keeps JSON types. ``from_json`` leaves a repeated key in that map twice;
``map_concat`` under the LAST_WIN policy (see ``session.RUNTIME_CONF``) keeps the last of them, also
within one input. ``get_json_object`` is never used on payloads: it returns the first of two equal
keys, where the rule is "last wins".
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

PROPS_TYPE = "map<string,variant>"


def empty_props() -> Column:
    return F.from_json(F.lit("{}"), PROPS_TYPE)


def props_of(json: str | Column) -> Column:
    """A JSON column as a property map; NULL when it is malformed or not an object."""
    return F.from_json(F.col(json) if isinstance(json, str) else json, PROPS_TYPE)


def typed_props(json: str | Column, ddl: str) -> Column:
    """Typed fields out of a JSON column, as a struct."""
    return F.from_json(F.col(json) if isinstance(json, str) else json, ddl)


def finite_or_null(number: str | Column) -> Column:
    """JSON has no NaN or infinity; a payload shows them as null."""
    c = (F.col(number) if isinstance(number, str) else number).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def as_props(fields: Mapping[str, Column]) -> Column:
    """Reserved keys as a property map, in the given order. NULL values stay as JSON null."""
    entries: list[Column] = []
    for key, value in fields.items():
        entries += [F.lit(key), value.cast("variant")]
    return F.create_map(*entries)


def merged_map(*sources: Column) -> Column:
    """Flat merge of property maps, later wins; a NULL source adds nothing."""
    return F.map_concat(empty_props(), *[F.coalesce(s, empty_props()) for s in sources])


def merge_properties(*sources: str | Column) -> Column:
    """Flat merge of JSON object columns into one JSON column, later wins.

    Malformed, non-object, empty and NULL inputs add nothing.
    """
    return F.to_json(merged_map(*[props_of(s) for s in sources]))
