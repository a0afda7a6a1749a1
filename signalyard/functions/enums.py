"""Wire codes and their names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalyard.schemas import ENUMS


def _lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def name_of(enum: str, code: str | Column) -> Column:
    """Name of a code; out of range is ``unknown``, for a level NULL."""
    c = F.col(code) if isinstance(code, str) else code
    found = _lookup(ENUMS[enum], c.cast("int"))
    return found if enum == "level" else F.coalesce(found, F.lit("unknown"))


def code_of(enum: str, name: str | Column) -> Column:
    """Code of a name in any case; an unknown name is 0, for a level NULL."""
    c = F.col(name) if isinstance(name, str) else name
    found = _lookup({n: code for code, n in ENUMS[enum].items()}, F.lower(c))
    return (found if enum == "level" else F.coalesce(found, F.lit(0))).cast("tinyint")
