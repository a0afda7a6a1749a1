"""Small scalar rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_if_empty(text: str | Column) -> Column:
    return F.nullif(_col(text), F.lit(""))


def decode_key(text: str | Column) -> Column:
    """32 hex characters in any case to 16 bytes, else NULL."""
    c = _col(text)
    return F.when(c.rlike(r"^[0-9a-fA-F]{32}\z"), F.unhex(c))


def to_timestamp(epoch: str | Column, kind: str) -> Column:
    """Epoch milliseconds (events, logs) or nanoseconds (metrics) to a timestamp."""
    c = _col(epoch).cast("bigint")
    if kind == "metric":
        return F.timestamp_micros(F.call_function("div", c, F.lit(1000)))
    return F.timestamp_millis(c)


def epoch_us(ts: str | Column) -> Column:
    """Microseconds since the epoch, for arithmetic and range windows."""
    return F.unix_micros(_col(ts).cast("timestamp"))
