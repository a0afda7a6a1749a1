"""Sessions, sequences and touches per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.functions.scalars import epoch_us
from signalyard.operators.keys import row_order, with_tenant
from signalyard.plans import Ordered, next_row, prev_row, running_sum
from signalyard.plans.trailing import width_us
from signalyard.schemas import ERROR_LEVEL


def sessionize_gap(events: DataFrame, gap: str = "30 minutes", user: str = "user_id") -> DataFrame:
    """Number the sessions of a user from 1; a silence of ``gap`` or more starts a new one."""
    silent = (epoch_us("ts") - epoch_us("_prev")) >= width_us(gap)
    return (
        Ordered.of(events, with_tenant(events, user), row_order(events))
        .scan(_prev=prev_row("ts"))
        .with_columns(_new=F.when(F.col("_prev").isNull() | silent, 1).otherwise(0))
        .scan(session_no=running_sum("_new"))
        .frame()
        .drop("_prev", "_new")
    )


def gap_sessions(events: DataFrame, gap: str = "30 minutes", user: str = "user_id") -> DataFrame:
    """One row per session of ``sessionize_gap``: start, end, events."""
    numbered = sessionize_gap(events, gap, user)
    return numbered.groupBy(*with_tenant(events, user), "session_no").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("n_events")
    )


def sessionize_reset(events: DataFrame, resets: DataFrame, device: str = "device_id") -> DataFrame:
    """``session_no``: how many session resets of the device lie at or before the row."""
    keys, order = with_tenant(events, device), row_order(events)
    rows = events.select(*keys, F.col("ts").alias("_at"), F.lit(1).alias("_rank"), F.struct(*events.columns).alias("_row"))
    marks = resets.select(*keys, F.col("ts").alias("_at"), F.lit(0).alias("_rank"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    tie = F.col(f"_row.{order[-1]}").cast("bigint") if len(order) > 1 else F.lit(0)
    numbered = (
        Ordered.of(both.withColumn("_tie", tie), keys, ["_at", "_rank", "_tie"])
        .scan(session_no=running_sum(1 - F.col("_rank")))
        .filter(F.col("_row").isNotNull())
        .frame()
    )
    return numbered.select("_row.*", "session_no")


def event_sequence(
    events: DataFrame, user: str = "user_id", by_session: bool = False, name: str = "event_name"
) -> DataFrame:
    """Step number, previous and next event, and seconds since the previous one."""
    keys = with_tenant(events, "session_id" if by_session else user)
    rows = (
        Ordered.of(events, keys, row_order(events))
        .scan(
            step=running_sum(F.lit(1)),
            previous_event=prev_row(name),
            next_event=next_row(name),
            _prev=prev_row("ts"),
        )
        .frame()
    )
    seconds = (epoch_us("ts") - epoch_us("_prev")) / 1e6
    return rows.withColumn("seconds_since_previous", seconds).drop("_prev")


def first_last_touch(events: DataFrame, column: str, user: str = "user_id") -> DataFrame:
    """First and last non-empty value of a column per user.

    An aggregation with map-side combine rather than a window: one row per user is all that is kept.
    """
    known = events.filter(F.col(column).isNotNull())
    order = F.struct(*row_order(known))
    return known.groupBy(*with_tenant(known, user)).agg(
        F.min_by(column, order).alias("first_touch"),
        F.max_by(column, order).alias("last_touch"),
        F.min("ts").alias("first_touch_at"),
        F.max("ts").alias("last_touch_at"),
    )


def session_summary(events: DataFrame, logs: DataFrame | None = None) -> DataFrame:
    """Per session: start, end, seconds, events, logs, worst level, errors, entry and exit event."""
    keys = with_tenant(events, "session_id")
    parts = [
        events.select(
            *keys,
            "ts",
            F.struct(*row_order(events)).alias("_order"),
            "event_name",
            F.lit(None).cast("int").alias("level"),
            F.lit(True).alias("_event"),
        )
    ]
    if logs is not None:
        parts.append(logs.select(*keys, "ts", F.col("level").cast("int").alias("level"), F.lit(False).alias("_event")))
    rows = parts[0] if logs is None else parts[0].unionByName(parts[1], allowMissingColumns=True)
    first = F.when(F.col("_event"), F.col("_order"))
    return (
        rows.filter("session_id IS NOT NULL")
        .groupBy(*keys)
        .agg(
            F.min("ts").alias("session_start"),
            F.max("ts").alias("session_end"),
            ((epoch_us(F.max("ts")) - epoch_us(F.min("ts"))) / 1e6).alias("seconds"),
            F.count_if("_event").alias("n_events"),
            F.count_if(~F.col("_event")).alias("n_logs"),
            F.min("level").alias("worst_level"),
            F.count_if(F.col("level") <= ERROR_LEVEL).alias("n_errors"),
            F.min_by("event_name", first).alias("entry_event"),
            F.max_by("event_name", first).alias("exit_event"),
        )
    )


def paths(
    events: DataFrame, depth: int = 3, by: Sequence[str] = ("session_id",), name: str = "event_name", k: int | None = None
) -> DataFrame:
    """How often each opening sequence of up to ``depth`` events occurs, most frequent first.

    Only the first ``depth`` rows per session survive the map side (Spark limits each group before the
    shuffle), so a session of any length costs ``depth`` rows. Paths are counted per tenant, where there is one;
    ``k`` keeps the k most frequent of all.
    """
    from signalyard.operators.ordering import first_n

    keys = with_tenant(events, *by)
    opening = first_n(events, keys, depth, row_order(events))
    steps = F.array_sort(F.collect_list(F.struct("_rn", name)))
    per_session = opening.groupBy(*keys).agg(F.transform(steps, lambda s: s[name]).alias("path"))
    scope = with_tenant(events)
    counted = per_session.groupBy(*scope, "path").agg(F.count("*").alias("n"))
    if k is None:
        return counted
    return counted.orderBy(F.desc("n"), *scope, "path").limit(k)
