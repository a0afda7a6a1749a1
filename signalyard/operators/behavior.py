"""Funnels, retention, durations between events, abandonment, failed logins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalyard.functions.scalars import epoch_us
from signalyard.operators.events import latency_summary
from signalyard.operators.keys import row_order, with_tenant
from signalyard.plans import Ordered, next_seen
from signalyard.plans.trailing import trailing_range, width_us

CART_TO_ORDER = ("Cart Viewed", "Checkout Started", "Order Completed")
TRIAL_TO_PAID = ("Trial Started", "Trial Converted")


def funnel_users(
    events: DataFrame, steps: Sequence[str], within: str | None = None, user: str = "user_id", name: str = "event_name"
) -> DataFrame:
    """Per user the time of each step reached: ``t1`` .. ``tK``, NULL from the first step not reached.

    Step 1 is the user's earliest; each later step is the earliest one strictly after the step before
    (rows ordered by time, then tie-break), not later than ``within`` after step 1.

    Every row learns the rest of its chain from the rows after it, last step first. All these scans
    share one exchange and one sort on the user.
    """
    keys, order = with_tenant(events, user), row_order(events)
    chain = [f"_t{i}" for i in range(len(steps))]
    rows = Ordered.of(events.filter(F.col(name).isin(*steps)).select(*keys, *order, name), keys, order)
    nothing = F.lit(None).cast("timestamp")
    rows = rows.with_columns(_after=F.struct(*[nothing.alias(c) for c in chain]))
    for i in range(len(steps) - 1, 0, -1):
        here = F.struct(
            *[
                (F.col("ts").cast("timestamp") if j == i else F.col(f"_after.{c}")).alias(c)
                for j, c in enumerate(chain)
            ]
        )
        rows = rows.with_columns(_here=F.when(F.col(name) == steps[i], here)).scan(_next=next_seen("_here"))
        rows = rows.with_columns(_after=F.coalesce("_next", F.struct(*[nothing.alias(c) for c in chain])))
    begin = rows.frame().filter(F.col(name) == steps[0])
    first = F.struct(*order)
    found = begin.groupBy(*keys).agg(F.min("ts").cast("timestamp").alias("t1"), F.min_by("_after", first).alias("_c"))
    limit = None if within is None else width_us(within)
    out: list[Column] = [F.col("t1")]
    for i in range(1, len(steps)):
        t = F.col(f"_c.{chain[i]}")
        if limit is not None:
            t = F.when(epoch_us(t) - epoch_us("t1") <= limit, t)
        out.append(t.alias(f"t{i + 1}"))
    return found.select(*keys, *out)


def funnel(
    events: DataFrame, steps: Sequence[str], within: str | None = None, user: str = "user_id", name: str = "event_name"
) -> DataFrame:
    """Users per step, share of step 1, share of the step before, and the median seconds from step 1.

    The median is the value at 0-based rank n/2, as in ``latency_summary``. Per tenant, where there is one.
    """
    scope = with_tenant(events)
    users = funnel_users(events, steps, within, user, name)
    reached = [
        F.when(
            F.col(f"t{i}").isNotNull(),
            F.struct(
                F.lit(i).alias("step"),
                F.lit(steps[i - 1]).alias("event_name"),
                ((epoch_us(f"t{i}") - epoch_us("t1")) / 1e6).alias("seconds"),
            ),
        )
        for i in range(1, len(steps) + 1)
    ]
    long = users.select(*scope, F.explode(F.array_compact(F.array(*reached))).alias("s")).select(*scope, "s.*")
    table = latency_summary(long, "seconds", [*scope, "step", "event_name"])
    # One row per step from here on.
    by_step = F.map_from_entries(F.collect_list(F.struct("step", "n"))).alias("_by_step")
    rows = table.groupBy(*scope).agg(by_step, F.collect_list(F.struct("step", "event_name", "n", "p50")).alias("_rows"))
    flat = rows.select(*scope, "_by_step", F.explode("_rows").alias("r")).select(*scope, "_by_step", "r.*")

    def share(of: Column) -> Column:
        return F.col("n") / F.try_element_at("_by_step", of)

    return flat.select(
        *scope,
        "step",
        "event_name",
        F.col("n").alias("users"),
        share(F.lit(1)).alias("rate_from_first"),
        F.coalesce(share(F.col("step") - 1), F.lit(1.0)).alias("rate_from_previous"),
        F.col("p50").alias("median_seconds"),
    )


def retention(
    events: DataFrame,
    first: Sequence[str] | None = None,
    returning: Sequence[str] | None = None,
    period: str = "week",
    user: str = "user_id",
    name: str = "event_name",
) -> DataFrame:
    """Cohorts by the period of a user's first event; how many come back n periods later.

    ``first`` and ``returning`` name the events that count (all when left out). One pass over the
    events reduces them to user-periods; everything after works on those.
    """

    def named(names: Sequence[str] | None) -> Column:
        return F.lit(True) if names is None else F.coalesce(F.col(name).isin(*names), F.lit(False))

    keys, scope = with_tenant(events, user), with_tenant(events)
    start = F.date_trunc(period, "ts").cast("date")
    visits = events.groupBy(*keys, start.alias("_period")).agg(
        F.bool_or(named(first)).alias("_first"), F.bool_or(named(returning)).alias("_back")
    )
    # A user has as many rows as there are periods.
    per_user = Window.partitionBy(*keys)
    joined = visits.withColumn("cohort", F.min(F.when(F.col("_first"), F.col("_period"))).over(per_user))
    apart = {
        "day": F.datediff("_period", "cohort"),
        "week": F.call_function("div", F.datediff("_period", "cohort"), F.lit(7)),
        "month": F.months_between("_period", "cohort").cast("int"),
    }[period]
    counts = (
        joined.filter(F.col("_period") >= F.col("cohort"))
        .groupBy(*scope, "cohort", apart.cast("int").alias("n"))
        .agg(F.count_if("_back").alias("users"), F.count_if(F.col("_period") == F.col("cohort")).alias("_size"))
    )
    # One row per cohort and period from here on; the cohort's size is in its first period.
    size = F.max("_size").over(Window.partitionBy(*scope, "cohort"))
    return (
        counts.withColumn("cohort_size", size)
        .filter("users > 0")
        .select(*scope, "cohort", "n", "users", "cohort_size", (F.col("users") / F.col("cohort_size")).alias("share"))
    )


def retention_table(retained: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Cohorts (per tenant) as rows, periods as columns ``p0``, ``p1``, ... with the share that came back."""
    cohort = with_tenant(retained, "cohort", "cohort_size")
    wide = retained.groupBy(*cohort).pivot("n", list(periods)).agg(F.max("share"))
    return wide.select(*cohort, *[F.col(str(p)).alias(f"p{p}") for p in periods])


def time_between(
    events: DataFrame, start: str, end: str, keys: Sequence[str] = ("user_id",), name: str = "event_name"
) -> DataFrame:
    """From each ``start`` event to the next ``end`` event of the same key: both times and the seconds.

    ``end_ts`` and ``seconds`` are NULL while there is no such event.
    """
    keys = with_tenant(events, *keys)
    order = row_order(events)
    mine = events.filter(F.col(name).isin(start, end)).select(*keys, *order, name)
    rows = (
        Ordered.of(mine, keys, order)
        .with_columns(_end=F.when(F.col(name) == end, F.col("ts")))
        .scan(end_ts=next_seen("_end"))
        .filter(F.col(name) == start)
        .frame()
    )
    seconds = (epoch_us("end_ts") - epoch_us("start_ts")) / 1e6
    others = [c for c in order if c != "ts"]
    return rows.select(*keys, *others, F.col("ts").alias("start_ts"), "end_ts").withColumn("seconds", seconds)


def abandonment(
    events: DataFrame,
    window: str = "1 day",
    keys: Sequence[str] = ("user_id",),
    cart: Sequence[str] = ("Cart Viewed", "Cart Updated"),
    done: Sequence[str] = ("Checkout Completed", "Order Completed"),
    name: str = "event_name",
) -> DataFrame:
    """Each cart event with the next completion of the same key; abandoned when none comes in ``window``."""
    keys = with_tenant(events, *keys)
    order = row_order(events)
    mine = events.filter(F.col(name).isin(*cart, *done)).select(*keys, *order, name)
    rows = (
        Ordered.of(mine, keys, order)
        .with_columns(_done=F.when(F.col(name).isin(*done), F.col("ts")))
        .scan(completed_ts=next_seen("_done"))
        .filter(F.col(name).isin(*cart))
        .frame()
    )
    in_time = (epoch_us("completed_ts") - epoch_us("ts")) <= width_us(window)
    return rows.withColumn("abandoned", ~F.coalesce(in_time, F.lit(False)))


def auth_failures(
    events: DataFrame,
    n: int,
    window: str,
    user: str = "user_id",
    failed: str = "Authentication Failed",
    name: str = "event_name",
) -> DataFrame:
    """Users and times at which the last ``window`` holds at least ``n`` failed logins."""
    mine = events.filter(F.col(name) == failed)
    counts = trailing_range(mine, with_tenant(mine, user), window)
    return counts.filter(F.col("n") >= n).select(*with_tenant(mine, user), "ts", "n")
