"""Counts and volumes over events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalyard.functions.scalars import epoch_us
from signalyard.operators.payloads import payload_size
from signalyard.plans import Ordered, running_sum, suffix_sum
from signalyard.schemas import SUBSCRIPTION_STATES
from signalyard.operators.keys import row_order, with_tenant


def day_of(ts: str | Column = "ts") -> Column:
    return F.to_date(ts)


def time_bucket(ts: str | Column, width: str) -> Column:
    """Start of the fixed window of ``width`` that holds ``ts``."""
    return F.window(ts, width)["start"]


def event_counts(events: DataFrame, by: Sequence[str] = ("event_name",), day: bool = False) -> DataFrame:
    """Events per group; ``day`` adds the calendar day to the group."""
    keys: list = list(by)
    if day:
        keys.append(day_of().alias("day"))
    return events.groupBy(*keys).agg(F.count("*").alias("n"))


def active_users(
    events: DataFrame, period: str = "day", by: Sequence[str] = (), exact: bool = True, user: str = "user_id"
) -> DataFrame:
    """Distinct users per day, week or month. Inexact uses a HyperLogLog sketch."""
    count = F.count_distinct(user) if exact else F.approx_count_distinct(user)
    return events.groupBy(*by, F.date_trunc(period, "ts").cast("date").alias("period")).agg(
        count.alias("active_users")
    )


def active_ratio(events: DataFrame, days: int = 30, by: Sequence[str] = (), user: str = "user_id") -> DataFrame:
    """Per day: users of that day, distinct users of the trailing ``days``, and their ratio.

    A user active on day d counts from d until the day before they either show up again or fall out of
    the trailing range, so the trailing count is a running sum of +1 and -1 per day. The data is
    reduced to user-days first; nothing is multiplied by ``days``.
    """
    by = list(by)
    user_days = events.select(*by, user, day_of().alias("day")).distinct()
    stays = user_days.withColumn(
        "_until",
        F.least(
            F.date_add("day", days),
            F.lead("day").over(Window.partitionBy(*by, user).orderBy("day")),
        ),
    )
    steps = stays.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("day").alias("day"), F.lit(1).alias("step"), F.lit(1).alias("here")),
                F.struct(F.col("_until").alias("day"), F.lit(-1).alias("step"), F.lit(0).alias("here")),
            )
        ).alias("s"),
    )
    daily = steps.groupBy(*by, "s.day").agg(F.sum("s.step").alias("step"), F.sum("s.here").alias("dau"))
    # One row per calendar day and group: small whatever the number of events.
    running = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily.withColumn("mau", F.sum("step").over(running))
        .filter("dau > 0")
        .select(*by, "day", "dau", "mau", (F.col("dau") / F.col("mau")).alias("ratio"))
    )


def throughput(df: DataFrame, window: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows per elapsed second, per window or overall; NULL when no time passes."""
    keys: list = list(by)
    if window:
        keys.append(time_bucket("ts", window).alias("window_start"))
    elapsed = (epoch_us(F.max("ts")) - epoch_us(F.min("ts"))) / 1e6
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        elapsed.alias("elapsed_seconds"),
        (F.count("*") / F.nullif(elapsed, F.lit(0.0))).alias("per_second"),
    )


def wire_volume(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum and mean of payload and wire bytes."""
    sized = payload_size(events)
    return sized.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum("payload_bytes").alias("payload_bytes"),
        F.sum("wire_bytes").alias("wire_bytes"),
        F.avg("wire_bytes").alias("mean_wire_bytes"),
    )


def latency_summary(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """avg, min, max, p50 and p99, where p50 is the value at 0-based rank n/2 and p99 at n*99/100.

    Values are counted before they are ranked, so equal values cost one row, and a group of any size
    is ranked in pieces.
    """
    by = list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    ranked = (
        Ordered.of(counts, by, [value])
        .scan(_upto=running_sum("_c"), _from=suffix_sum("_c"))
        .with_columns(n=F.col("_upto") + F.col("_from") - F.col("_c"))
        .frame()
    )
    first = F.col("_upto") - F.col("_c")

    def at(rank: str) -> Column:
        hit = (first <= F.expr(rank)) & (F.expr(rank) < F.col("_upto"))
        return F.max(F.when(hit, F.col(value)))

    return ranked.groupBy(*by, "n").agg(
        (F.sum(F.col(value) * F.col("_c")) / F.sum("_c")).alias("avg"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        at("n div 2").alias("p50"),
        at("n * 99 div 100").alias("p99"),
    )


def latency_sketch(df: DataFrame, value: str = "value", by: Sequence[str] = (), accuracy: int = 10_000):
    """The same summary with approximate percentiles, in one pass."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(value).alias("avg"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.percentile_approx(value, 0.5, accuracy).alias("p50"),
        F.percentile_approx(value, 0.99, accuracy).alias("p99"),
    )


def subscription_state(events: DataFrame, user: str = "user_id") -> DataFrame:
    """Where each user's subscription stands: active, paused or canceled, since when, by which event."""
    states = F.create_map(*[F.lit(x) for pair in SUBSCRIPTION_STATES.items() for x in pair])
    mine = events.filter(F.col("event_name").isin(*SUBSCRIPTION_STATES))
    latest = F.struct(*row_order(mine))
    return (
        mine.groupBy(*with_tenant(mine, user))
        .agg(F.max_by("event_name", latest).alias("last_event"), F.max("ts").alias("since"))
        .withColumn("state", F.try_element_at(states, F.col("last_event")))
    )


def engagement_rates(events: DataFrame, by: Sequence[str] = (), unit: str = "user_id") -> DataFrame:
    """Distinct users per e-mail and notification step, and the rates between steps (NULL on zero)."""
    steps = {
        "emails_sent": "Email Sent",
        "emails_opened": "Email Opened",
        "emails_clicked": "Email Clicked",
        "emails_bounced": "Email Bounced",
        "emails_unsubscribed": "Email Unsubscribed",
        "notifications_sent": "Notification Sent",
        "notifications_clicked": "Notification Clicked",
    }
    mine = events.filter(F.col("event_name").isin(*steps.values()))
    # One row per user and step before anything is counted: no distinct set is held per group.
    once = mine.select(*by, unit, "event_name").distinct()
    counts = once.groupBy(*by).agg(
        *[F.count_if(F.col("event_name") == name).alias(column) for column, name in steps.items()]
    )

    def rate(part: str, whole: str) -> Column:
        return F.col(part) / F.nullif(F.col(whole), F.lit(0))

    return counts.withColumns(
        {
            "open_rate": rate("emails_opened", "emails_sent"),
            "click_rate": rate("emails_clicked", "emails_opened"),
            "bounce_rate": rate("emails_bounced", "emails_sent"),
            "unsubscribe_rate": rate("emails_unsubscribed", "emails_sent"),
            "notification_click_rate": rate("notifications_clicked", "notifications_sent"),
        }
    )
