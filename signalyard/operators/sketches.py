"""Sketches that are stored per period and put together later: users in theta sketches, values in KLL sketches.

A sketch has a fixed size whatever it has seen, and a longer period is the union of its parts, so history is read once. Estimates are
exact up to 2^lg_k distinct users; beyond, their relative standard error is about 2^(-lg_k / 2). A KLL quantile of size ``k`` is off by
about 2.3 / k in rank, 1.2 % for the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.operators.keys import with_tenant

LG_K, KLL_K = 12, 200


def user_sketches(events: DataFrame, period: str = "day", by: Sequence[str] = (), user: str = "user_id", lg_k: int = LG_K) -> DataFrame:
    """One row per ``period`` (and tenant, and ``by``) with a theta sketch of its users, to be stored. Null users are left out."""
    keys = with_tenant(events, *by)
    rows = events.filter(F.col(user).isNotNull()).withColumn("period", F.date_trunc(period, "ts"))
    return rows.groupBy("period", *keys).agg(F.theta_sketch_agg(user, lg_k).alias("users"))


def merge_user_sketches(sketches: DataFrame, period: str | None = "month", by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """Sketches of a longer period from those of its parts: distinct users, not the sum of days. ``period=None``: of all periods together."""
    keys = with_tenant(sketches, *by)
    longer = [] if period is None else [F.date_trunc(period, "period").alias("period")]
    return sketches.groupBy(*longer, *keys).agg(F.theta_union_agg("users", lg_k).alias("users"))


def estimated_users(sketch: str | Column = "users") -> Column:
    return F.theta_sketch_estimate(sketch)


def user_bound(sketch: str | Column, deviations: int = 4, lg_k: int = LG_K) -> Column:
    """How far an estimate may be off, in users: nothing as long as the sketch holds every user."""
    n = F.theta_sketch_estimate(sketch)
    return F.when(n < 2**lg_k, F.lit(0.0)).otherwise(deviations * n / 2 ** (lg_k / 2))


def compare_periods(sketches: DataFrame, step: str = "1 day", by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """Each period against the one ``step`` later: users in both (SET-02), lost (SET-03), gained; one row per period with a next one.

    Reads stored sketches only, joined by period. ``bound`` is how far each of the three may be off, which follows from the users
    of both periods together: a small intersection of large periods is known less well than its own size suggests.
    """
    keys = ["period", *with_tenant(sketches, *by)]
    later = sketches.select(
        (F.col("period") - F.expr(f"INTERVAL {step}")).alias("period"), *keys[1:], F.col("users").alias("_next")
    )
    both = sketches.join(later, keys)
    return both.select(
        *keys,
        F.theta_sketch_estimate("users").alias("n_users"),
        F.theta_sketch_estimate(F.theta_intersection("users", "_next")).alias("n_both"),
        F.theta_sketch_estimate(F.theta_difference("users", "_next")).alias("n_lost"),
        F.theta_sketch_estimate(F.theta_difference("_next", "users")).alias("n_gained"),
        user_bound(F.theta_union("users", "_next", lg_k), lg_k=lg_k).alias("bound"),
    )


def value_sketches(
    df: DataFrame, value: str | Column = "value", period: str = "day", by: Sequence[str] = (), k: int = KLL_K
) -> DataFrame:
    """One row per ``period`` (and tenant, and ``by``) with a KLL sketch of a numeric value, to be stored. Nulls are left out."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    keys = with_tenant(df, *by)
    rows = df.select(F.date_trunc(period, "ts").alias("period"), *keys, v.alias("_v")).filter("_v IS NOT NULL")
    return rows.groupBy("period", *keys).agg(F.kll_sketch_agg_double("_v", k).alias("sketch"))


def merge_value_sketches(sketches: DataFrame, period: str = "month", by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """Sketches of a longer period from those of its parts."""
    keys = with_tenant(sketches, *by)
    return sketches.groupBy(F.date_trunc(period, "period").alias("period"), *keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, ranks: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """The sketch replaced by ``n`` and a column ``p<percent>`` per rank."""
    carried = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(
        *carried,
        F.kll_sketch_get_n_double("sketch").alias("n"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(r)).alias(f"p{100 * r:g}".replace(".", "_")) for r in ranks],
    )


def rank_error(values: DataFrame, quantiles: DataFrame, by: Sequence[str], estimate: str, rank: float, value: str = "value") -> DataFrame:
    """How far a quantile is off in rank, per group: 0 where ``rank`` lies between the share below and the share up to it.

    ``quantiles`` has one row per group; a group without values has none.
    """
    joined = values.join(quantiles.select(*by, F.col(estimate).alias("_q")), list(by))
    shares = joined.groupBy(*by).agg(
        F.avg((F.col(value) < F.col("_q")).cast("double")).alias("_below"), F.avg((F.col(value) <= F.col("_q")).cast("double")).alias("_upto")
    )
    off = F.greatest(F.col("_below") - rank, rank - F.col("_upto"), F.lit(0.0))
    return shares.select(*by, off.alias("rank_error"))
