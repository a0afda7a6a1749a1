"""Histograms with cumulative bucket counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.operators.events import time_bucket
from signalyard.operators.keys import row_order, with_tenant
from signalyard.operators.metrics import with_series
from signalyard.operators.validation import ERROR_DDL
from signalyard.plans import Ordered, prev_row
from signalyard.schemas import HISTOGRAM_DDL

BUCKETS_DDL = "array<struct<upper_bound:double,count:bigint>>"


def _buckets(histogram: Column) -> Column:
    return F.coalesce(histogram["buckets"], F.array().cast(BUCKETS_DDL))


def sorted_buckets(df: DataFrame, histogram: str = "histogram") -> DataFrame:
    """Buckets ascending by bound; infinity sorts last."""
    return df.withColumn(histogram, F.col(histogram).withField("buckets", F.array_sort(_buckets(F.col(histogram)))))


def _bounds(histogram: Column) -> Column:
    return F.transform(_buckets(histogram), lambda b: b["upper_bound"])


def histogram_increase(metrics: DataFrame, histogram: str = "histogram") -> DataFrame:
    """Cumulative histograms as what was added since the sample before; delta histograms as they are.

    A smaller count means a restart. The first sample of a series only sets the start and adds
    nothing. A sample whose bounds differ from the one before gets an ``error``.
    """
    series = with_series(metrics)
    none = F.lit(None).cast(ERROR_DDL)
    deltas = series.filter("temporality = 'delta'").withColumn("error", none)
    cumulative = series.filter("temporality = 'cumulative'")
    rows = (
        Ordered.of(cumulative, with_tenant(series, "series_key"), row_order(series))
        .scan(_prev=prev_row(histogram))
        .frame()
    )
    now, before = F.col(histogram), F.col("_prev")
    restarted = now["count"] < before["count"]
    changed = ~F.equal_null(_bounds(now), _bounds(before))

    def less(a: Column, b: Column) -> Column:
        return F.struct(a["upper_bound"].alias("upper_bound"), (a["count"] - b["count"]).alias("count"))

    zero = F.transform(_buckets(now), lambda b: F.struct(b["upper_bound"], F.lit(0).cast("bigint").alias("count")))
    added = (
        F.when(before.isNull(), now.withField("count", F.lit(0).cast("bigint")).withField("sum", F.lit(0.0)).withField("buckets", zero))
        .when(restarted, now)
        .otherwise(
            now.withField("count", now["count"] - before["count"])
            .withField("sum", now["sum"] - before["sum"])
            .withField("buckets", F.zip_with(_buckets(now), _buckets(before), less))
        )
    )
    wrong = F.struct(F.lit("buckets").alias("field"), F.lit("bounds changed").alias("reason")).cast(ERROR_DDL)
    bad = before.isNotNull() & ~restarted & changed
    grown = rows.withColumns(
        {
            histogram: F.when(bad, now).otherwise(added).cast(HISTOGRAM_DDL),
            "temporality": F.lit("delta"),
            "error": F.when(bad, wrong),
        }
    ).drop("_prev")
    return deltas.unionByName(grown)


def histogram_merge(
    metrics: DataFrame, by: Sequence[str] = ("name",), window: str | None = None, histogram: str = "histogram"
) -> DataFrame:
    """One histogram per group: counts and sums add, min and max combine, bucket counts add per bound.

    Across series of one moment, or over time for delta histograms (turn cumulative ones into deltas
    with ``histogram_increase`` first). Only equal bound lists can be merged: a group with several gets
    an ``error`` and no histogram.
    """
    keys: list = list(by)
    if window:
        keys.append(time_bucket("ts", window).alias("window_start"))
    h = F.col(histogram)
    rows = metrics.filter(h.isNotNull()).select(
        *keys,
        *[h[c].alias(c) for c in ("count", "sum", "min", "max")],
        F.sha2(F.to_json(_bounds(h)), 256).alias("bounds"),  # a digest: the list itself would travel once per bucket
        F.posexplode_outer(_buckets(h)).alias("pos", "b"),
    )
    names = [*by, *(["window_start"] if window else [])]
    # Every histogram of a bound list is in each of its positions once, so the totals repeat per position.
    per_bound = rows.groupBy(*names, "bounds", "pos").agg(
        F.max("b.upper_bound").alias("upper_bound"),
        F.sum("b.count").alias("bucket_count"),
        F.count("*").alias("n"),
        F.sum("count").alias("count"),
        F.sum("sum").alias("sum"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )
    # At most one row per bucket of one bound list is collected here.
    bucket = F.when(F.col("pos").isNotNull(), F.struct("pos", "upper_bound", F.col("bucket_count").alias("count")))
    per_list = per_bound.groupBy(*names, "bounds").agg(
        *[F.max(c).alias(c) for c in ("n", "count", "sum", "min", "max")],
        F.array_sort(F.collect_list(bucket)).alias("buckets"),
    )
    merged = F.struct(
        "count",
        "sum",
        "min",
        "max",
        F.transform("buckets", lambda b: F.struct(b["upper_bound"], b["count"])).alias("buckets"),
    ).cast(HISTOGRAM_DDL)
    whole = per_list.groupBy(*names).agg(
        F.sum("n").alias("n"),
        F.equal_null(F.min("bounds"), F.max("bounds")).alias("_same"),
        F.max(F.struct("bounds", merged.alias("h"))).alias("_m"),
    )
    wrong = F.struct(F.lit("buckets").alias("field"), F.lit("bound lists differ").alias("reason")).cast(ERROR_DDL)
    return whole.select(
        *names,
        "n",
        F.when(F.col("_same"), F.col("_m.h")).alias(histogram),
        F.when(~F.col("_same"), wrong).alias("error"),
    )


def quantile_of(histogram: str | Column, q: float) -> Column:
    """Quantile by linear interpolation inside the bucket that holds rank ``q * count``.

    The first bucket starts at the minimum; the result stays inside [min, max]; the infinite bucket
    gives the maximum; no buckets or no values give NULL.
    """
    h = F.col(histogram) if isinstance(histogram, str) else histogram
    buckets = _buckets(h)
    rank = F.lit(float(q)) * h["count"]
    at = F.array_position(F.transform(buckets, lambda b: (b["count"] >= rank) & (b["count"] > 0)), F.lit(True))
    here = F.try_element_at(buckets, at.cast("int"))
    before = F.when(at > 1, F.try_element_at(buckets, (at - 1).cast("int")))
    low = F.coalesce(before["upper_bound"], h["min"], F.lit(0.0))
    below = F.coalesce(before["count"], F.lit(0))
    width = F.nullif(here["count"] - below, F.lit(0))
    inner = low + (here["upper_bound"] - low) * F.coalesce((rank - below) / width, F.lit(1.0))
    value = F.when(here["upper_bound"] == float("inf"), h["max"]).otherwise(inner)
    clamped = F.least(F.greatest(value, h["min"]), h["max"])
    return F.when((at > 0) & (h["count"] > 0), clamped)


def histogram_quantile(df: DataFrame, q: float, histogram: str = "histogram", out: str | None = None):
    """Add the ``q`` quantile of a histogram column."""
    name = out or f"p{q * 100:g}".replace(".", "_")
    return df.withColumn(name, quantile_of(histogram, q))


def bucketize(
    df: DataFrame, bounds: Sequence[float], value: str = "value", by: Sequence[str] = (), out: str = "histogram"
) -> DataFrame:
    """A cumulative histogram from raw values (``value <= bound``); an infinite bound is added if missing."""
    edges = sorted({float(b) for b in bounds} | {float("inf")})
    buckets = F.array(
        *[
            F.struct(F.lit(b).alias("upper_bound"), F.count_if(F.col(value) <= b).alias("count"))
            for b in edges
        ]
    )
    histogram = F.struct(
        F.count(value).alias("count"),
        F.sum(value).cast("double").alias("sum"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
        buckets.alias("buckets"),
    ).cast(HISTOGRAM_DDL)
    return df.groupBy(*by).agg(histogram.alias(out))
