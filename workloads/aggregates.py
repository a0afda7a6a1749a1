"""Counts, profiles, revenue, logs and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.operators.histograms import quantile_of
from signalyard.schemas import ENUMS
from workloads.registry import big, day_text, num, query, us
from workloads.row_rules import histogram_column

_DAY = "strftime(ts, '%Y-%m-%d')"

# --- events -----------------------------------------------------------------------------------------



def _within(estimate: str, exact: str, share: float):
    """Whether an estimate is close to the exact value of its group."""
    return F.abs(F.col(estimate) - F.col(exact)) <= share * F.abs(F.col(exact))


@query(
    "event_counts",
    f"SELECT event_name, service, {_DAY} AS day, COUNT(*) AS n FROM fx_track GROUP BY ALL",
    "fx_track",
)
def _(t):
    counts = op.event_counts(t.view("fx_track"), ["event_name", "service"], day=True)
    return counts.select("event_name", "service", day_text("day").alias("day"), "n")


for _period in ("day", "week", "month"):

    @query(
        f"active_users_{_period}",
        f"""SELECT service, strftime(date_trunc('{_period}', ts), '%Y-%m-%d') AS period,
            COUNT(DISTINCT user_id) AS active_users FROM fx_track GROUP BY ALL""",
        "fx_track",
    )
    def _(t, period=_period):
        counts = op.active_users(t.view("fx_track"), period, by=["service"])
        return counts.select("service", day_text("period").alias("period"), "active_users")


@query(
    "active_users_sketch",
    "SELECT service, COUNT(DISTINCT user_id) AS exact, true AS close FROM fx_track GROUP BY 1",
    "fx_track",
)
def _(t):
    sketches = op.user_sketches(t.view("fx_track"), "day", by=["service"])
    exact = t.view("fx_track").groupBy("service").agg(F.count_distinct("user_id").alias("exact"))
    merged = op.merge_user_sketches(sketches, period=None, by=["service"])
    both = merged.withColumn("active_users", op.estimated_users()).join(exact, "service")
    return both.select("service", "exact", _within("active_users", "exact", 0.05).alias("close"))


@query(
    "active_ratio",
    """, ud AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM fx_track),
       dau AS (SELECT day, COUNT(*) AS dau FROM ud GROUP BY 1)
       SELECT strftime(d.day, '%Y-%m-%d') AS day, d.dau, COUNT(DISTINCT u.user_id) AS mau,
         round(d.dau / COUNT(DISTINCT u.user_id), 6) AS ratio
       FROM dau d JOIN ud u ON u.day <= d.day AND u.day > d.day - 30 GROUP BY d.day, d.dau""",
    "fx_track",
)
def _(t):
    ratio = op.active_ratio(t.view("fx_track"), days=30)
    return ratio.select(day_text("day").alias("day"), big("dau").alias("dau"), big("mau").alias("mau"), num("ratio").alias("ratio"))


@query(
    "throughput",
    """SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_us, COUNT(*) AS n,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS elapsed_seconds,
       round(COUNT(*) / NULLIF((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 6) AS per_second
       FROM fx_track GROUP BY 1""",
    "fx_track",
)
def _(t):
    rows = op.throughput(t.view("fx_track"), "1 hour")
    return rows.select(
        us("window_start").alias("window_us"), "n", num("elapsed_seconds").alias("elapsed_seconds"), num("per_second").alias("per_second")
    )


@query(
    "wire_volume",
    """, p AS (SELECT service, strlen('{"user_id":"' || user_id || '","k":' || k || '}') AS pb,
         strlen(service) + strlen(event_name) AS vb FROM fx_track)
       SELECT service, COUNT(*) AS n, CAST(sum(pb) AS BIGINT) AS payload_bytes,
         CAST(sum(pb + vb + 128) AS BIGINT) AS wire_bytes, round(avg(pb + vb + 128), 6) AS mean_wire_bytes
       FROM p GROUP BY 1""",
    "fx_track",
)
def _(t):
    rows = op.wire_volume(op.track_payload(t.view("fx_track")), by=["service"])
    return rows.withColumn("mean_wire_bytes", num("mean_wire_bytes"))


@query(
    "latency_summary",
    """, r AS (SELECT event_name, value, row_number() OVER (PARTITION BY event_name ORDER BY value) - 1 AS i,
         COUNT(*) OVER (PARTITION BY event_name) AS n FROM fx_track)
       SELECT event_name, n, round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max,
         max(CASE WHEN i = n // 2 THEN value END) AS p50, max(CASE WHEN i = n * 99 // 100 THEN value END) AS p99
       FROM r GROUP BY event_name, n""",
    "fx_track",
)
def _(t):
    rows = op.latency_summary(t.view("fx_track"), "value", ["event_name"])
    return rows.withColumn("avg", num("avg"))


@query(
    "latency_sketch",
    """, r AS (SELECT event_name, value, row_number() OVER (PARTITION BY event_name ORDER BY value) - 1 AS i,
         COUNT(*) OVER (PARTITION BY event_name) AS n FROM fx_track)
       SELECT event_name, n, max(CASE WHEN i = n // 2 THEN value END) AS p50, max(CASE WHEN i = n * 99 // 100 THEN value END) AS p99,
         true AS close FROM r GROUP BY event_name, n""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track")
    exact = op.latency_summary(rows, "value", ["event_name"]).select("event_name", "n", "p50", "p99")
    sketch = op.latency_sketch(rows, "value", ["event_name"]).select(
        "event_name", F.col("n").alias("_n"), F.col("p50").alias("_p50"), F.col("p99").alias("_p99")
    )
    close = (F.col("n") == F.col("_n")) & _within("_p50", "p50", 0.05) & _within("_p99", "p99", 0.05)
    return exact.join(sketch, "event_name").select("event_name", "n", "p50", "p99", close.alias("close"))


_PLAN_EVENT = (
    "CASE k % 6 WHEN 0 THEN 'Subscription Started' WHEN 1 THEN 'Subscription Renewed' WHEN 2 THEN 'Subscription Paused' "
    "WHEN 3 THEN 'Subscription Resumed' WHEN 4 THEN 'Subscription Changed' ELSE 'Subscription Canceled' END"
)


@query(
    "subscription_state",
    f""", s AS (SELECT user_id, ts, {_PLAN_EVENT} AS name FROM fx_track),
       l AS (SELECT user_id, arg_max(name, ts) AS last_event, max(ts) AS since FROM s GROUP BY 1)
       SELECT user_id, last_event, epoch_us(since) AS since_us, CASE last_event WHEN 'Subscription Paused' THEN 'paused'
         WHEN 'Subscription Canceled' THEN 'canceled' ELSE 'active' END AS state FROM l""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").selectExpr("user_id", "ts", "seq", f"{_PLAN_EVENT} AS event_name")
    return op.subscription_state(rows).select("user_id", "last_event", us("since").alias("since_us"), "state")


_MAIL_EVENT = (
    "CASE k % 9 WHEN 0 THEN 'Email Opened' WHEN 1 THEN 'Email Clicked' WHEN 2 THEN 'Email Bounced' "
    "WHEN 3 THEN 'Email Unsubscribed' WHEN 4 THEN 'Notification Sent' WHEN 5 THEN 'Notification Clicked' ELSE 'Email Sent' END"
)


@query(
    "engagement_rates",
    f""", m AS (SELECT service, user_id || '/' || CAST(ts AS DATE) AS unit, {_MAIL_EVENT} AS name FROM fx_track),
       c AS (SELECT service, COUNT(DISTINCT unit) FILTER (name = 'Email Sent') AS emails_sent,
         COUNT(DISTINCT unit) FILTER (name = 'Email Opened') AS emails_opened,
         COUNT(DISTINCT unit) FILTER (name = 'Email Clicked') AS emails_clicked,
         COUNT(DISTINCT unit) FILTER (name = 'Email Bounced') AS emails_bounced,
         COUNT(DISTINCT unit) FILTER (name = 'Email Unsubscribed') AS emails_unsubscribed,
         COUNT(DISTINCT unit) FILTER (name = 'Notification Sent') AS notifications_sent,
         COUNT(DISTINCT unit) FILTER (name = 'Notification Clicked') AS notifications_clicked FROM m GROUP BY 1)
       SELECT *, round(emails_opened / emails_sent, 6) AS open_rate, round(emails_clicked / emails_opened, 6) AS click_rate,
         round(emails_bounced / emails_sent, 6) AS bounce_rate, round(emails_unsubscribed / emails_sent, 6) AS unsubscribe_rate,
         round(notifications_clicked / notifications_sent, 6) AS notification_click_rate FROM c""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").selectExpr("service", "concat(user_id, '/', CAST(ts AS DATE)) AS unit", f"{_MAIL_EVENT} AS event_name")
    rates = op.engagement_rates(rows, by=["service"], unit="unit")
    return rates.select(*[num(c).alias(c) if c.endswith("_rate") else F.col(c) for c in rates.columns])


# --- profiles and groups ----------------------------------------------------------------------------


@query(
    "user_profiles",
    """, l AS (SELECT user_id, arg_max(plan, ts) AS plan, arg_max(k, ts) FILTER (k % 2 = 0) AS even, max(ts) AS newest
         FROM fx_identify GROUP BY 1)
       SELECT user_id, plan, even, epoch_us(newest) AS updated_us FROM l""",
    "fx_identify",
)
def _(t):
    even = F.when(F.col("k") % 2 == 0, F.col("k")).alias("even")
    built = op.identify_payload(t.view("fx_identify").withColumn("traits", F.struct("plan", even)))
    rows = op.user_profiles(built)
    typed = op.extract_props(rows, "plan string, even int", payload="traits")
    return typed.select("user_id", "plan", "even", us("updated_at").alias("updated_us"))


@query(
    "group_profiles",
    "SELECT group_id, arg_max(k, ts) AS k, epoch_us(max(ts)) AS updated_us FROM fx_group GROUP BY 1",
    "fx_group",
)
def _(t):
    built = op.group_payload(t.view("fx_group").withColumn("props", F.struct("k")))
    rows = op.extract_props(op.group_profiles(built), "k int", payload="traits")
    return rows.select("group_id", "k", us("updated_at").alias("updated_us"))


@query(
    "group_members",
    """, cur AS (SELECT user_id, arg_max(group_id, ts) AS group_id FROM fx_group GROUP BY 1),
       c AS (SELECT group_id, COUNT(*) AS n FROM cur GROUP BY 1)
       SELECT g.group_id, COUNT(DISTINCT user_id) AS members, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us,
         COALESCE(max(c.n), 0) AS current_members FROM fx_group g LEFT JOIN c USING (group_id) GROUP BY 1""",
    "fx_group",
)
def _(t):
    rows = op.group_members(t.view("fx_group"))
    return rows.select(
        "group_id", "members", us("first_joined").alias("first_us"), us("last_joined").alias("last_us"), "current_members"
    )


# --- revenue ------------------------------------------------------------------------------------------


@query(
    "revenue_summary",
    f"""SELECT {_DAY} AS day, currency, COUNT(*) AS orders, round(sum(amount), 2) AS revenue,
        round(sum(amount) / COUNT(*), 6) AS avg_order_value, COUNT(DISTINCT user_id) AS payers
        FROM fx_revenue GROUP BY ALL""",
    "fx_revenue",
)
def _(t):
    rows = op.revenue_summary(t.view("fx_revenue").withColumn("day", day_text("ts")), by=["day"])
    return rows.withColumns({"revenue": num("revenue", 2), "avg_order_value": num("avg_order_value")})


_CUBE_SQL = f"""SELECT currency, {_DAY} AS day, service, COUNT(*) AS orders, round(sum(amount), 2) AS revenue,
    CAST(grouping_id(currency, {_DAY}, service) AS BIGINT) AS grouping_id FROM fx_revenue"""


def _cube(t, mode):
    rows = op.revenue_cube(t.view("fx_revenue").withColumn("day", day_text("ts")), ["day", "service"], mode)
    return rows.withColumn("revenue", num("revenue", 2))


@query("revenue_rollup", f"{_CUBE_SQL} GROUP BY currency, ROLLUP ({_DAY}, service)", "fx_revenue")
def _(t):
    return _cube(t, "rollup")


@query("revenue_cube", f"{_CUBE_SQL} GROUP BY currency, CUBE ({_DAY}, service)", "fx_revenue")
def _(t):
    return _cube(t, "cube")


@query(
    "revenue_grouping_sets",
    f"{_CUBE_SQL} GROUP BY GROUPING SETS ((currency, {_DAY}), (currency, service))",
    "fx_revenue",
)
def _(t):
    return _cube(t, [["day"], ["service"]])


@query(
    "running_revenue",
    """SELECT order_id, row_number() OVER w AS order_no, round(sum(amount) OVER w, 2) AS revenue_to_date,
       round((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 86400e6, 6) AS days_since_previous
       FROM fx_revenue WINDOW w AS (PARTITION BY user_id, currency ORDER BY ts, seq)""",
    "fx_revenue",
)
def _(t):
    rows = op.running_revenue(t.view("fx_revenue"))
    return rows.select(
        "order_id", big("order_no").alias("order_no"), num("revenue_to_date", 2).alias("revenue_to_date"),
        num("days_since_previous").alias("days_since_previous"),
    )


@query(
    "running_revenue_orders",
    """SELECT o_orderkey, row_number() OVER w AS order_no, round(sum(o_totalprice) OVER w, 2) AS revenue_to_date
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(t):
    orders = t.base("orders").selectExpr(
        "o_orderkey AS seq", "CAST(o_orderdate AS TIMESTAMP) AS ts", "o_custkey AS user_id", "o_totalprice AS amount", "'USD' AS currency"
    )
    rows = op.running_revenue(orders)
    return rows.select(F.col("seq").alias("o_orderkey"), big("order_no").alias("order_no"), num("revenue_to_date", 2).alias("revenue_to_date"))


# --- logs ---------------------------------------------------------------------------------------------


@query(
    "log_counts",
    f"""SELECT component, epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS window_us, COUNT(*) AS n,
        {", ".join(f"COUNT(*) FILTER (level = {c}) AS {n}" for c, n in ENUMS["level"].items())} FROM fx_log GROUP BY 1, 2""",
    "fx_log",
)
def _(t):
    rows = op.log_counts(t.view("fx_log"), ["component"], "1 day")
    return rows.withColumn("window_us", us("window_start")).drop("window_start")


@query(
    "error_rate",
    """SELECT component, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_us, COUNT(*) AS n,
       COUNT(*) FILTER (level <= 3) AS errors, round(COUNT(*) FILTER (level <= 3) / COUNT(*), 6) AS error_rate
       FROM fx_log GROUP BY 1, 2""",
    "fx_log",
)
def _(t):
    rows = op.error_rate(t.view("fx_log"), ["component"], "1 hour")
    return rows.select("component", us("window_start").alias("window_us"), "n", "errors", num("error_rate").alias("error_rate"))


# --- metrics --------------------------------------------------------------------------------------------


def gauges(t):
    """Gauge samples with their label as the series."""
    return t.view("fx_gauge").withColumn(
        "labels", F.array(F.struct(F.lit("type").alias("key"), F.col("label_type").alias("value")))
    )


@query(
    "gauge_stats",
    """SELECT label_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_us, COUNT(*) AS n, arg_max(value, ts) AS last,
       min(value) AS min, max(value) AS max, round(avg(value), 6) AS avg FROM fx_gauge GROUP BY 1, 2""",
    "fx_gauge",
)
def _(t):
    rows = op.gauge_stats(gauges(t).withColumn("series_key", F.col("label_type")), "1 hour")
    return rows.select(
        F.col("series_key").alias("label_type"), us("window_start").alias("window_us"), "n", "last", "min", "max", num("avg").alias("avg")
    )


@query(
    "counter_sum",
    """SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS window_us, COUNT(*) AS n, round(sum(value), 2) AS total
       FROM fx_gauge GROUP BY 1""",
    "fx_gauge",
)
def _(t):
    rows = op.counter_sum(gauges(t), "1 day", by=[])
    return rows.select(us("window_start").alias("window_us"), "n", num("total", 2).alias("total"))


_STEPS_SQL = """, p AS (SELECT *, lag(value) OVER (PARTITION BY name, source ORDER BY ts, seq) AS prev FROM fx_counter),
    steps AS (SELECT *, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS step FROM p)"""


@query(
    "counter_increase",
    _STEPS_SQL
    + """ SELECT source, epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS window_us, COUNT(*) AS n, sum(step) AS increase,
      round(sum(step) / 86400, 9) AS rate FROM steps GROUP BY 1, 2""",
    "fx_counter",
)
def _(t):
    series = t.view("fx_counter").withColumn("series_key", F.col("source"))
    rows = op.counter_increase(series, "1 day")
    return rows.select(
        F.col("series_key").alias("source"), us("window_start").alias("window_us"), "n", "increase", num("rate", 9).alias("rate")
    )


@query(
    "counter_normalize",
    _STEPS_SQL
    + """, mixed AS (SELECT seq, step AS value, NULL AS reason FROM steps
        UNION ALL SELECT -1 - seq, value, CASE WHEN label_type = 'error' THEN 'is unspecified' END FROM fx_gauge)
      SELECT seq, value, reason FROM mixed""",
    "fx_counter fx_gauge",
)
def _(t):
    cumulative = t.view("fx_counter").select("seq", "ts", "name", "source", "value", F.lit("cumulative").alias("temporality"))
    temporality = F.when(F.col("label_type") == "error", "unspecified").otherwise("delta").alias("temporality")
    deltas = t.view("fx_gauge").select(
        (-1 - F.col("seq")).alias("seq"), "ts", "name", F.col("label_type").alias("source"), "value", temporality
    )
    rows = op.counter_normalize(cumulative.unionByName(deltas))
    return rows.select("seq", "value", F.col("error.reason").alias("reason"))


def histograms(t):
    """Daily histograms per label as delta histogram metrics."""
    return t.view("fx_hist").select(
        F.lit("app.value").alias("name"),
        "label_type",
        F.col("day").alias("ts"),
        F.lit("delta").alias("temporality"),
        histogram_column().alias("histogram"),
    )


_HIST_OUT = """round(sum(total), 2) AS sum, min(lo) AS min, max(hi) AS max, CAST(sum(n) AS BIGINT) AS count,
    CAST(sum(le_5) AS BIGINT) AS le_5, CAST(sum(le_25) AS BIGINT) AS le_25, CAST(sum(le_100) AS BIGINT) AS le_100,
    CAST(sum(le_inf) AS BIGINT) AS le_inf"""


def _flat(rows, *keys):
    b = F.col("histogram.buckets")
    return rows.select(
        *keys,
        num("histogram.sum", 2).alias("sum"),
        F.col("histogram.min").alias("min"),
        F.col("histogram.max").alias("max"),
        F.col("histogram.count").alias("count"),
        *[b[i]["count"].alias(c) for i, c in enumerate(("le_5", "le_25", "le_100", "le_inf"))],
    )


@query(
    "histogram_merge",
    f"SELECT label_type, epoch_us(time_bucket(INTERVAL 10 DAY, day, TIMESTAMP '1970-01-01')) AS window_us, {_HIST_OUT} FROM fx_hist GROUP BY 1, 2",
    "fx_hist",
)
def _(t):
    merged = op.histogram_merge(histograms(t), ["label_type"], "10 days")
    return _flat(merged, "label_type", us("window_start").alias("window_us"))


_Q_SQL = """, h AS (SELECT day, CAST(sum(n) AS DOUBLE) AS n, min(lo) AS lo, max(hi) AS hi, sum(le_5) AS a, sum(le_25) AS b,
      sum(le_100) AS c FROM fx_hist GROUP BY 1),
    v AS (SELECT day, lo, hi, 0.9 * n AS r, a, b, c FROM h),
    q AS (SELECT day, lo, hi, CASE WHEN a >= r AND a > 0 THEN lo + (5 - lo) * r / a
      WHEN b >= r AND b > 0 THEN 5 + 20 * (r - a) / (b - a) WHEN c >= r AND c > 0 THEN 25 + 75 * (r - b) / (c - b)
      ELSE hi END AS x FROM v)
    SELECT strftime(day, '%Y-%m-%d') AS day, round(least(greatest(x, lo), hi), 6) AS p90 FROM q"""


@query("histogram_quantile", _Q_SQL, "fx_hist")
def _(t):
    merged = op.histogram_merge(histograms(t).withColumn("day", day_text("ts")), ["day"])
    return op.histogram_quantile(merged, 0.9).select("day", num("p90").alias("p90"))


@query(
    "histogram_increase",
    """, c AS (SELECT label_type, day, sum(n) OVER w AS n, sum(le_25) OVER w AS le_25, sum(total) OVER w AS total FROM fx_hist
         WINDOW w AS (PARTITION BY label_type ORDER BY day)),
       p AS (SELECT *, lag(n) OVER w AS pn, lag(le_25) OVER w AS pb, lag(total) OVER w AS pt FROM c
         WINDOW w AS (PARTITION BY label_type ORDER BY day))
       SELECT label_type, strftime(day, '%Y-%m-%d') AS day, CAST(COALESCE(n - pn, 0) AS BIGINT) AS count,
         CAST(COALESCE(le_25 - pb, 0) AS BIGINT) AS le_25, round(COALESCE(total - pt, 0), 2) AS sum FROM p""",
    "fx_hist",
)
def _(t):
    from pyspark.sql import Window

    so_far = Window.partitionBy("label_type").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    columns = ("n", "total", "le_5", "le_25", "le_100", "le_inf")
    # Thirty daily rows per label: building the cumulative samples needs no care.
    grown = t.view("fx_hist").withColumns({c: F.sum(c).over(so_far) for c in columns})
    rows = grown.select(
        F.lit("app.value").alias("name"),
        F.col("label_type").alias("source"),
        F.col("day").alias("ts"),
        F.lit("cumulative").alias("temporality"),
        histogram_column().alias("histogram"),
    )
    added = op.histogram_increase(rows)
    return added.select(
        F.col("source").alias("label_type"),
        day_text("ts").alias("day"),
        F.col("histogram.count").alias("count"),
        F.col("histogram.buckets")[1]["count"].alias("le_25"),
        num("histogram.sum", 2).alias("sum"),
    )


@query(
    "bucketize",
    """SELECT label_type, COUNT(*) AS count, round(sum(value), 2) AS sum, min(value) AS min, max(value) AS max,
       COUNT(*) FILTER (value <= 5) AS le_5, COUNT(*) FILTER (value <= 25) AS le_25, COUNT(*) FILTER (value <= 100) AS le_100,
       COUNT(*) AS le_inf FROM fx_gauge GROUP BY 1""",
    "fx_gauge",
)
def _(t):
    return _flat(op.bucketize(t.view("fx_gauge"), [5, 25, 100], by=["label_type"]), "label_type")


@query(
    "bucketize_quantile",
    """, h AS (SELECT label_type, COUNT(*) AS n, min(value) AS lo, max(value) AS hi, COUNT(*) FILTER (value <= 10) AS a FROM fx_gauge GROUP BY 1)
       SELECT label_type, round(CASE WHEN a >= 0.1 * n THEN greatest(least(lo + (10 - lo) * 0.1 * n / a, hi), lo) ELSE hi END, 6) AS p10 FROM h""",
    "fx_gauge",
)
def _(t):
    rows = op.bucketize(t.view("fx_gauge"), [10], by=["label_type"])
    return rows.select("label_type", num(quantile_of("histogram", 0.1)).alias("p10"))


@query(
    "sorted_buckets",
    "SELECT label_type, strftime(day, '%Y-%m-%d') AS day, '5.0,25.0,100.0,Infinity' AS bounds, le_5 AS first FROM fx_hist",
    "fx_hist",
)
def _(t):
    shuffled = F.col("histogram").withField("buckets", F.reverse("histogram.buckets"))
    rows = op.sorted_buckets(histograms(t).withColumn("histogram", shuffled))
    bounds = F.array_join(F.transform("histogram.buckets", lambda b: b["upper_bound"].cast("string")), ",")
    return rows.select(
        "label_type", day_text("ts").alias("day"), bounds.alias("bounds"), F.col("histogram.buckets")[0]["count"].alias("first")
    )


@query(
    "series_cardinality",
    "SELECT name, COUNT(DISTINCT source) AS n_series FROM fx_counter GROUP BY 1",
    "fx_counter",
)
def _(t):
    return op.series_cardinality(t.view("fx_counter"), exact=True)


@query(
    "series_cardinality_sketch",
    "SELECT name, COUNT(DISTINCT source) AS exact, true AS close FROM fx_counter GROUP BY 1",
    "fx_counter",
)
def _(t):
    exact = op.series_cardinality(t.view("fx_counter"), exact=True).withColumnRenamed("n_series", "exact")
    both = op.series_cardinality(t.view("fx_counter")).join(exact, "name")
    return both.select("name", "exact", _within("n_series", "exact", 0.15).alias("close"))


@query(
    "label_cardinality",
    "SELECT name, 'type' AS label, COUNT(DISTINCT label_type) AS n_values FROM fx_gauge GROUP BY 1",
    "fx_gauge",
)
def _(t):
    return op.label_cardinality(gauges(t), exact=True)


@query(
    "moving_gauge_rows",
    """SELECT seq, COUNT(*) OVER w AS n, round(avg(value) OVER w, 6) AS mean, min(value) OVER w AS min, max(value) OVER w AS max
       FROM fx_gauge WINDOW w AS (PARTITION BY label_type ORDER BY ts, seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    "fx_gauge",
)
def _(t):
    rows = op.moving_gauge(gauges(t), rows=10)
    return rows.select("seq", "n", num("mean").alias("mean"), "min", "max")


@query(
    "moving_gauge_interval",
    """SELECT label_type, epoch_us(ts) AS us, COUNT(*) OVER w AS n, round(avg(value) OVER w, 6) AS mean, min(value) OVER w AS min,
       max(value) OVER w AS max FROM fx_gauge
       WINDOW w AS (PARTITION BY label_type ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)""",
    "fx_gauge",
)
def _(t):
    rows = op.moving_gauge(gauges(t).withColumn("series_key", F.col("label_type")), interval="6 hours")
    return rows.select(F.col("series_key").alias("label_type"), us("ts").alias("us"), "n", num("mean").alias("mean"), "min", "max")


# --- properties -------------------------------------------------------------------------------------------

# Payloads with a key that is missing in a fifth of the rows and has three types, and with one of two other keys.
_PROPS = """, p AS (SELECT event_name, 'k' AS key, CASE k % 3 WHEN 0 THEN 'x' WHEN 1 THEN CAST(k AS VARCHAR) ELSE 'true' END AS value,
        CASE k % 3 WHEN 0 THEN 'string' WHEN 1 THEN 'number' ELSE 'boolean' END AS t FROM fx_track WHERE k % 5 <> 0
      UNION ALL SELECT event_name, CASE WHEN k % 2 = 0 THEN 'even' ELSE 'odd' END, CASE WHEN k % 2 = 0 THEN '[1]' ELSE '[]' END, 'array'
        FROM fx_track),
    f AS (SELECT event_name, key, COUNT(*) AS n_filled, string_agg(DISTINCT t, ',' ORDER BY t) AS json_types FROM p GROUP BY ALL),
    a AS (SELECT event_name, COUNT(*) AS n_rows FROM fx_track GROUP BY 1),
    c AS (SELECT event_name, key, value, COUNT(*) AS c FROM p GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY event_name, key ORDER BY c DESC, value) AS rn FROM c)"""


def mixed_payloads(t):
    k = F.when(F.col("k") % 3 == 0, '"x"').when(F.col("k") % 3 == 1, F.col("k").cast("string")).otherwise("true")
    first = F.when(F.col("k") % 5 != 0, F.concat(F.lit('"k":'), k, F.lit(",")))
    second = F.when(F.col("k") % 2 == 0, '"even":[1]}').otherwise('"odd":[]}')
    payload = F.concat(F.lit("{"), F.coalesce(first, F.lit("")), second)
    return t.view("fx_track").select("event_name", payload.alias("payload"))


@query(
    "prop_stats",
    _PROPS
    + """ SELECT event_name, key, n_filled, n_filled / n_rows AS fill_rate, COUNT(*) AS n_distinct, json_types,
      max(CASE WHEN rn = 1 THEN value END) AS top_value, max(CASE WHEN rn = 1 THEN c END) AS top_n
      FROM r JOIN f USING (event_name, key) JOIN a USING (event_name) GROUP BY ALL""",
    "fx_track",
)
def _(t):
    rows = op.prop_stats(mixed_payloads(t))
    return rows.select(
        "event_name", "key", "n_filled", "fill_rate", "n_distinct", F.array_join("json_types", ",").alias("json_types"),
        F.col("top_values")[0]["value"].alias("top_value"), F.col("top_values")[0]["n"].alias("top_n"),
    )


@query(
    "distinct_props",
    """, p AS (SELECT DISTINCT event_name, concat('p', k % 9) AS key, CASE WHEN k % 9 < 4 THEN 'BIGINT' ELSE 'STRING' END AS t
         FROM fx_track WHERE (k + length(event_name)) % 3 <> 0)
       SELECT event_name, string_agg(key, ',' ORDER BY key) AS keys,
         concat('OBJECT<', string_agg(concat(key, ': ', t), ', ' ORDER BY key), '>') AS schema FROM p GROUP BY 1""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").filter((F.col("k") + F.length("event_name")) % 3 != 0)
    value = F.when(F.col("k") % 9 < 4, F.col("k").cast("string")).otherwise(F.concat(F.lit('"v'), "k", F.lit('"')))
    payload = F.concat(F.lit('{"p'), F.col("k") % 9, F.lit('":'), value, F.lit("}"))
    found = op.distinct_props(rows.select("event_name", payload.alias("payload")))
    return found.select("event_name", F.array_join("keys", ",").alias("keys"), "schema")


@query(
    "property_registry",
    """SELECT event_name, 'k' AS key, CASE WHEN k % 3 = 0 THEN 'string' WHEN k % 3 = 1 THEN 'number' ELSE 'boolean' END AS json_type,
         COUNT(*) AS n FROM fx_track WHERE k % 5 <> 0 GROUP BY ALL
       UNION ALL SELECT event_name, CASE WHEN k % 2 = 0 THEN 'even' ELSE 'odd' END, 'array', COUNT(*) FROM fx_track GROUP BY ALL""",
    "fx_track",
)
def _(t):
    return op.property_registry(mixed_payloads(t))


@query(
    "prop_stats_urls",
    """, u AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, url FROM pages),
       g AS (SELECT host, COUNT(*) AS n_filled, COUNT(DISTINCT url) AS n_distinct FROM u GROUP BY 1)
       SELECT host AS event_name, 'url' AS key, n_filled, n_distinct FROM g""",
    "fx_track",
)
def _(t):
    rows = t.base("pages").select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("event_name"), F.to_json(F.struct("url")).alias("payload")
    )
    return op.prop_stats(rows).select("event_name", "key", "n_filled", "n_distinct")


# --- totals kept up batch by batch ------------------------------------------------------------------------


@query("event_counts_maintained", "SELECT event_name, strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n FROM fx_track GROUP BY ALL", "fx_track")
def _(t):
    """Two batches; the second also has rows of the first again, after up to thirty days."""
    events = t.view("fx_track").select("seq", "ts", "event_name", "k")
    table = op.DailyCounts(t.spark, t.scratch(), {"event_name": "string"}, buckets=8)
    table.fold(events.filter("k % 3 <> 0"))
    table.fold(events.filter("k % 3 = 0").unionByName(events.filter("k % 2 = 0")))
    return table.counts().select("event_name", day_text("day").alias("day"), "n")


@query(
    "revenue_maintained",
    """, b AS (SELECT order_id, sum(amount) AS refunded FROM fx_refund GROUP BY 1)
       SELECT strftime(r.ts, '%Y-%m-%d') AS day, currency, COUNT(*) AS orders, round(sum(amount), 3) AS gross,
         round(sum(COALESCE(refunded, 0)), 3) AS refunded, round(sum(amount - COALESCE(refunded, 0)), 3) AS net
       FROM fx_revenue r LEFT JOIN b USING (order_id) GROUP BY ALL""",
    "fx_revenue fx_refund",
)
def _(t):
    """Some orders come first with a later time and another amount, and refunds come before, with and after their orders."""
    orders = t.view("fx_revenue").select("order_id", "ts", "seq", "amount", "currency", "k")
    refunds = t.view("fx_refund")
    table = op.DailyRevenue(t.spark, t.scratch(), seq="bigint", buckets=8)
    wrong = orders.filter("k % 4 = 0").selectExpr("order_id", "ts + INTERVAL 3 DAYS AS ts", "seq", "amount + 1 AS amount", "currency", "k")
    table.fold(wrong.unionByName(orders.filter("k % 4 = 1")), refunds.filter("seq % 3 < 2"), ["seq", "ts"])
    table.fold(orders.filter("k % 4 <> 1"), refunds.filter("seq % 3 > 0"), ["seq", "ts"])
    table.fold(orders.filter("k % 5 = 0"), refunds, ["seq", "ts"])
    kept = table.totals()
    return kept.select(day_text("day").alias("day"), "currency", big("orders").alias("orders"), *[num(c, 3).alias(c) for c in ("gross", "refunded", "net")])
