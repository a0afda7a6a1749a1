"""Sessions, sequences, funnels, retention, rankings, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.session import durable
from workloads.registry import big, day_text, num, query, us

# --- sessions and sequences ---------------------------------------------------------------------------

_GAP_SQL = """, p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) AS prev FROM fx_track),
    n AS (SELECT *, CAST(sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 6 HOUR THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts, seq) AS BIGINT) AS session_no FROM p)"""


@query("sessionize_gap", _GAP_SQL + " SELECT seq, session_no FROM n", "fx_track")
def _(t):
    return op.sessionize_gap(t.view("fx_track"), "6 hours").select("seq", big("session_no").alias("session_no"))


GAP_SESSIONS_SQL = (
    _GAP_SQL
    + """ SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, COUNT(*) AS n_events
     FROM n GROUP BY user_id, session_no"""
)


@query("gap_sessions", GAP_SESSIONS_SQL, "fx_track")
def _(t):
    rows = op.gap_sessions(t.view("fx_track"), "6 hours")
    return rows.select("user_id", us("session_start").alias("start_us"), us("session_end").alias("end_us"), "n_events")


@query(
    "sessionize_reset",
    """, r AS (SELECT device_id, ts FROM fx_track WHERE event_name = 'User Signed Up')
       SELECT e.seq, COUNT(r.ts) AS session_no FROM fx_track e LEFT JOIN r ON e.device_id = r.device_id AND r.ts <= e.ts
       GROUP BY e.seq""",
    "fx_track",
)
def _(t):
    track = t.view("fx_track")
    resets = track.filter("event_name = 'User Signed Up'")
    return op.sessionize_reset(track.select("seq", "ts", "device_id"), resets).select(
        "seq", big("session_no").alias("session_no")
    )


@query(
    "event_sequence",
    """SELECT seq, row_number() OVER w AS step, lag(event_name) OVER w AS previous_event, lead(event_name) OVER w AS next_event,
       round((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6, 6) AS seconds_since_previous
       FROM fx_track WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq)""",
    "fx_track",
)
def _(t):
    rows = op.event_sequence(t.view("fx_track").select("seq", "ts", "user_id", "event_name"))
    return rows.select(
        "seq", big("step").alias("step"), "previous_event", "next_event", num("seconds_since_previous").alias("seconds_since_previous")
    )


@query(
    "first_last_touch",
    """SELECT user_id, arg_min(component, ts) AS first_touch, arg_max(component, ts) AS last_touch,
       epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us
       FROM (SELECT l.*, t.user_id FROM fx_log l JOIN fx_track t USING (seq)) WHERE component IS NOT NULL GROUP BY 1""",
    "fx_log fx_track",
)
def _(t):
    rows = t.view("fx_track").select("seq", "ts", "user_id").join(t.view("fx_log").select("seq", "component"), "seq")
    touch = op.first_last_touch(rows, "component")
    return touch.select(
        "user_id", "first_touch", "last_touch", us("first_touch_at").alias("first_us"), us("last_touch_at").alias("last_us")
    )


@query(
    "session_summary",
    """, s AS (SELECT session_id, ts, event_name, NULL AS level FROM fx_track
         UNION ALL SELECT session_id, ts, NULL, level FROM fx_log)
       SELECT session_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us,
         round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS seconds, COUNT(event_name) AS n_events,
         COUNT(level) AS n_logs, min(level) AS worst_level, COUNT(*) FILTER (level <= 3) AS n_errors,
         arg_min(event_name, ts) AS entry_event, arg_max(event_name, ts) AS exit_event FROM s GROUP BY 1""",
    "fx_track fx_log",
)
def _(t):
    rows = op.session_summary(t.view("fx_track"), t.view("fx_log"))
    return rows.select(
        "session_id", us("session_start").alias("start_us"), us("session_end").alias("end_us"), num("seconds").alias("seconds"),
        "n_events", "n_logs", "worst_level", "n_errors", "entry_event", "exit_event",
    )


@query(
    "paths",
    """, r AS (SELECT session_id, event_name, row_number() OVER (PARTITION BY session_id ORDER BY ts, seq) AS rn FROM fx_track),
       p AS (SELECT session_id, string_agg(event_name, ' > ' ORDER BY rn) AS path FROM r WHERE rn <= 3 GROUP BY 1)
       SELECT path, COUNT(*) AS n FROM p GROUP BY 1""",
    "fx_track",
)
def _(t):
    return op.paths(t.view("fx_track"), depth=3).select(F.array_join("path", " > ").alias("path"), "n")


# --- funnels, retention -----------------------------------------------------------------------------------

_STEPS = ["Page Viewed", "Feature Used", "Order Completed"]
_FUNNEL_SQL = """, s1 AS (SELECT user_id, min(ts) AS t1 FROM fx_track WHERE event_name = 'Page Viewed' GROUP BY 1),
    s2 AS (SELECT s1.user_id, t1, min(e.ts) AS t2 FROM s1 LEFT JOIN fx_track e ON e.user_id = s1.user_id
      AND e.event_name = 'Feature Used' AND e.ts > t1 AND e.ts <= t1 + INTERVAL 3 DAY GROUP BY 1, 2),
    s3 AS (SELECT s2.user_id, t1, t2, min(e.ts) AS t3 FROM s2 LEFT JOIN fx_track e ON e.user_id = s2.user_id
      AND e.event_name = 'Order Completed' AND e.ts > t2 AND e.ts <= t1 + INTERVAL 3 DAY GROUP BY 1, 2, 3)"""


@query(
    "funnel_users",
    _FUNNEL_SQL + " SELECT user_id, epoch_us(t1) AS t1, epoch_us(t2) AS t2, epoch_us(t3) AS t3 FROM s3",
    "fx_track",
)
def _(t):
    rows = op.funnel_users(t.view("fx_track"), _STEPS, "3 days")
    return rows.select("user_id", *[us(c).alias(c) for c in ("t1", "t2", "t3")])


@query(
    "funnel",
    _FUNNEL_SQL
    + """, x AS (SELECT 1 AS step, 'Page Viewed' AS event_name, 0.0 AS s FROM s3
        UNION ALL SELECT 2, 'Feature Used', (epoch_us(t2) - epoch_us(t1)) / 1e6 FROM s3 WHERE t2 IS NOT NULL
        UNION ALL SELECT 3, 'Order Completed', (epoch_us(t3) - epoch_us(t1)) / 1e6 FROM s3 WHERE t3 IS NOT NULL),
      r AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY s) - 1 AS i, COUNT(*) OVER (PARTITION BY step) AS n FROM x),
      g AS (SELECT step, event_name, n AS users, max(CASE WHEN i = n // 2 THEN s END) AS m FROM r GROUP BY 1, 2, 3)
      SELECT step, event_name, users, round(users / first_value(users) OVER (ORDER BY step), 6) AS rate_from_first,
        round(users / COALESCE(lag(users) OVER (ORDER BY step), users), 6) AS rate_from_previous,
        round(m, 6) AS median_seconds FROM g""",
    "fx_track",
)
def _(t):
    rows = op.funnel(t.view("fx_track"), _STEPS, "3 days")
    return rows.select(
        "step", "event_name", "users", num("rate_from_first").alias("rate_from_first"),
        num("rate_from_previous").alias("rate_from_previous"), num("median_seconds").alias("median_seconds"),
    )


@query(
    "retention",
    """, c AS (SELECT user_id, min(date_trunc('week', ts)) AS cohort FROM fx_track WHERE event_name = 'User Signed Up' GROUP BY 1),
       v AS (SELECT DISTINCT user_id, date_trunc('week', ts) AS w FROM fx_track WHERE event_name IN ('Page Viewed', 'Order Completed')),
       z AS (SELECT cohort, COUNT(*) AS cohort_size FROM c GROUP BY 1)
       SELECT strftime(c.cohort, '%Y-%m-%d') AS cohort, CAST(date_diff('day', c.cohort, v.w) // 7 AS INT) AS n, COUNT(*) AS users,
         max(cohort_size) AS cohort_size, round(COUNT(*) / max(cohort_size), 6) AS share
       FROM c JOIN v USING (user_id) JOIN z ON z.cohort = c.cohort WHERE v.w >= c.cohort GROUP BY 1, 2""",
    "fx_track",
)
def _(t):
    rows = op.retention(t.view("fx_track"), ["User Signed Up"], ["Page Viewed", "Order Completed"], "week")
    return rows.select(day_text("cohort").alias("cohort"), "n", "users", "cohort_size", num("share").alias("share"))


@query(
    "retention_table",
    """, c AS (SELECT user_id, min(date_trunc('day', ts)) AS cohort FROM fx_track GROUP BY 1),
       v AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS d FROM fx_track),
       r AS (SELECT cohort, date_diff('day', cohort, d) AS n, user_id FROM c JOIN v USING (user_id))
       SELECT strftime(cohort, '%Y-%m-%d') AS cohort, COUNT(DISTINCT user_id) AS cohort_size,
         round(COUNT(*) FILTER (n = 0) / COUNT(DISTINCT user_id), 6) AS p0,
         CASE WHEN COUNT(*) FILTER (n = 1) > 0 THEN round(COUNT(*) FILTER (n = 1) / COUNT(DISTINCT user_id), 6) END AS p1,
         CASE WHEN COUNT(*) FILTER (n = 7) > 0 THEN round(COUNT(*) FILTER (n = 7) / COUNT(DISTINCT user_id), 6) END AS p7
       FROM r GROUP BY 1""",
    "fx_track",
)
def _(t):
    rows = op.retention_table(op.retention(t.view("fx_track"), period="day"), [0, 1, 7])
    return rows.select(day_text("cohort").alias("cohort"), "cohort_size", *[num(c).alias(c) for c in ("p0", "p1", "p7")])


_TICKET = (
    "CASE event_name WHEN 'Page Viewed' THEN 'Support Ticket Created' WHEN 'Feature Used' THEN 'Support Ticket Resolved' "
    "ELSE event_name END"
)


@query(
    "time_between",
    """SELECT a.seq, epoch_us(min(b.ts)) AS end_us, round((epoch_us(min(b.ts)) - epoch_us(a.ts)) / 1e6, 6) AS seconds
       FROM (SELECT * FROM fx_track WHERE event_name = 'Page Viewed') a
       LEFT JOIN (SELECT * FROM fx_track WHERE event_name = 'Feature Used') b ON a.user_id = b.user_id AND b.ts > a.ts
       GROUP BY a.seq, a.ts""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").withColumn("event_name", F.expr(_TICKET))
    spans = op.time_between(rows, "Support Ticket Created", "Support Ticket Resolved")
    return spans.select("seq", us("end_ts").alias("end_us"), num("seconds").alias("seconds"))


@query(
    "abandonment",
    """, a AS (SELECT * FROM fx_track WHERE event_name = 'Page Viewed'), b AS (SELECT * FROM fx_track WHERE event_name = 'Order Completed'),
       n AS (SELECT a.seq, a.ts, min(b.ts) AS done FROM a LEFT JOIN b ON a.user_id = b.user_id AND b.ts > a.ts GROUP BY 1, 2)
       SELECT seq, epoch_us(done) AS done_us, COALESCE(done - ts > INTERVAL 2 DAY, true) AS abandoned FROM n""",
    "fx_track",
)
def _(t):
    rows = op.abandonment(t.view("fx_track"), "2 days", cart=["Page Viewed"])
    return rows.select("seq", us("completed_ts").alias("done_us"), "abandoned")


@query(
    "auth_failures",
    """, c AS (SELECT user_id, ts, COUNT(*) OVER (PARTITION BY user_id ORDER BY ts
         RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW) AS n FROM fx_track WHERE event_name = 'Authentication Failed')
       SELECT user_id, epoch_us(ts) AS us, n FROM c WHERE n >= 4""",
    "fx_track",
)
def _(t):
    rows = op.auth_failures(t.view("fx_track"), 4, "3 days")
    return rows.select("user_id", us("ts").alias("us"), "n")


# --- rankings, limits, sets ---------------------------------------------------------------------------------


@query(
    "rank_users",
    """, u AS (SELECT currency, user_id, CAST(floor(sum(amount) / 40) AS BIGINT) AS points FROM fx_revenue GROUP BY 1, 2)
       SELECT currency, user_id, points, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
         round(percent_rank() OVER w, 6) AS percent_rank,
         ntile(4) OVER (PARTITION BY currency ORDER BY points DESC, user_id) AS tile
       FROM u WINDOW w AS (PARTITION BY currency ORDER BY points DESC)""",
    "fx_revenue",
)
def _(t):
    # Added up as decimals: sums of doubles depend on their order, and a cent's fraction too little costs a user a point.
    total = F.sum(F.col("amount").cast("decimal(28,10)"))
    per_user = t.view("fx_revenue").groupBy("currency", "user_id").agg(big(F.floor(total / 40)).alias("points"))
    rows = op.rank_users(per_user, "points", by=["currency"])
    return rows.select(
        "currency", "user_id", "points", big("rank").alias("rank"), big("dense_rank").alias("dense_rank"),
        num("percent_rank").alias("percent_rank"), big("tile").alias("tile"),
    )


@query("timeline", "SELECT seq, event_name FROM fx_track ORDER BY ts, event_name, seq", "fx_track")
def _(t):
    return op.timeline(t.view("fx_track"), order=("ts", "event_name", "seq")).select("seq", "event_name")


@query(
    "top_k",
    "SELECT k, COUNT(*) AS n FROM fx_track GROUP BY 1 ORDER BY n DESC, k LIMIT 10",
    "fx_track",
)
def _(t):
    return op.top_k(t.view("fx_track"), "k", 10)


@query(
    "top_k_per_group",
    """, c AS (SELECT event_name, k, COUNT(*) AS n FROM fx_track GROUP BY 1, 2)
       SELECT *, row_number() OVER (PARTITION BY event_name ORDER BY n DESC, k) AS rank FROM c QUALIFY rank <= 5""",
    "fx_track",
)
def _(t):
    rows = op.top_k(t.view("fx_track"), "k", 5, ["event_name"])
    return rows.withColumn("rank", big("rank"))


@query(
    "latest_n",
    """SELECT seq, user_id FROM fx_track QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, seq DESC) <= 3""",
    "fx_track",
)
def _(t):
    return op.latest_n(t.view("fx_track"), ["user_id"], 3).select("seq", "user_id")


@query(
    "unified_timeline",
    """SELECT 'event' AS kind, seq, epoch_us(ts) AS us, event_name, NULL AS level, NULL AS value FROM fx_track
       UNION ALL SELECT 'log', seq, epoch_us(ts), NULL, level, NULL FROM fx_log
       UNION ALL SELECT 'metric', seq, epoch_us(ts), NULL, NULL, value FROM fx_gauge""",
    "fx_track fx_log fx_gauge",
)
def _(t):
    rows = op.unified_timeline(
        t.view("fx_track").select("seq", "ts", "event_name"),
        t.view("fx_log").select("seq", "ts", "level"),
        t.view("fx_gauge").select("seq", "ts", "value"),
    )
    return rows.select("kind", "seq", us("ts").alias("us"), "event_name", "level", "value")


_BUYERS, _ACTIVE = "SELECT concat('u', o_custkey) AS user_id FROM orders", "SELECT user_id FROM fx_track"


def _segments(t):
    """Everyone who ever ordered, and everyone who ever did anything."""
    return t.base("orders").select(F.concat(F.lit("u"), "o_custkey").alias("user_id")), t.view("fx_track")


@query("users_in_both", f"{_BUYERS} INTERSECT {_ACTIVE}", "fx_track")
def _(t):
    return op.users_in_both(*_segments(t))


@query("users_lost", f"{_BUYERS} EXCEPT {_ACTIVE}", "fx_track")
def _(t):
    return op.users_lost(*_segments(t))


@query(
    "mixed_metrics",
    """SELECT 'gauge' AS metric_type, name, COUNT(*) AS n, round(sum(value), 2) AS total FROM fx_gauge GROUP BY 2
       UNION ALL SELECT 'counter', name, COUNT(*), round(sum(value), 2) FROM fx_counter GROUP BY 2
       UNION ALL SELECT 'histogram', 'app.value', COUNT(*), 0.0::DOUBLE FROM fx_hist""",
    "fx_gauge fx_counter fx_hist",
)
def _(t):
    from workloads.aggregates import gauges, histograms

    gauge = gauges(t).withColumn("metric_type", F.lit("gauge"))
    counter = t.view("fx_counter").withColumn("metric_type", F.lit("counter"))
    hist = histograms(t).withColumns({"metric_type": F.lit("histogram"), "value": F.lit(0.0)})
    rows = op.mixed_metrics(gauge, counter, hist)
    return rows.groupBy("metric_type", "name").agg(F.count("*").alias("n"), num(F.sum("value"), 2).alias("total"))


@query(
    "sketched_periods",
    """, days AS (SELECT DISTINCT date_trunc('day', ts) AS day, user_id FROM fx_track),
         stay AS (SELECT a.day, COUNT(*) AS n FROM days a JOIN days b USING (user_id) WHERE b.day = a.day + INTERVAL 1 DAY GROUP BY a.day),
         sizes AS (SELECT day, COUNT(*) AS n FROM days GROUP BY day)
       SELECT strftime(a.day, '%Y-%m-%d') AS day, COALESCE(stay.n, 0) AS n_both, a.n - COALESCE(stay.n, 0) AS n_lost,
         b.n - COALESCE(stay.n, 0) AS n_gained, TRUE AS sketch_holds
       FROM sizes a JOIN sizes b ON b.day = a.day + INTERVAL 1 DAY LEFT JOIN stay ON stay.day = a.day""",
    "fx_track",
)
def _(t):
    events = t.view("fx_track")
    sketched = op.compare_periods(durable(op.user_sketches(events)))
    # The exact counts, from the events themselves, and whether the stored sketches stay within their bound of them.
    days = events.select(F.date_trunc("day", "ts").alias("period"), "user_id").distinct()
    after = days.select((F.col("period") - F.expr("INTERVAL 1 DAY")).alias("period"), "user_id", F.lit(1).alias("_after"))
    here = days.withColumn("_here", F.lit(1)).join(after, ["period", "user_id"], "full_outer")
    counts = {
        "n_both": F.count_if(F.expr("_here = 1 AND _after = 1")), "n_lost": F.count_if(F.expr("_here = 1 AND _after IS NULL")),
        "n_gained": F.count_if(F.expr("_here IS NULL AND _after = 1")),
    }
    exact = here.groupBy("period").agg(*[c.alias(f"x_{n}") for n, c in counts.items()])
    near = [F.abs(F.col(n) - F.col(f"x_{n}")) <= F.col("bound") for n in counts]
    joined = sketched.join(exact, "period")
    return joined.select(
        day_text("period").alias("day"), *[F.col(f"x_{n}").alias(n) for n in counts], (near[0] & near[1] & near[2]).alias("sketch_holds")
    )


@query(
    "sketched_quantiles",
    """SELECT event_name, strftime(date_trunc('month', ts), '%Y-%m') AS month, COUNT(value) AS n, TRUE AS p50_holds, TRUE AS p95_holds
       FROM fx_track GROUP BY 1, 2 HAVING COUNT(value) > 0""",
    "fx_track",
)
def _(t):
    events = t.view("fx_track")
    days = durable(op.value_sketches(events, by=["event_name"]))
    months = durable(op.sketched_quantiles(op.merge_value_sketches(days, by=["event_name"]), (0.5, 0.95)))
    values = events.filter("value IS NOT NULL").select("event_name", F.date_trunc("month", "ts").alias("period"), "value")
    keys = ["event_name", "period"]
    out = months
    for column, rank in (("p50", 0.5), ("p95", 0.95)):
        off = op.rank_error(values, months, keys, column, rank)
        out = out.join(off.select(*keys, (F.col("rank_error") <= 0.03).alias(f"{column}_holds")), keys)
    return out.select("event_name", F.date_format("period", "yyyy-MM").alias("month"), "n", "p50_holds", "p95_holds")
