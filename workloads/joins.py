"""Identity resolution and joins between signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.session import shared_dir
from workloads.registry import big, num, query, us

_IDMAP = """, links AS (SELECT previous_id AS a, user_id AS b FROM fx_alias
    UNION SELECT user_id, previous_id FROM fx_alias),
  reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
  idmap AS (SELECT a AS user_id, least(a, min(b)) AS canonical_id FROM reach GROUP BY a)"""


def stored_identities(t):
    """The map of canonical users, kept between queries; its folder is named by the links that are in it."""
    aliases = t.view("fx_alias")
    marks = [F.sum(F.xxhash64(F.lit(salt), "previous_id", "user_id").cast("decimal(38,0)")) for salt in (1, 2)]
    seen = aliases.agg(F.count("*"), *marks).first()
    store = op.IdentityStore(t.spark, f"{shared_dir(t.spark)}/identities/{'_'.join(str(v) for v in seen)}")
    if store.versions() is None:
        store.add_links(aliases)
    return store.map()


@query(
    "net_revenue_by_day",
    _IDMAP
    + """, valid AS (SELECT order_id, ts, user_id, currency, amount - 2.0 AS amount FROM fx_revenue
           WHERE amount - 2.0 > 0),
       back AS (SELECT order_id, sum(amount) AS refunded FROM fx_refund GROUP BY 1)
    SELECT strftime(v.ts, '%Y-%m-%d') AS day, v.currency, m.canonical_id AS user_id, COUNT(*) AS orders,
      round(sum(v.amount), 3) AS gross, round(sum(COALESCE(b.refunded, 0)), 3) AS refunded,
      round(sum(v.amount - COALESCE(b.refunded, 0)), 3) AS net
    FROM valid v JOIN idmap m USING (user_id) LEFT JOIN back b USING (order_id) GROUP BY ALL""",
    "fx_revenue fx_refund fx_alias",
    recursive=True,
)
def net_revenue_by_day(t):
    checked = op.validate_revenue(t.view("fx_revenue").withColumn("amount", F.col("amount") - 2.0))
    valid, _ = op.split_valid(checked)
    orders = valid.select("order_id", "ts", "user_id", "currency", "amount")
    canonical = op.apply_identity(orders, stored_identities(t))
    net = op.net_revenue(canonical, t.view("fx_refund"), ["seq", "ts"])
    return net.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "currency", "user_id").agg(
        F.count("*").alias("orders"),
        num(F.sum("gross"), 3).alias("gross"),
        num(F.sum("refunded"), 3).alias("refunded"),
        num(F.sum("net"), 3).alias("net"),
    )


@query("resolve_identities", _IDMAP + " SELECT user_id, canonical_id FROM idmap", "fx_alias", recursive=True)
def _(t):
    return op.resolve_identities(t.view("fx_alias"))


@query(
    "apply_identity",
    _IDMAP + " SELECT seq, COALESCE(canonical_id, t.user_id) AS user_id, t.user_id AS raw_id"
    " FROM fx_track t LEFT JOIN idmap m ON t.user_id = m.user_id",
    "fx_track fx_alias",
    recursive=True,
)
def _(t):
    return op.apply_identity(t.view("fx_track").select("seq", "user_id"), stored_identities(t), keep="raw_id")


@query(
    "asof_profile",
    """SELECT e.seq, i.plan AS profile_plan, CAST(i.k AS INT) AS profile_k FROM fx_track e
       ASOF LEFT JOIN fx_identify i ON e.user_id = i.user_id AND e.ts >= i.ts""",
    "fx_track fx_identify",
)
def _(t):
    events = t.view("fx_track").select("seq", "ts", "user_id")
    return op.asof_profile(events, t.view("fx_identify"), ["plan", "k"]).select("seq", "profile_plan", "profile_k")


@query(
    "asof_group",
    """SELECT e.seq, g.group_id AS current_group FROM fx_track e
       ASOF LEFT JOIN fx_group g ON e.user_id = g.user_id AND e.ts >= g.ts""",
    "fx_track fx_group",
)
def _(t):
    events = t.view("fx_track").select("seq", "ts", "user_id")
    return op.asof_group(events, t.view("fx_group")).select("seq", "current_group")


def changes_of(track):
    """Page views register a property of their device, failed logins take one away."""
    return track.filter("event_name IN ('Page Viewed', 'Authentication Failed')").select(
        F.col("device_id").alias("client_id"),
        "ts",
        "seq",
        F.when(F.col("event_name") == "Page Viewed", "register").otherwise("unregister").alias("op"),
        F.concat(F.lit("p"), F.col("k") % 3).alias("key"),
        F.col("k").cast("string").alias("value"),
    )


SUPER_PROPS_SQL = """, changes AS (SELECT device_id, ts, 'p' || (k % 3) AS key,
         CASE WHEN event_name = 'Page Viewed' THEN k END AS v FROM fx_track
         WHERE event_name IN ('Page Viewed', 'Authentication Failed')),
       used AS (SELECT seq, ts, device_id, user_id FROM fx_track WHERE event_name = 'Feature Used')
       SELECT e.seq, a.v AS p0, b.v AS p1, c.v AS p2, e.user_id FROM used e
       ASOF LEFT JOIN (SELECT * FROM changes WHERE key = 'p0') a ON e.device_id = a.device_id AND e.ts >= a.ts
       ASOF LEFT JOIN (SELECT * FROM changes WHERE key = 'p1') b ON e.device_id = b.device_id AND e.ts >= b.ts
       ASOF LEFT JOIN (SELECT * FROM changes WHERE key = 'p2') c ON e.device_id = c.device_id AND e.ts >= c.ts"""


@query("asof_super_props", SUPER_PROPS_SQL, "fx_track")
def _(t):
    track = t.view("fx_track")
    events = track.filter("event_name = 'Feature Used'").select(
        "seq", "ts", F.col("device_id").alias("client_id"), F.col("user_id").alias("u")
    )
    rows = op.asof_super_props(events, changes_of(track), reserved={"user_id": F.col("u")})
    return op.extract_props(rows.select("seq", "payload"), "p0 int, p1 int, p2 int, user_id string").drop("payload")


@query(
    "events_with_logs",
    """, s AS (SELECT session_id, COUNT(*) AS n_logs, COUNT(*) FILTER (level <= 3) AS n_errors, MIN(level) AS worst_level,
         MIN(ts) AS a, MAX(ts) AS b FROM fx_log GROUP BY 1)
       SELECT seq, n_logs, n_errors, worst_level, epoch_us(a) AS first_us, epoch_us(b) AS last_us
       FROM fx_track JOIN s USING (session_id)""",
    "fx_track fx_log",
)
def _(t):
    joined = op.events_with_logs(t.view("fx_track"), t.view("fx_log"))
    return joined.select(
        "seq", "n_logs", "n_errors", "worst_level", us("first_log_ts").alias("first_us"), us("last_log_ts").alias("last_us")
    )


LOGS_NEAR_EVENT_SQL = """SELECT e.seq, COUNT(l.seq) AS n_logs, COUNT(l.seq) FILTER (l.level <= 3) AS n_errors, MIN(l.level) AS worst_level
       FROM fx_track e LEFT JOIN fx_log l ON e.session_id = l.session_id
         AND l.ts >= e.ts - INTERVAL 4 HOUR AND l.ts <= e.ts + INTERVAL 30 MINUTE GROUP BY e.seq"""


@query("logs_near_event", LOGS_NEAR_EVENT_SQL, "fx_track fx_log")
def _(t):
    near = op.logs_near_event(t.view("fx_track"), t.view("fx_log"), "4 hours", "30 minutes")
    return near.select("seq", "n_logs", "n_errors", "worst_level")


NET_REVENUE_SQL = """, back AS (SELECT order_id, sum(amount) AS refunded FROM fx_refund GROUP BY 1)
       SELECT order_id, round(amount, 3) AS gross, round(COALESCE(refunded, 0), 3) AS refunded,
         round(amount - COALESCE(refunded, 0), 3) AS net FROM fx_revenue LEFT JOIN back USING (order_id)"""


@query("net_revenue_redelivered", NET_REVENUE_SQL, "fx_revenue fx_refund")
def _(t):
    orders, refunds = t.view("fx_revenue"), t.view("fx_refund")
    again = orders.filter("k % 3 = 0").withColumn("ts", F.expr("ts + INTERVAL 2 DAYS"))
    net = op.net_revenue(orders.unionByName(again).unionByName(again), refunds.unionByName(refunds))
    return net.select("order_id", num("gross", 3).alias("gross"), num("refunded", 3).alias("refunded"), num("net", 3).alias("net"))


@query("net_revenue", NET_REVENUE_SQL, "fx_revenue fx_refund")
def _(t):
    orders = t.view("fx_revenue").select("order_id", "amount")
    net = op.net_revenue(orders, t.view("fx_refund"), ["seq", "ts"])
    return net.select("order_id", num("gross", 3).alias("gross"), num("refunded", 3).alias("refunded"), num("net", 3).alias("net"))


@query(
    "net_revenue_returns",
    """, back AS (SELECT l_orderkey, sum(l_extendedprice) AS refunded FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
       SELECT o_orderstatus AS status, COUNT(*) AS orders, round(sum(o_totalprice), 2) AS gross,
         round(sum(COALESCE(refunded, 0)), 2) AS refunded
       FROM orders LEFT JOIN back ON o_orderkey = l_orderkey GROUP BY 1""",
    "fx_alias",
)
def _(t):
    orders = t.base("orders").selectExpr("o_orderkey AS order_id", "o_totalprice AS amount", "o_orderstatus AS status")
    back = t.base("lineitem").filter("l_returnflag = 'R'").selectExpr("l_orderkey AS order_id", "l_linenumber AS line", "l_extendedprice AS amount")
    return op.net_revenue(orders, back).groupBy("status").agg(
        F.count("*").alias("orders"),
        num(F.sum("gross"), 2).alias("gross"),
        num(F.sum("refunded"), 2).alias("refunded"),
    )


@query(
    "users_without",
    """SELECT DISTINCT user_id FROM fx_track WHERE user_id NOT IN
       (SELECT user_id FROM fx_identify WHERE plan = 'pro')""",
    "fx_track fx_identify",
)
def _(t):
    pro = t.view("fx_identify").filter("plan = 'pro'")
    return op.users_without(t.view("fx_track"), pro)


@query(
    "users_with",
    "SELECT DISTINCT user_id FROM fx_identify WHERE user_id IN"
    " (SELECT user_id FROM fx_track WHERE event_name = 'Order Completed')",
    "fx_track fx_identify",
)
def _(t):
    population = t.view("fx_identify").select("user_id").distinct()
    return op.users_with(t.view("fx_track"), ["Order Completed"], population=population)


@query(
    "orphan_aliases",
    """SELECT previous_id, user_id FROM (SELECT concat('u', c_custkey) AS previous_id, concat('c', c_nationkey) AS user_id FROM customer)
       WHERE previous_id NOT IN (SELECT user_id FROM fx_track)""",
    "fx_track",
)
def _(t):
    key = F.concat(F.lit("u"), "c_custkey").alias("previous_id")
    aliases = t.base("customer").select(key, F.concat(F.lit("c"), "c_nationkey").alias("user_id"))
    return op.orphan_aliases(aliases, t.view("fx_track"))


@query(
    "reconcile_batches",
    """, sent AS (SELECT DISTINCT CAST(floor(seq / 5) AS BIGINT) + 1 AS batch_id FROM fx_track),
       d AS (SELECT batch_id, COUNT(*) AS n FROM fx_batch GROUP BY 1)
       SELECT 'event' AS schema_type, COALESCE(s.batch_id, d.batch_id) AS batch_id,
         CASE WHEN s.batch_id IS NULL THEN 0 ELSE 1 END AS n_sent, COALESCE(d.n, 0) AS n_delivered,
         CASE WHEN d.n IS NULL THEN 'missing' WHEN s.batch_id IS NULL THEN 'extra' WHEN d.n > 1 THEN 'duplicated'
           ELSE 'ok' END AS status FROM sent s FULL JOIN d ON s.batch_id = d.batch_id""",
    "fx_track fx_batch",
)
def _(t):
    ids = F.floor(F.col("seq") / 5).cast("bigint") + 1
    sent = t.view("fx_track").select(F.lit("event").alias("schema_type"), ids.alias("batch_id")).distinct()
    rows = op.reconcile_batches(sent, t.view("fx_batch"))
    return rows.select("schema_type", "batch_id", big("n_sent").alias("n_sent"), big("n_delivered").alias("n_delivered"), "status")


@query(
    "metrics_align",
    """, a AS (SELECT * FROM fx_gauge WHERE label_type = 'view'), b AS (SELECT * FROM fx_gauge WHERE label_type = 'error'),
       x AS (SELECT a.seq, a.ts, b.ts AS bt, b.value AS bv FROM a ASOF LEFT JOIN b ON a.name = b.name AND a.ts >= b.ts),
       y AS (SELECT a.seq, a.ts, b.ts AS ct, b.value AS cv FROM a ASOF LEFT JOIN b ON a.name = b.name AND a.ts <= b.ts),
       z AS (SELECT x.seq, x.ts, CASE WHEN ct IS NULL OR (bt IS NOT NULL AND x.ts - bt <= ct - x.ts) THEN bt ELSE ct END AS pt,
         CASE WHEN ct IS NULL OR (bt IS NOT NULL AND x.ts - bt <= ct - x.ts) THEN bv ELSE cv END AS pv FROM x JOIN y USING (seq))
       SELECT seq, CASE WHEN abs(epoch_us(ts) - epoch_us(pt)) <= 600000000 THEN epoch_us(pt) END AS other_us,
         CASE WHEN abs(epoch_us(ts) - epoch_us(pt)) <= 600000000 THEN pv END AS other_value FROM z""",
    "fx_gauge",
)
def _(t):
    gauge = t.view("fx_gauge")
    aligned = op.metrics_align(
        gauge.filter("label_type = 'view'"), gauge.filter("label_type = 'error'"), "10 minutes", on=["name"]
    )
    return aligned.select("seq", us("other_ts").alias("other_us"), "other_value")
