"""Payloads, stamps, filters and validation over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.functions import merge_properties
from signalyard.schemas import CATEGORY_OF, ENUMS, STANDARD_NAMES
from workloads.registry import day_text, num, query, us

# --- payloads -----------------------------------------------------------------------------------

_TYPED = "user_id string, k int, env string"
_SUPER = '{"env": "prod", "k": -1}'


@query(
    "track_payload",
    """SELECT seq, user_id, k, 'prod' AS env,
       '{"env":"prod","k":' || k || ',"user_id":"' || user_id || '"}' AS payload FROM fx_track""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").select("seq", "user_id", "props", F.lit(_SUPER).alias("super_props"))
    typed = op.extract_props(op.track_payload(rows).drop("user_id"), _TYPED)
    return typed.select("seq", "user_id", "k", "env", "payload")


@query(
    "identify_payload",
    """SELECT seq, '{"user_id":"' || user_id || '","plan":"' || plan || '","k":' || k || '}' AS payload
       FROM fx_identify""",
    "fx_identify",
)
def _(t):
    rows = t.view("fx_identify").withColumn("traits", F.struct("plan", "k"))
    return op.identify_payload(rows).select("seq", "payload")


@query(
    "group_payload",
    """SELECT seq, '{"plan":"team","group_id":"' || group_id || '","user_id":"' || user_id || '","k":' || k || '}'
       AS payload FROM fx_group""",
    "fx_group",
)
def _(t):
    rows = t.view("fx_group").withColumns(
        {"props": F.struct("k"), "super_props": F.lit('{"plan":"team"}')}
    )
    return op.group_payload(rows).select("seq", "payload")


@query(
    "revenue_payload",
    """SELECT seq, 'Order Completed' AS event_name, user_id, round(amount, 6) AS amount, currency, order_id, k
       FROM fx_revenue""",
    "fx_revenue",
)
def _(t):
    rows = t.view("fx_revenue").withColumn("props", F.struct("k"))
    built = op.revenue_payload(rows).select("seq", "event_name", "payload")
    ddl = "user_id string, amount double, currency string, order_id string, k int"
    typed = op.extract_props(built, ddl)
    return typed.select("seq", "event_name", "user_id", num("amount").alias("amount"), "currency", "order_id", "k")


@query(
    "alias_payload",
    """SELECT '{"previous_id":"' || previous_id || '","user_id":"' || user_id || '"}' AS payload FROM fx_alias""",
    "fx_alias",
)
def _(t):
    return op.alias_payload(t.view("fx_alias")).select("payload")


@query(
    "log_payload",
    """SELECT seq, '{"message":"' || message || '","k":' || regexp_extract(props, '[0-9]+', 0) || '}' AS payload
       FROM fx_log""",
    "fx_log",
)
def _(t):
    return op.log_payload(t.view("fx_log"), data="props").select("seq", "payload")


@query(
    "merge_properties",
    """SELECT seq, CASE WHEN k % 2 = 0 THEN '{"k":"over","event":"' || event_name || '"}'
       ELSE '{"k":' || k || ',"event":"' || event_name || '"}' END AS merged FROM fx_track""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").withColumns(
        {
            "a": F.to_json(F.struct(F.col("event_name").alias("event"))),
            "b": F.when(F.col("k") % 2 == 0, F.lit('{"k":"over"}')).otherwise(F.lit("[1]")),
        }
    )
    return rows.select("seq", merge_properties("props", "a", "b").alias("merged"))


@query(
    "extract_props",
    "SELECT seq, k, CAST(NULL AS VARCHAR) AS missing FROM fx_track",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").select("seq", F.col("props").alias("payload"))
    return op.extract_props(rows, "k int, missing string").select("seq", "k", "missing")


@query(
    "explode_props",
    """SELECT seq, 'k' AS key, CAST(k AS VARCHAR) AS value, 'number' AS json_type FROM fx_track
       UNION ALL SELECT seq, 'user_id', user_id, 'string' FROM fx_track""",
    "fx_track",
)
def _(t):
    built = op.track_payload(t.view("fx_track"))
    return op.explode_props(built.select("seq", "payload"), ["seq"])


@query(
    "event_category",
    "SELECT event_name, "
    + "CASE event_name "
    + " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in CATEGORY_OF.items())
    + " ELSE 'custom' END AS category, COUNT(*) AS n FROM fx_track GROUP BY ALL",
    "fx_track",
)
def _(t):
    return op.event_category(t.view("fx_track")).groupBy("event_name", "category").agg(F.count("*").alias("n"))


@query(
    "payload_size",
    """, p AS (SELECT seq, device_id, session_id, service, event_name,
         '{"user_id":"' || user_id || '","k":' || k || '}' AS payload FROM fx_track)
       SELECT seq, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
         CAST(74 + 20 + 20 + 5 + strlen(service) + 5 + strlen(event_name) + 4 + strlen(payload) AS BIGINT) AS wire_bytes
       FROM p""",
    "fx_track",
)
def _(t):
    return op.payload_size(op.track_payload(t.view("fx_track"))).select("seq", "payload_bytes", "wire_bytes")


# --- stamps ---------------------------------------------------------------------------------------


@query(
    "stamp_service",
    """SELECT seq, COALESCE(NULLIF(service_override, ''), 'checkout') AS service FROM fx_log""",
    "fx_log",
)
def _(t):
    return op.stamp_service(t.view("fx_log"), "checkout", override="service_override").select("seq", "service")


@query("stamp_source", "SELECT seq, COALESCE(component, 'host-1') AS source FROM fx_log", "fx_log")
def _(t):
    return op.stamp_source(t.view("fx_log"), "host-1", component="component").select("seq", "source")


_TYPE_OF = (
    "CASE event_name WHEN 'User Signed Up' THEN 'identify' WHEN 'Feature Used' THEN 'group' ELSE 'track' END"
)


@query(
    "stamp_session",
    f"""SELECT seq, {_TYPE_OF} AS event_type,
        CASE WHEN {_TYPE_OF} <> 'track' THEN NULL WHEN k % 2 = 0 THEN session_id ELSE 'process' END AS session_id
        FROM fx_track""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").selectExpr(
        "seq", f"{_TYPE_OF} AS event_type", "CASE WHEN k % 2 = 0 THEN session_id END AS call_session"
    )
    return op.stamp_session(rows, call="call_session", process=F.lit("process")).select(
        "seq", "event_type", "session_id"
    )


@query(
    "decode_tenant_key",
    """, keys AS (SELECT seq, CASE WHEN k % 5 = 0 THEN 'not a key' ELSE upper(md5(service)) END AS api_key FROM fx_track)
       SELECT seq, CASE WHEN length(api_key) = 32 THEN lower(api_key) END AS tenant FROM keys""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").selectExpr(
        "seq", "CASE WHEN k % 5 = 0 THEN 'not a key' ELSE upper(md5(service)) END AS api_key"
    )
    return op.decode_tenant_key(rows).select("seq", F.lower(F.hex("tenant")).alias("tenant"))


@query(
    "normalize_ts",
    """SELECT seq, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) * 1000 AS event_us,
       CAST(floor(epoch_us(ts) / 1000) AS BIGINT) * 1000 AS metric_us FROM fx_track""",
    "fx_track",
)
def _(t):
    ms = t.view("fx_track").select("seq", F.unix_millis("ts").alias("timestamp"))
    events = op.normalize_ts(ms, "event")
    both = op.normalize_ts(events.withColumn("timestamp", F.col("timestamp") * 1_000_000), "metric", out="metric_ts")
    return both.select("seq", us("ts").alias("event_us"), us("metric_ts").alias("metric_us"))


def _names(enum: str, code: str) -> str:
    return f"CASE {code} " + " ".join(f"WHEN {c} THEN '{n}'" for c, n in ENUMS[enum].items()) + " END"


@query(
    "decode_enums",
    f"""SELECT seq, level, {_names("level", "level")} AS level_name,
        COALESCE({_names("event_type", "level")}, 'unknown') AS event_type,
        COALESCE({_names("metric_type", "level")}, 'unknown') AS metric_type FROM fx_log""",
    "fx_log",
)
def _(t):
    rows = t.view("fx_log").select(
        "seq", "level", F.col("level").alias("event_type"), F.col("level").alias("metric_type")
    )
    return op.decode_enums(rows).select("seq", "level", "level_name", "event_type", "metric_type")


@query("encode_enums", "SELECT seq, CAST(level AS INT) AS level FROM fx_log", "fx_log")
def _(t):
    named = op.decode_enums(t.view("fx_log").select("seq", "level")).drop("level")
    return op.encode_enums(named).select("seq", F.col("level").cast("int").alias("level"))


@query(
    "metric_defaults",
    """SELECT seq, CASE k % 3 WHEN 0 THEN 'unspecified' WHEN 1 THEN CASE WHEN k % 2 = 0 THEN 'cumulative' ELSE 'delta' END
       ELSE 'cumulative' END AS temporality, CASE k % 3 WHEN 2 THEN 0.0 ELSE value END AS value FROM fx_track""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").selectExpr(
        "seq",
        "value",
        "CASE k % 3 WHEN 0 THEN 'gauge' WHEN 1 THEN 'counter' ELSE 'histogram' END AS metric_type",
        "CASE WHEN k % 2 = 0 THEN 'cumulative' END AS temporality",
    )
    return op.metric_defaults(rows).select("seq", "temporality", "value")


@query(
    "envelope_defaults",
    """SELECT seq, CASE WHEN batch_id % 2 = 0 THEN 100 ELSE 1 END AS version, NULLIF(batch_id % 4, 0) AS batch_id
       FROM fx_batch""",
    "fx_batch",
)
def _(t):
    rows = t.view("fx_batch").selectExpr("seq", "batch_id % 2 AS version", "batch_id % 4 AS batch_id")
    return op.envelope_defaults(rows).select("seq", F.col("version").cast("int").alias("version"), "batch_id")


@query(
    "series_key",
    """SELECT seq, '{"name":"app.value","labels":[{"key":"type","value":"' || label_type || '"},{"key":"zone","value":"b"}]}'
       AS series_key FROM fx_gauge""",
    "fx_gauge",
)
def _(t):
    label = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    rows = t.view("fx_gauge").withColumn(
        "labels",
        F.array(label("zone", F.lit("a")), label("type", F.col("label_type")), label("zone", F.lit("b"))),
    )
    return op.series_key(rows).select("seq", "series_key")


# --- filters ----------------------------------------------------------------------------------------


@query(
    "where_signal",
    """SELECT seq, event_name, service FROM fx_track WHERE event_name IN ('Page Viewed', 'Order Completed')
       AND service = 'svc1' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""",
    "fx_track",
)
def _(t):
    picked = op.where_signal(
        t.view("fx_track"),
        names=["Page Viewed", "Order Completed"],
        service="svc1",
        start="2024-01-05",
        end="2024-01-20",
    )
    return picked.select("seq", "event_name", "service")


@query("min_severity", "SELECT seq, level FROM fx_log WHERE level <= 4", "fx_log")
def _(t):
    return op.min_severity(t.view("fx_log"), "warning").select("seq", "level")


@query("where_prop", "SELECT seq, k FROM fx_track WHERE k > 42", "fx_track")
def _(t):
    return op.where_prop(t.view("fx_track"), "k", ">", 42, payload="props").select("seq", "k")


@query(
    "where_label",
    "SELECT seq, label_type FROM fx_gauge WHERE regexp_matches(label_type, '^(view|click)$')",
    "fx_gauge",
)
def _(t):
    rows = t.view("fx_gauge").withColumn(
        "labels", F.array(F.struct(F.lit("type").alias("key"), F.col("label_type").alias("value")))
    )
    return op.where_label(rows, "type", "regex", "^(view|click)$").select("seq", "label_type")


_MIXED = "CASE WHEN k % 3 = 0 THEN concat('custom_', k) ELSE event_name END"
_IN = ", ".join(f"'{n}'" for n in STANDARD_NAMES)


@query(
    "standard_only",
    f"SELECT seq, {_MIXED} AS event_name FROM fx_track WHERE {_MIXED} IN ({_IN})",
    "fx_track",
)
def _(t):
    return op.standard_only(t.view("fx_track").selectExpr("seq", f"{_MIXED} AS event_name"))


@query(
    "custom_only",
    f"SELECT seq, {_MIXED} AS event_name FROM fx_track WHERE {_MIXED} NOT IN ({_IN})",
    "fx_track",
)
def _(t):
    return op.custom_only(t.view("fx_track").selectExpr("seq", f"{_MIXED} AS event_name"))


# --- validation ---------------------------------------------------------------------------------------


def _error(df, *ids):
    return df.select(*ids, F.col("error.field").alias("field"), F.col("error.reason").alias("reason"))


def _first_failure(*checks: tuple[str, str, str]) -> str:
    field = " ".join(f"WHEN {cond} THEN '{name}'" for cond, name, _ in checks)
    reason = " ".join(f"WHEN {cond} THEN {text}" for cond, _, text in checks)
    return f"CASE {field} END AS field, CASE {reason} END AS reason"


_REQ = "'is required'"
_USER = ("user_id = ''", "userId", _REQ)
_NAME = ("event_name = ''", "eventName", _REQ)
_LONG = (
    "strlen(event_name) > 256",
    "eventName",
    "'must be at most 256 characters, got ' || strlen(event_name)",
)
_AMOUNT = ("amount <= 0", "amount", "'must be positive'")
_TRACK_SQL = f"SELECT seq, {_first_failure(_USER, _NAME, _LONG)} FROM fx_bad"


@query("validate_track", _TRACK_SQL, "fx_bad")
def _(t):
    return _error(op.validate_track(t.view("fx_bad")), "seq")


@query("validate_identify", f"SELECT seq, {_first_failure(_USER)} FROM fx_bad", "fx_bad")
def _(t):
    return _error(op.validate_identify(t.view("fx_bad")), "seq")


@query(
    "validate_group",
    f"SELECT seq, {_first_failure(_USER, ("group_id = ''", 'groupId', _REQ))} FROM fx_bad",
    "fx_bad",
)
def _(t):
    return _error(op.validate_group(t.view("fx_bad")), "seq")


_REVENUE_CHECKS = (
    _USER,
    _AMOUNT,
    ("currency = ''", "currency", _REQ),
    ("order_id = ''", "orderId", _REQ),
)


@query("validate_revenue", f"SELECT seq, {_first_failure(*_REVENUE_CHECKS)} FROM fx_bad", "fx_bad")
def _(t):
    return _error(op.validate_revenue(t.view("fx_bad")), "seq")


@query(
    "validate_alias",
    f"""SELECT seq, {_first_failure(("order_id = ''", 'previousId', _REQ), _USER)} FROM fx_bad""",
    "fx_bad",
)
def _(t):
    return _error(op.validate_alias(t.view("fx_bad"), previous="order_id"), "seq")


@query(
    "validate_log",
    """, logs AS (SELECT seq AS id, message FROM fx_log UNION ALL SELECT -1 - doc_id, text FROM documents
         UNION ALL SELECT -1000000000 - conv_id * 1000 - turn, text FROM conversations)
       SELECT id, CASE WHEN message = '' OR strlen(message) > 65536 THEN 'message' END AS field,
         CASE WHEN message = '' THEN 'is required' WHEN strlen(message) > 65536
           THEN 'must be at most 65536 characters, got ' || strlen(message) END AS reason FROM logs""",
    "fx_log",
)
def _(t):
    texts = (
        t.view("fx_log").select(F.col("seq").alias("id"), "message")
        .unionByName(t.base("documents").select((-1 - F.col("doc_id")).alias("id"), F.col("text").alias("message")))
        .unionByName(
            t.base("conversations").select(
                (F.lit(-1000000000) - F.col("conv_id") * 1000 - F.col("turn")).alias("id"),
                F.col("text").alias("message"),
            )
        )
    )
    return _error(op.validate_log(texts), "id")


@query(
    "validate_metric",
    """SELECT seq, CASE WHEN event_name = '' THEN 'name' END AS field,
       CASE WHEN event_name = '' THEN 'metric name is required' END AS reason FROM fx_bad""",
    "fx_bad",
)
def _(t):
    return _error(op.validate_metric(t.view("fx_bad"), name="event_name"), "seq")


_KEY = (
    "CASE k % 4 WHEN 0 THEN md5(service) WHEN 1 THEN concat(md5(service), 'a') "
    "WHEN 2 THEN concat('z', substr(md5(service), 2)) ELSE '' END"
)


@query(
    "validate_tenant_key",
    f""", keys AS (SELECT seq, {_KEY} AS api_key FROM fx_track)
       SELECT seq, CASE WHEN strlen(api_key) <> 32 OR regexp_matches(api_key, '[^0-9a-fA-F]') THEN 'apiKey' END AS field,
         CASE WHEN strlen(api_key) <> 32 THEN 'apiKey must be 32 hex characters, got ' || strlen(api_key)
           WHEN regexp_matches(api_key, '[^0-9a-fA-F]')
           THEN 'apiKey contains non-hex character ''' || regexp_extract(api_key, '[^0-9a-fA-F]') || '''' END AS reason
       FROM keys""",
    "fx_track",
)
def _(t):
    return _error(op.validate_tenant_key(t.view("fx_track").selectExpr("seq", f"{_KEY} AS api_key")), "seq")


@query(
    "validate_service",
    """SELECT seq, CASE WHEN service_override = '' THEN 'service' END AS field,
       CASE WHEN service_override = '' THEN 'must not be empty' END AS reason FROM fx_log""",
    "fx_log",
)
def _(t):
    return _error(op.validate_service(t.view("fx_log"), service="service_override"), "seq")


@query(
    "validate_session_policy",
    f"""SELECT seq, CASE WHEN {_TYPE_OF} <> 'track' THEN 'sessionId' WHEN k > 90 THEN 'session' END AS field,
        CASE WHEN {_TYPE_OF} <> 'track' THEN 'not allowed on identity events' WHEN k > 90 THEN 'is disabled' END AS reason
        FROM fx_track""",
    "fx_track",
)
def _(t):
    rows = t.view("fx_track").selectExpr(
        "seq", f"{_TYPE_OF} AS event_type", "session_id", "k > 90 AS reset", "false AS enabled"
    )
    return _error(op.validate_session_policy(rows, "reset", "enabled"), "seq")


def histogram_column(first: str = "le_5"):
    """The daily histogram of the view as a histogram struct."""
    edges = ((5.0, first), (25.0, "le_25"), (100.0, "le_100"), (float("inf"), "le_inf"))
    buckets = F.array(*[F.struct(F.lit(b).alias("upper_bound"), F.col(c).alias("count")) for b, c in edges])
    return F.struct(
        F.col("n").alias("count"),
        F.col("total").alias("sum"),
        F.col("lo").alias("min"),
        F.col("hi").alias("max"),
        buckets.alias("buckets"),
    )


@query(
    "validate_histogram",
    """SELECT label_type, strftime(day, '%Y-%m-%d') AS day,
       CASE WHEN le_25 + 40 - n % 80 > le_25 THEN 'buckets' END AS field,
       CASE WHEN le_25 + 40 - n % 80 > le_25 THEN 'counts must not decrease' END AS reason FROM fx_hist""",
    "fx_hist",
)
def _(t):
    rows = t.view("fx_hist").withColumn("le_5", F.expr("le_25 + 40 - n % 80"))
    return _error(
        op.validate_histogram(rows.withColumn("histogram", histogram_column())),
        "label_type",
        day_text("day").alias("day"),
    )


_BROKEN = (
    "CASE k % 5 WHEN 0 THEN concat('{\"k\":', k) WHEN 1 THEN '[1,2]' WHEN 2 THEN '{\"k\":1,\"k\":2}' "
    "WHEN 3 THEN NULL ELSE props END"
)


@query(
    "validate_payload",
    """SELECT seq, CASE WHEN k % 5 IN (0, 1, 2) THEN 'payload' END AS field,
       CASE WHEN k % 5 IN (0, 1) THEN 'is not a JSON object' WHEN k % 5 = 2 THEN 'has duplicate keys' END AS reason
       FROM fx_track""",
    "fx_track",
)
def _(t):
    return _error(op.validate_payload(t.view("fx_track").selectExpr("seq", f"{_BROKEN} AS payload")), "seq")


@query(
    "validation_report",
    f""", e AS ({_TRACK_SQL})
       SELECT 'event' AS kind, field, regexp_replace(reason, ', got [0-9]+$', '') AS reason, COUNT(*) AS n
       FROM e WHERE field IS NOT NULL GROUP BY ALL""",
    "fx_bad",
)
def _(t):
    checked = op.validate_track(t.view("fx_bad")).withColumn("kind", F.lit("event"))
    return op.validation_report(checked, by=["kind"])


@query(
    "split_valid",
    """SELECT 'good' AS part, COUNT(*) AS n FROM fx_bad WHERE NOT (user_id = '' OR amount <= 0 OR currency = '' OR order_id = '')
       UNION ALL SELECT 'bad', COUNT(*) FROM fx_bad WHERE user_id = '' OR amount <= 0 OR currency = '' OR order_id = ''""",
    "fx_bad",
)
def _(t):
    good, bad = op.split_valid(op.validate_revenue(t.view("fx_bad")))
    count = F.count("*").alias("n")
    return good.agg(count).select(F.lit("good").alias("part"), "n").unionByName(
        bad.agg(count).select(F.lit("bad").alias("part"), "n")
    )


@query(
    "validate_signals",
    f"""SELECT seq, {_first_failure(_USER, _NAME, _LONG)} FROM fx_bad""",
    "fx_bad",
)
def _(t):
    rows = t.view("fx_bad").select(
        "seq",
        F.lit("track").alias("event_type"),
        "event_name",
        F.lit(None).cast("string").alias("session_id"),
        F.to_json(F.struct("user_id")).alias("payload"),
    )
    return _error(op.validate_signals(rows, "event"), "seq")

