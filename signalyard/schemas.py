"""Fixed schemas, enum codes and the standard event names."""

from __future__ import annotations

from pyspark.sql import types as T

# --- signal schemas -----------------------------------------------------------------------

EVENTS_DDL = (
    "tenant BINARY, event_type STRING, ts TIMESTAMP, service STRING, device_id STRING, "
    "session_id STRING, event_name STRING, payload STRING"
)
LOGS_DDL = (
    "tenant BINARY, log_event_type STRING, session_id STRING, level TINYINT, level_name STRING, "
    "ts TIMESTAMP, source STRING, service STRING, payload STRING"
)
LABELS_DDL = "ARRAY<STRUCT<key: STRING, value: STRING>>"
HISTOGRAM_DDL = (
    "STRUCT<count: BIGINT, sum: DOUBLE, min: DOUBLE, max: DOUBLE, "
    "buckets: ARRAY<STRUCT<upper_bound: DOUBLE, count: BIGINT>>>"
)
METRICS_DDL = (
    "tenant BINARY, metric_type STRING, ts TIMESTAMP, name STRING, value DOUBLE, source STRING, "
    f"service STRING, labels {LABELS_DDL}, temporality STRING, histogram {HISTOGRAM_DDL}, "
    "session_id STRING"
)

SIGNAL_DDL = {"event": EVENTS_DDL, "log": LOGS_DDL, "metric": METRICS_DDL}


def _struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def signal_schema(kind: str) -> T.StructType:
    """The schema of one signal type: ``event``, ``log`` or ``metric``."""
    try:
        return _struct(SIGNAL_DDL[kind])
    except KeyError:
        raise ValueError(f"unknown signal kind {kind!r}; use one of {sorted(SIGNAL_DDL)}") from None


def batch_schema(kind: str) -> T.StructType:
    """Envelope schema: one row per delivered batch, signals in ``data``."""
    item = _struct(SIGNAL_DDL[kind])
    return T.StructType(
        [
            T.StructField("tenant", T.BinaryType()),
            T.StructField("schema_type", T.StringType()),
            T.StructField("version", T.ShortType()),
            T.StructField("batch_id", T.LongType()),
            T.StructField("data", T.ArrayType(item)),
        ]
    )


# --- enum codes (fixed values of the wire format) -------------------------------------------

ENUMS: dict[str, dict[int, str]] = {
    "schema_type": {0: "unknown", 1: "event", 2: "log", 3: "metric"},
    "event_type": {
        0: "unknown",
        1: "track",
        2: "identify",
        3: "group",
        4: "alias",
        5: "enrich",
        6: "context",
    },
    "log_event_type": {0: "unknown", 1: "log", 2: "enrich"},
    "level": {
        0: "emergency",
        1: "alert",
        2: "critical",
        3: "error",
        4: "warning",
        5: "notice",
        6: "info",
        7: "debug",
        8: "trace",
    },
    "metric_type": {0: "unknown", 1: "gauge", 2: "counter", 3: "histogram"},
    "temporality": {0: "unspecified", 1: "cumulative", 2: "delta"},
}

ERROR_LEVEL = 3
DEFAULT_VERSION = 100
MAX_EVENT_NAME_BYTES = 256
MAX_LOG_MESSAGE_BYTES = 65_536
FRAME_OVERHEAD = 4
ORDER_COMPLETED = "Order Completed"

# --- standard event names (fixed values) ------------------------------------------------------

TAXONOMY: dict[str, tuple[str, ...]] = {
    "user_lifecycle": (
        "User Signed Up",
        "User Signed In",
        "User Signed Out",
        "User Invited",
        "User Onboarded",
        "Authentication Failed",
        "Password Reset",
        "Two Factor Enabled",
        "Two Factor Disabled",
    ),
    "revenue_billing": (
        "Order Completed",
        "Order Refunded",
        "Order Canceled",
        "Payment Failed",
        "Payment Method Added",
        "Payment Method Updated",
        "Payment Method Removed",
    ),
    "subscription": (
        "Subscription Started",
        "Subscription Renewed",
        "Subscription Paused",
        "Subscription Resumed",
        "Subscription Changed",
        "Subscription Canceled",
    ),
    "trial": ("Trial Started", "Trial Ending Soon", "Trial Ended", "Trial Converted"),
    "shopping": (
        "Cart Viewed",
        "Cart Updated",
        "Cart Abandoned",
        "Checkout Started",
        "Checkout Completed",
    ),
    "engagement": (
        "Page Viewed",
        "Feature Used",
        "Search Performed",
        "File Uploaded",
        "Notification Sent",
        "Notification Clicked",
    ),
    "communication": (
        "Email Sent",
        "Email Opened",
        "Email Clicked",
        "Email Bounced",
        "Email Unsubscribed",
        "Support Ticket Created",
        "Support Ticket Resolved",
    ),
}
CATEGORY_OF = {name: category for category, names in TAXONOMY.items() for name in names}
STANDARD_NAMES = tuple(CATEGORY_OF)

# Standing a subscription is in after each of its events.
SUBSCRIPTION_STATES = {
    "Subscription Started": "active",
    "Subscription Renewed": "active",
    "Subscription Paused": "paused",
    "Subscription Resumed": "active",
    "Subscription Changed": "active",
    "Subscription Canceled": "canceled",
}
