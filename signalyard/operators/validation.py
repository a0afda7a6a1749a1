"""Row rules. Each ``validate_*`` adds ``error STRUCT<field, reason>`` with the first failure.

The reasons are fixed values. NULL in a required text field counts as empty: the wire cannot carry an absent one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.functions.payload import props_of, typed_props
from signalyard.operators.stamping import NO_SESSION_TYPES
from signalyard.schemas import MAX_EVENT_NAME_BYTES, MAX_LOG_MESSAGE_BYTES, ORDER_COMPLETED

ERROR_DDL = "struct<field:string,reason:string>"
Check = tuple[str, Column, Column | str]  # field, "this row fails", reason


def _empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def _required(field: str, column: str, reason: str = "is required") -> Check:
    return field, _empty(column), reason


def _at_most(field: str, column: str, limit: int) -> Check:
    size = F.octet_length(column)
    reason = F.concat(F.lit(f"must be at most {limit} characters, got "), size.cast("string"))
    return field, size > limit, reason


def with_error(df: DataFrame, checks: Sequence[Check], keep: bool = False) -> DataFrame:
    """Add ``error`` with the first failing check, in the given order.

    With ``keep`` an error that is already there stays.
    """
    result: Column | None = None
    for field, fails, reason in checks:
        text = F.lit(reason) if isinstance(reason, str) else reason
        entry = F.struct(F.lit(field).alias("field"), text.alias("reason")).cast(ERROR_DDL)
        result = F.when(fails, entry) if result is None else result.when(fails, entry)
    if keep and "error" in df.columns:
        result = F.coalesce(F.col("error"), result)
    return df.withColumn("error", result)


def validate_track(df: DataFrame, user: str = "user_id", name: str = "event_name") -> DataFrame:
    checks = [
        _required("userId", user),
        _required("eventName", name),
        _at_most("eventName", name, MAX_EVENT_NAME_BYTES),
    ]
    return with_error(df, checks)


def validate_identify(df: DataFrame, user: str = "user_id") -> DataFrame:
    return with_error(df, [_required("userId", user)])


def validate_group(df: DataFrame, user: str = "user_id", group: str = "group_id") -> DataFrame:
    return with_error(df, [_required("userId", user), _required("groupId", group)])


def validate_revenue(
    df: DataFrame,
    user: str = "user_id",
    amount: str = "amount",
    currency: str = "currency",
    order_id: str = "order_id",
) -> DataFrame:
    """NaN passes the amount check (no comparison with it holds); a missing amount does not."""
    number = F.col(amount).cast("double")
    checks = [
        _required("userId", user),
        ("amount", number.isNull() | (number <= 0), "must be positive"),
        _required("currency", currency),
        _required("orderId", order_id),
    ]
    return with_error(df, checks)


def validate_alias(df: DataFrame, previous: str = "previous_id", user: str = "user_id") -> DataFrame:
    return with_error(df, [_required("previousId", previous), _required("userId", user)])


def validate_log(df: DataFrame, message: str = "message") -> DataFrame:
    return with_error(df, [_required("message", message), _at_most("message", message, MAX_LOG_MESSAGE_BYTES)])


def validate_metric(df: DataFrame, name: str = "name") -> DataFrame:
    return with_error(df, [_required("name", name, "metric name is required")])


def validate_tenant_key(df: DataFrame, key: str = "api_key") -> DataFrame:
    """Exactly 32 hex characters; the reason has the length or the first bad character."""
    text = F.coalesce(F.col(key), F.lit(""))
    size = F.octet_length(text)
    bad = F.regexp_extract(text, "([^0-9a-fA-F])", 1)
    checks = [
        (
            "apiKey",
            size != 32,
            F.concat(F.lit("apiKey must be 32 hex characters, got "), size.cast("string")),
        ),
        ("apiKey", bad != "", F.concat(F.lit("apiKey contains non-hex character '"), bad, F.lit("'"))),
    ]
    return with_error(df, checks)


def validate_service(df: DataFrame, service: str = "service") -> DataFrame:
    """A configured service may be absent but not empty."""
    return with_error(df, [("service", F.col(service) == "", "must not be empty")])


def validate_session_policy(
    df: DataFrame, reset: str | None = None, enabled: str | None = None, session: str = "session_id"
) -> DataFrame:
    """Identity rows carry no session; a session reset needs sessions to be enabled."""
    identity = F.col("event_type").isin(*NO_SESSION_TYPES)
    checks: list[Check] = [
        ("sessionId", identity & F.col(session).isNotNull(), "not allowed on identity events")
    ]
    if reset and enabled:
        off = ~F.coalesce(F.col(enabled), F.lit(False))
        checks.append(("session", F.coalesce(F.col(reset), F.lit(False)) & off, "is disabled"))
    return with_error(df, checks)


def validate_histogram(df: DataFrame, histogram: str = "histogram") -> DataFrame:
    """Bounds ascending, counts non-decreasing, last count equals the total, min <= max.

    An empty bucket list is legal.
    """
    h = F.col(histogram)
    buckets = F.coalesce(h["buckets"], F.array().cast("array<struct<upper_bound:double,count:bigint>>"))
    n = F.size(buckets)
    head = F.slice(buckets, 1, F.greatest(n - 1, F.lit(0)))
    tail = F.slice(buckets, 2, F.greatest(n - 1, F.lit(0)))
    rising = F.forall(F.zip_with(head, tail, lambda a, b: a["upper_bound"] < b["upper_bound"]), lambda x: x)
    growing = F.forall(F.zip_with(head, tail, lambda a, b: a["count"] <= b["count"]), lambda x: x)
    last = F.try_element_at(buckets, F.lit(-1))
    checks = [
        ("histogram", h.isNull(), "is required"),
        ("buckets", ~rising, "bounds must ascend"),
        ("buckets", ~growing, "counts must not decrease"),
        ("buckets", (n > 0) & (last["count"] != h["count"]), "last count must equal the total"),
        ("histogram", h["min"] > h["max"], "min must not exceed max"),
    ]
    return with_error(df, checks)


def validate_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A payload, if there is one, is a JSON object without repeated keys."""
    keys = F.map_keys(props_of(payload))
    checks = [
        ("payload", F.col(payload).isNotNull() & keys.isNull(), "is not a JSON object"),
        ("payload", F.size(keys) > F.size(F.array_distinct(keys)), "has duplicate keys"),
    ]
    return with_error(df, checks)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one)."""
    return df.filter("error IS NULL").drop("error"), df.filter("error IS NOT NULL")


def validation_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How often each field failed and why; sizes in a reason are left out so that equal causes group.

    ``by`` names further columns, such as the signal kind or the tenant id.
    """
    reason = F.regexp_replace("error.reason", r", got \d+$", "")
    bad = df.filter("error IS NOT NULL")
    return bad.groupBy(*by, F.col("error.field").alias("field"), reason.alias("reason")).agg(
        F.count("*").alias("n")
    )


def validate_signals(df: DataFrame, kind: str) -> DataFrame:
    """The rules of one signal kind on landed rows, whose user, group and message sit in the payload.

    The revenue rule applies to ``Order Completed`` rows that carry an amount, a currency or an order id: a plain
    track call may use that name without them.
    """
    if kind == "metric":
        return validate_metric(df)
    if kind == "log":
        parsed = df.withColumn("_p", typed_props("payload", "message string"))
        return validate_log(parsed.withColumn("_message", F.col("_p.message")), "_message").drop("_p", "_message")
    fields = "user_id string, group_id string, previous_id string, amount double, currency string, order_id string"
    parsed = df.withColumn("_p", typed_props("payload", fields))
    kind_is = F.col("event_type")
    track = kind_is == "track"
    name = F.octet_length("event_name")

    def missing(field: str) -> Column:
        return F.coalesce(F.col(f"_p.{field}"), F.lit("")) == ""

    amount = F.col("_p.amount")
    order_fields = F.coalesce(amount.cast("string"), "_p.currency", "_p.order_id")
    order = track & (F.col("event_name") == ORDER_COMPLETED) & order_fields.isNotNull()
    checks: list[Check] = [
        ("previousId", (kind_is == "alias") & missing("previous_id"), "is required"),
        ("userId", kind_is.isin("track", "identify", "group", "alias") & missing("user_id"), "is required"),
        ("groupId", (kind_is == "group") & missing("group_id"), "is required"),
        ("eventName", track & _empty("event_name"), "is required"),
        (
            "eventName",
            track & (name > MAX_EVENT_NAME_BYTES),
            F.concat(F.lit(f"must be at most {MAX_EVENT_NAME_BYTES} characters, got "), name.cast("string")),
        ),
        (
            "sessionId",
            kind_is.isin(*NO_SESSION_TYPES) & F.col("session_id").isNotNull(),
            "not allowed on identity events",
        ),
        ("amount", order & (amount.isNull() | (amount <= 0)), "must be positive"),
        ("currency", order & missing("currency"), "is required"),
        ("orderId", order & missing("order_id"), "is required"),
    ]
    return with_error(parsed, checks).drop("_p")
