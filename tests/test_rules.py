"""Row rules on literal cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.functions import merge_properties
from signalyard.schemas import CATEGORY_OF, STANDARD_NAMES, signal_schema


def payload(df) -> dict:
    return json.loads(df.first()["payload"])


def errors(df):
    return [None if r["error"] is None else (r["error"]["field"], r["error"]["reason"]) for r in df.collect()]


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.mapKeyDedupPolicy") == "LAST_WIN"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_track_payload(table):
    df = table("user_id string, props string", ("user_123", '{"url":"/home","referrer":"google"}'))
    assert payload(op.track_payload(df)) == {"user_id": "user_123", "url": "/home", "referrer": "google"}


def test_super_properties_lose_to_reserved_keys_and_those_to_properties(table):
    df = table(
        "user_id string, super_props string, props string",
        ("u", '{"user_id":"super","env":"prod","a":1}', '{"a":2,"b":true}'),
        ("u", '{"user_id":"super"}', '{"user_id":"mine"}'),
    )
    rows = [json.loads(r["payload"]) for r in op.track_payload(df).collect()]
    assert rows == [{"user_id": "u", "env": "prod", "a": 2, "b": True}, {"user_id": "mine"}]


def test_group_and_revenue_with_super_properties(table):
    group = table(
        "user_id string, group_id string, super_props string, props string",
        ("user_1", "org_123", '{"platform":"ios"}', '{"org_name":"Acme"}'),
    )
    assert payload(op.group_payload(group)) == {
        "platform": "ios", "group_id": "org_123", "user_id": "user_1", "org_name": "Acme",
    }
    order = table(
        "user_id string, amount double, currency string, order_id string, super_props string, props string",
        ("user_1", 29.99, "EUR", "ord_456", '{"source":"web"}', '{"item":"widget"}'),
    )
    built = op.revenue_payload(order)
    assert payload(built) == {
        "source": "web", "user_id": "user_1", "amount": 29.99, "currency": "EUR", "order_id": "ord_456", "item": "widget",
    }
    assert built.first()["event_name"] == "Order Completed"


def test_identify_and_log_ignore_super_properties(table):
    df = table(
        "user_id string, message string, super_props string, traits string, data string",
        ("user_123", "hi", '{"env":"prod"}', '{"name":"Jane","plan":"pro"}', '{"code":7}'),
    )
    assert payload(op.identify_payload(df)) == {"user_id": "user_123", "name": "Jane", "plan": "pro"}
    assert payload(op.log_payload(df)) == {"message": "hi", "code": 7}


def test_not_finite_amounts_are_null_in_the_payload(table):
    rows = [("u", float(x), "USD", "o", None) for x in ("nan", "inf", "-inf")]
    df = table("user_id string, amount double, currency string, order_id string, props string", *rows)
    for row in op.revenue_payload(df).collect():
        assert json.loads(row["payload"])["amount"] is None
    assert errors(op.validate_revenue(df)) == [None, None, ("amount", "must be positive")]


@pytest.mark.parametrize(
    ("first", "second", "merged"),
    [
        ('{"a":1}', '{"a":2}', {"a": 2}),
        ('{"a":1,"a":3}', "{}", {"a": 3}),
        ('{"a":1}', "[1,2]", {"a": 1}),
        ('{"a":1}', '"text"', {"a": 1}),
        ('{"a":1}', '{"b":', {"a": 1}),
        ('{"a":1}', None, {"a": 1}),
        (None, None, {}),
        ('{"a":{"x":[1,null]}}', '{"b":"\\"q\\" é"}', {"a": {"x": [1, None]}, "b": '"q" é'}),
    ],
)
def test_merge_properties(table, first, second, merged):
    df = table("x string, y string", (first, second))
    assert json.loads(df.select(merge_properties("x", "y").alias("m")).first()["m"]) == merged


def test_any_serializable_column_is_a_payload(spark):
    base = spark.range(1).select(F.lit("u").alias("user_id"))
    shapes = {
        "struct": F.struct(F.lit(1).alias("a")),
        "map": F.create_map(F.lit("a"), F.lit(1)),
        "variant": F.parse_json(F.lit('{"a":1}')),
        "text": F.lit('{"a":1}'),
    }
    for shape in shapes.values():
        assert payload(op.track_payload(base.withColumn("props", shape))) == {"user_id": "u", "a": 1}


def test_twelve_validation_errors(table):
    names = "user_id string, event_name string, group_id string, amount double, currency string, order_id string"
    ok = dict(user_id="u", event_name="E", group_id="g", amount=1.0, currency="USD", order_id="o")

    def one(**changes):
        return table(names, tuple((ok | changes).values()))

    need = "is required"
    assert errors(op.validate_track(one(user_id=""))) == [("userId", need)]
    assert errors(op.validate_identify(one(user_id=""))) == [("userId", need)]
    assert errors(op.validate_group(one(user_id=""))) == [("userId", need)]
    assert errors(op.validate_track(one(event_name=""))) == [("eventName", need)]
    assert errors(op.validate_revenue(one(amount=-1.0))) == [("amount", "must be positive")]
    assert errors(op.validate_group(one(group_id=""))) == [("groupId", need)]
    assert errors(op.validate_revenue(one(currency=""))) == [("currency", need)]
    assert errors(op.validate_revenue(one(order_id=""))) == [("orderId", need)]
    assert errors(op.validate_log(table("message string", ("",)))) == [("message", need)]
    metrics = op.validate_metric(table("name string", ("",), ("",), ("",)))
    assert errors(metrics) == [("name", "metric name is required")] * 3
    # The first failure counts, in a fixed order.
    assert errors(op.validate_revenue(one(user_id="", amount=0.0, currency=""))) == [("userId", need)]
    assert errors(op.validate_revenue(one(amount=0.0, currency=""))) == [("amount", "must be positive")]
    report = op.validation_report(op.validate_track(one(user_id="")))
    assert [tuple(r) for r in report.collect()] == [("userId", need, 1)]


def test_alias_checks_the_previous_id_first(table):
    df = table("previous_id string, user_id string", ("", ""), ("a", ""), ("a", "b"), ("", "b"))
    assert [e and e[0] for e in errors(op.validate_alias(df))] == ["previousId", "userId", None, "previousId"]


def test_limits_are_bytes(table):
    names = table("user_id string, event_name string", ("u", "a" * 256), ("u", "a" * 257), ("u", "é" * 128), ("u", "é" * 129))
    over = "must be at most 256 characters, got "
    assert errors(op.validate_track(names)) == [None, ("eventName", over + "257"), None, ("eventName", over + "258")]
    logs = table("message string", ("x" * 65_536,), ("x" * 65_537,), ("é" * 32_769,))
    assert [e is None for e in errors(op.validate_log(logs))] == [True, False, False]


def test_tenant_keys(table):
    good = "0123456789abcdefABCDEF0123456789"
    keys = [good, good[:31], good + "0", "g" + good[1:], good[:31] + "g", "", good + "\n"]
    df = table("api_key string", *[(k,) for k in keys])
    assert [e is None for e in errors(op.validate_tenant_key(df))] == [True] + [False] * 6
    decoded = [r["tenant"] for r in op.decode_tenant_key(df).collect()]
    assert decoded[0] == bytes.fromhex(good)
    assert decoded[1:] == [None] * 6
    assert "api_key" not in op.decode_tenant_key(df).columns


def test_service_and_source_fallbacks(table):
    df = table("o string, c string", ("billing", "db"), (None, None), ("", ""))
    assert [r["service"] for r in op.stamp_service(df, "api", "o").collect()] == ["billing", "api", "api"]
    assert [r["service"] for r in op.stamp_service(df, None, "o").collect()] == ["billing", None, None]
    assert [r["source"] for r in op.stamp_source(df, "host", "c").collect()] == ["db", "host", ""]


def test_session_stamps(table):
    df = table("event_type string, mine string", ("track", "s1"), ("track", None), ("identify", "s1"), ("alias", None))
    stamped = op.stamp_session(df, "mine", F.lit("auto"))
    assert [r["session_id"] for r in stamped.collect()] == ["s1", "auto", None, None]
    assert [r["session_id"] for r in op.stamp_session(df).collect()] == [None] * 4
    assert [r["session_id"] for r in op.stamp_session(df, "mine", kind="metric").collect()] == [None] * 4


def test_session_policy(table):
    df = table(
        "event_type string, session_id string, reset boolean, enabled boolean",
        ("identify", "s", False, True), ("track", "s", True, False), ("track", "s", True, True),
    )
    found = errors(op.validate_session_policy(df, "reset", "enabled"))
    assert found == [("sessionId", "not allowed on identity events"), ("session", "is disabled"), None]


def test_enums(table):
    df = table("level int, event_type int, temporality int", (3, 4, 2), (9, 77, 9))
    named = op.decode_enums(df).collect()
    assert (named[0]["level_name"], named[0]["event_type"], named[0]["temporality"]) == ("error", "alias", "delta")
    assert (named[1]["level_name"], named[1]["event_type"], named[1]["temporality"]) == (None, "unknown", "unknown")
    back = op.encode_enums(op.decode_enums(df)).collect()
    assert (back[0]["level"], back[0]["event_type"], back[0]["temporality"]) == (3, 4, 2)
    assert (back[1]["level"], back[1]["event_type"]) == (None, 0)


def test_times(table):
    df = table("timestamp bigint", (1_706_000_000_123,))
    assert op.normalize_ts(df, "event").first()["ts"].isoformat() == "2024-01-23T08:53:20.123000"
    ns = df.withColumn("timestamp", F.col("timestamp") * 1_000_000)
    assert op.normalize_ts(ns, "metric").first()["ts"].isoformat() == "2024-01-23T08:53:20.123000"


def test_series_key_ignores_label_order_and_keeps_the_last_of_equal_keys(spark):
    ddl = "name string, labels array<struct<key:string,value:string>>"
    rows = [("m", [("b", "2"), ("a", "1")]), ("m", [("a", "0"), ("a", "1"), ("b", "2")]), ("m", [("a", "x" * 400)]), ("m", None)]
    keys = [r["series_key"] for r in op.series_key(spark.createDataFrame(rows, ddl)).collect()]
    assert keys[0] == keys[1]
    assert len(keys[2]) == 64
    assert len(set(keys)) == 3


def test_payload_validation(table):
    df = table("payload string", ('{"a":1}',), ('{"a":',), ("[1]",), ('{"a":1,"a":2}',), (None,))
    wrong = "is not a JSON object"
    assert errors(op.validate_payload(df)) == [
        None, ("payload", wrong), ("payload", wrong), ("payload", "has duplicate keys"), None,
    ]


def test_filters(table):
    logs = table("level int", (0,), (3,), (4,), (8,))
    assert [r["level"] for r in op.min_severity(logs, "error").collect()] == [0, 3]
    df = table("payload string", ('{"n":5,"s":"x"}',), ('{"n":"5"}',), ("{}",))
    assert op.where_prop(df, "n", ">=", 5).count() == 2  # a numeric text reads as a number
    assert op.where_prop(df, "s", "exists").count() == 1
    assert op.where_prop(df, "s", "missing").count() == 2
    assert len(STANDARD_NAMES) == len(CATEGORY_OF) == 44
    names = table("event_name string", ("Order Completed",), ("Mine",))
    assert op.standard_only(names).count() == op.custom_only(names).count() == 1
    assert [r["category"] for r in op.event_category(names).collect()] == ["revenue_billing", "custom"]


def test_label_filters(spark):
    df = spark.createDataFrame(
        [([("host", "a")],), ([("host", "b"), ("zone", "z")],), (None,)], "labels array<struct<key:string,value:string>>"
    )
    counts = {op_: op.where_label(df, "host", op_, v).count() for op_, v in (("=", "a"), ("!=", "a"), ("regex", "a|b"), ("exists", None), ("missing", None))}
    assert counts == {"=": 1, "!=": 2, "regex": 2, "exists": 2, "missing": 1}


def test_validate_signals(spark):
    rows = [
        ("track", "E", None, '{"user_id":"u"}'), ("track", "", None, '{"user_id":"u"}'), ("group", None, None, '{"user_id":"u"}'),
        ("alias", None, None, '{"user_id":"u"}'), ("identify", None, "s", '{"user_id":"u"}'), ("track", "E", None, "broken"),
    ]
    df = spark.createDataFrame(rows, "event_type string, event_name string, session_id string, payload string")
    fields = [e and e[0] for e in errors(op.validate_signals(df, "event"))]
    assert fields == [None, "eventName", "groupId", "previousId", "sessionId", "userId"]


def test_unknown_signal_kind():
    with pytest.raises(ValueError, match="unknown signal kind"):
        signal_schema("trace")


def test_revenue_rule_on_landed_rows(table):
    rows = [
        ("Order Completed", '{"user_id":"u","amount":-5,"currency":"","order_id":"o"}', ("amount", "must be positive")),
        ("Order Completed", '{"user_id":"u","amount":5,"currency":"","order_id":"o"}', ("currency", "is required")),
        ("Order Completed", '{"user_id":"u","amount":5,"currency":"EUR"}', ("orderId", "is required")),
        ("Order Completed", '{"user_id":"u","currency":"EUR","order_id":"o"}', ("amount", "must be positive")),
        ("Order Completed", '{"user_id":"u","amount":5,"currency":"EUR","order_id":"o"}', None),
        ("Order Completed", '{"user_id":"u","step":1}', None),
        ("Other", '{"user_id":"u","amount":-5}', None),
    ]
    ddl = "event_type string, session_id string, event_name string, payload string"
    for name, payload, error in rows:
        got = op.validate_signals(table(ddl, ("track", "s", name, payload)), "event").first()["error"]
        assert (tuple(got) if got else None) == error
