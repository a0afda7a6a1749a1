"""Totals kept up batch by batch against the full computation."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from signalyard import operators as op

T0 = dt.datetime(2024, 1, 1)
EVENT = "seq long, ts timestamp, event_name string"
ORDER = "tenant string, order_id string, ts timestamp, seq long, amount double, currency string"
REFUND = "tenant string, order_id string, refund string, amount double"


def day(n: float) -> dt.datetime:
    return T0 + dt.timedelta(days=n)


def test_counts_drop_rows_that_come_again_after_weeks(spark, tmp_path, rows_of):
    table = op.DailyCounts(spark, str(tmp_path / "c"), {"event_name": "string"}, buckets=2)
    batches = [
        [(1, day(0), "a"), (2, day(0.5), "a"), (2, day(0.5), "a"), (None, day(0), "a"), (None, day(0), "a"), (3, None, "b"), (9, day(1), None)],
        [(4, day(40), "b"), (1, day(0), "a"), (3, None, "b"), (5, day(0), "a")],
        [],
        [(n, ts, e) for n, ts, e in [(1, day(0), "a"), (2, day(0.5), "a"), (4, day(40), "b"), (9, day(1), None)]],
    ]
    for n, rows in enumerate(batches, 1):
        assert table.fold(spark.createDataFrame(rows, EVENT)) == n
    d0, d1, d40 = (day(n).date() for n in (0, 1, 40))
    want = [(d0, "a", 5), (d1, None, 1), (None, "b", 1), (d40, "b", 1)]
    assert rows_of(table.counts(), "day", "event_name", "n") == sorted(want, key=repr)
    assert (d0, "a", 4) in rows_of(table.counts(1), "day", "event_name", "n")
    assert {r["version"]: r["n_rows"] for r in table.versions().collect()} == {1: 3, 2: 2, 3: 0, 4: 0}
    # A version that is written again replaces itself.
    assert table.fold(spark.createDataFrame(batches[1], EVENT), version=2) == 2
    assert rows_of(table.counts(), "day", "event_name", "n") == sorted(want, key=repr)


def test_a_lookup_reads_the_days_of_the_batch_only(spark, tmp_path):
    table = op.DailyCounts(spark, str(tmp_path / "c"), {"event_name": "string"}, buckets=2)
    for start in (0, 50):
        table.fold(spark.createDataFrame([(n, day(n % 50), "a") for n in range(start, start + 50)], EVENT))
    ids = table._table.read_folders("ids", "row_id string, day date")
    one = ids.filter(F.col("day").isin([day(7).date()]))
    assert len(ids.inputFiles()) == 100 and one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "day" in scan and "2024-01-08" in scan or "19730" in scan  # folders of other days are not listed as input


def _full(orders, refunds):
    """Net revenue per tenant, day and currency, row by row."""
    first, back = {}, {}
    for tenant, order, ts, seq, amount, currency in orders:
        if order is not None:
            key = (tenant, order)
            first[key] = min(first.get(key, (ts, seq, amount, currency)), (ts, seq, amount, currency))
    for tenant, order, refund, amount in refunds:
        if order is not None:
            key = (tenant, order, refund)
            back[key] = min(back.get(key, amount), amount)
    total = {}
    for (tenant, order), (ts, _, amount, currency) in first.items():
        refunded = sum(a for (t, o, _), a in back.items() if (t, o) == (tenant, order))
        n, gross, less = total.get((tenant, ts.date(), currency), (0, 0, 0))
        total[tenant, ts.date(), currency] = (n + 1, gross + amount, less + refunded)
    return sorted(((*k, n, round(g, 6), round(r, 6), round(g - r, 6)) for k, (n, g, r) in total.items()), key=repr)


def test_revenue_equals_the_full_computation_after_every_batch(spark, tmp_path, rows_of):
    draw = random.Random(8)
    table = op.DailyRevenue(spark, str(tmp_path / "r"), seq="long", tenant="string", buckets=3)
    orders, refunds = [], []
    for n in range(5):
        # Orders come again at other times, refunds before their orders, again, and with other amounts.
        new_orders = [
            (draw.choice(["t", "s", None]), draw.choice([*"abcdefghij", None]), day(draw.randint(0, 9)), draw.randint(0, 3), float(draw.randint(1, 40)), draw.choice(["EUR", "USD"]))
            for _ in range(0 if n == 2 else 12)
        ]
        new_refunds = [
            (draw.choice(["t", "s", None]), draw.choice([*"abcdefghij", None]), f"r{draw.randint(0, 2)}", float(draw.randint(1, 5))) for _ in range(0 if n == 3 else 9)
        ]
        new_orders += draw.sample(orders, min(len(orders), 4))
        new_refunds += draw.sample(refunds, min(len(refunds), 4))
        orders, refunds = orders + new_orders, refunds + new_refunds
        table.fold(spark.createDataFrame(new_orders, ORDER), spark.createDataFrame(new_refunds, REFUND), ["refund"])
        got = [(*r[:4], *(round(x, 6) for x in r[4:])) for r in rows_of(table.totals(), "tenant", "day", "currency", "orders", "gross", "refunded", "net")]
        assert sorted(got, key=repr) == _full(orders, refunds)


def test_only_days_that_change_are_written(spark, tmp_path, rows_of):
    table = op.DailyRevenue(spark, str(tmp_path / "r"), seq="long")
    order, refund = ORDER.replace("tenant string, ", ""), REFUND.replace("tenant string, ", "")
    none = spark.createDataFrame([], refund)
    table.fold(spark.createDataFrame([(f"o{n}", day(n), n, 10.0, "EUR") for n in range(20)], order), none, ["refund"])
    # o5 was sent earlier, on day 2; o7 comes again unchanged; o9 is refunded.
    late = spark.createDataFrame([("o5", day(2), 5, 8.0, "EUR"), ("o7", day(7), 7, 10.0, "EUR")], order)
    table.fold(late, spark.createDataFrame([("o9", "x", 4.0), ("o9", "x", 4.0)], refund), ["refund"])
    want = [(day(5).date(), -1, -10.0, 0.0), (day(2).date(), 1, 8.0, 0.0), (day(9).date(), 0, 0.0, 4.0)]
    assert rows_of(table.changes(2), "day", "orders", "gross", "refunded") == sorted(want, key=repr)
    assert table.totals().filter("day = '2024-01-06'").count() == 0
    assert table.totals(1).filter("day = '2024-01-06'").count() == 1
