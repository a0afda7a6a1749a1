"""Joins between signals. As-of and interval joins are ordered scans; see ``plans``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.functions.payload import as_props, merged_map
from signalyard.functions.scalars import epoch_us
from signalyard.operators.keys import row_order, with_tenant
from signalyard.plans import Ordered, asof_backward, asof_forward, lookup, next_row, running_sum, suffix_sum
from signalyard.schemas import ENUMS, ERROR_LEVEL
from signalyard.session import durable

# Moments that share one copy of the properties in force.
_MOMENTS = 1024


def asof_profile(
    events: DataFrame, identifies: DataFrame, traits: Sequence[str] = ("payload",), user: str = "user_id"
) -> DataFrame:
    """Each event with the user's latest traits at or before its time, as ``profile_<trait>``."""
    right = identifies.select(
        *with_tenant(identifies, user),
        *row_order(identifies),
        *[F.col(t).alias(f"profile_{t}") for t in traits],
    )
    return asof_backward(
        events, right, with_tenant(events, user), [f"profile_{t}" for t in traits], row_order(events)
    )


def asof_group(events: DataFrame, groups: DataFrame, user: str = "user_id", group: str = "group_id") -> DataFrame:
    """Each event with the group its user belonged to at that time, as ``current_group``."""
    right = groups.select(
        *with_tenant(groups, user), *row_order(groups), F.col(group).alias("current_group")
    )
    return asof_backward(events, right, with_tenant(events, user), ["current_group"], row_order(events))


def super_property_states(
    changes: DataFrame, client: str = "client_id", moments: DataFrame | None = None
) -> DataFrame:
    """The registered properties at each moment, as ``super_props map<string,variant>``.

    ``changes`` has (client, ts, seq, op, key, value): ``register`` sets a key to ``value`` (a JSON
    value), ``unregister`` removes it. ``moments`` has (client, ts, seq), by default those of the
    changes; a change at a moment's own (ts, seq) counts. The work is linear in changes, moments and entries
    of the maps: a key that is no longer registered costs nothing at later moments.
    """
    scope = with_tenant(changes, client)
    order = row_order(changes)
    marks = (changes if moments is None else moments).select(*scope, *order).distinct()
    # Moments are numbered per client; a change knows how many of them come before and after it.
    line = changes.select(*scope, *order, F.lit(0).alias("_rank"), F.struct("key", "op", "value").alias("_set")).unionByName(
        marks.select(*scope, *order, F.lit(1).alias("_rank")), allowMissingColumns=True
    )
    numbered = durable(
        Ordered.of(line, scope, [*order, "_rank"])
        .scan(_upto=running_sum("_rank"), _from=suffix_sum("_rank"))
        .frame()
    )
    changed = numbered.filter("_rank = 0").select(*scope, "_set.*", *order, "_upto", "_from")
    # A value is live for the moments up to its key's next change; removed keys have no moments.
    lives = (
        Ordered.of(changed, [*scope, "key"], order)
        .scan(_next=next_row("_upto"))
        .frame()
        .select(
            *scope,
            (F.col("_upto") + 1).alias("_first"),
            F.coalesce("_next", F.col("_upto") + F.col("_from")).alias("_last"),
            F.when(F.col("op") == "register", F.struct("key", "value")).alias("_held"),
        )
        .filter("_held IS NOT NULL AND _first <= _last")
    )
    points = numbered.filter("_rank = 1").select(
        *scope, F.col("_upto").alias("_first"), F.col("_upto").alias("_last"), F.struct(*order).alias("_moment")
    )
    # Lives travel once per block of moments and are laid out in the task that collects them: as many rows as
    # there are entries in the maps that come out.
    blocks = lives.unionByName(points, allowMissingColumns=True).withColumn(
        "_block", F.explode(F.sequence(F.expr(f"_first DIV {_MOMENTS}"), F.expr(f"_last DIV {_MOMENTS}")))
    )
    begin = F.greatest("_first", F.col("_block") * _MOMENTS)
    end = F.least("_last", (F.col("_block") + 1) * _MOMENTS - 1)
    states = (
        blocks.repartition(*scope, "_block")
        .withColumn("_i", F.explode(F.sequence(begin, end)))
        .groupBy(*scope, "_block", "_i")
        .agg(F.collect_list("_held").alias("_live"), F.max("_moment").alias("_moment"))
    )
    props = F.map_from_entries(
        F.transform("_live", lambda e: F.struct(e["key"], F.parse_json(F.coalesce(e["value"], F.lit("null")))))
    )
    return states.select(*scope, "_moment.*", props.alias("super_props"))


def asof_super_props(
    events: DataFrame,
    changes: DataFrame,
    client: str = "client_id",
    reserved: dict[str, Column] | None = None,
    props: str | None = None,
    out: str = "payload",
) -> DataFrame:
    """Events with the super properties in force at their time merged into the payload.

    A change at the event's own time comes first. ``reserved`` keys and the ``props`` column are merged
    over the super properties, in this order; without either the payload is just the super properties.
    States are built only for changes that some event comes right after.
    """
    from signalyard.operators.payloads import props_column

    keys, order = with_tenant(events, client), row_order(events)
    marks = changes.select(*keys, *order, F.struct(*order).alias("_change"))
    met = asof_backward(events.select(*keys, *order), marks, keys, ["_change"], order)
    moments = met.filter(F.col("_change").isNotNull()).select(*keys, "_change.*").distinct()
    states = super_property_states(changes, client, moments)
    # Variants are carried as JSON text through the scan, which keeps the rows plain.
    text = states.withColumn("_super", F.to_json("super_props")).drop("super_props")
    rows = asof_backward(events, text, keys, ["_super"], order)
    sources = [F.from_json("_super", "map<string,variant>")]
    if reserved:
        sources.append(as_props(reserved))
    if props:
        sources.append(props_column(rows, props))
    return rows.withColumn(out, F.to_json(merged_map(*sources))).drop("_super")


def events_with_logs(events: DataFrame, logs: DataFrame, how: str = "inner") -> DataFrame:
    """Events with a summary of the logs of their session: count, errors, worst level, first and last.

    Logs are summed up per session first, so the result has one row per event however busy the session
    is. Rows without a session never match.
    """
    keys = with_tenant(events, "session_id")
    summary = (
        logs.filter("session_id IS NOT NULL")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n_logs"),
            F.count_if(F.col("level") <= ERROR_LEVEL).alias("n_errors"),
            F.min("level").alias("worst_level"),
            F.min("ts").alias("first_log_ts"),
            F.max("ts").alias("last_log_ts"),
        )
    )
    if how == "inner":
        events = events.filter("session_id IS NOT NULL")
    joined = lookup(events, summary, keys, how)
    counts = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("n_logs", "n_errors")}
    return joined.select(
        *events.columns, counts["n_logs"], counts["n_errors"], "worst_level", "first_log_ts", "last_log_ts"
    )


def logs_near_event(
    events: DataFrame,
    logs: DataFrame,
    before: str = "5 minutes",
    after: str = "5 minutes",
    on: Sequence[str] = ("session_id",),
) -> DataFrame:
    """Events with the logs of the same session (or service) from ``before`` to ``after`` their time.

    Adds ``n_logs``, ``n_errors`` and ``worst_level``. The counts are differences of running counts per
    level at the two ends of the interval, so the work is linear in events and logs: matching pairs are
    never written out. ``events`` needs a ``seq`` that is unique within its tenant.
    """
    keys = with_tenant(events, *on)
    levels = list(ENUMS["level"])
    known = " AND ".join(f"{k} IS NOT NULL" for k in on)

    def at(rank: int, when: Column) -> list[Column]:
        return [epoch_us(when).alias("_at"), F.lit(rank).alias("_rank")]

    flags = [(F.col("level") == n).cast("bigint").alias(f"_l{n}") for n in levels]
    points = logs.filter(known).select(*keys, *at(1, F.col("ts")), *flags)
    lower = events.filter(known).select(
        *keys, *at(0, F.col("ts") - F.expr(f"INTERVAL {before}")), F.col("seq").alias("_seq"), F.lit(-1).alias("_sign")
    )
    upper = events.filter(known).select(
        *keys, *at(2, F.col("ts") + F.expr(f"INTERVAL {after}")), F.col("seq").alias("_seq"), F.lit(1).alias("_sign")
    )
    line = points.unionByName(lower, allowMissingColumns=True).unionByName(upper, allowMissingColumns=True)
    counted = (
        Ordered.of(line, keys, ["_at", "_rank", "_seq"])
        .scan(**{f"_c{n}": running_sum(F.coalesce(f"_l{n}", F.lit(0))) for n in levels})
        .filter(F.col("_sign").isNotNull())
        .frame()
    )
    row = with_tenant(events, "seq")  # ``seq`` is unique within a tenant only
    own = [F.col("_seq").alias("seq") if c == "seq" else F.col(c) for c in row]
    per_event = counted.groupBy(*own).agg(
        *[F.sum(F.col("_sign") * F.col(f"_c{n}")).alias(f"_n{n}") for n in levels]
    )
    total = sum((F.col(f"_n{n}") for n in levels[1:]), F.col("_n0"))
    errors = sum((F.col(f"_n{n}") for n in levels[1 : ERROR_LEVEL + 1]), F.col("_n0"))
    worst = F.coalesce(*[F.when(F.col(f"_n{n}") > 0, F.lit(n)) for n in levels])
    summary = per_event.select(
        *row, total.alias("n_logs"), errors.alias("n_errors"), worst.cast("int").alias("worst_level")
    )
    joined = events.join(summary, row, "left")
    return joined.select(
        *events.columns,
        F.coalesce("n_logs", F.lit(0)).alias("n_logs"),
        F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
        "worst_level",
    )


def net_revenue(orders: DataFrame, refunds: DataFrame, identity: Sequence[str] = ()) -> DataFrame:
    """Per order: gross amount, refunded or canceled amount, and what is left.

    Delivery is at least once, so repeats count once: of several rows of one order the earliest stands, whole, and
    refunds of one order that agree in ``identity`` are one refund, the least amount if they differ. Without ``identity``, refunds
    equal in every column but ``seq`` are one, and refunds that may be alike need a column that tells them apart.
    """
    keys = with_tenant(orders, "order_id")
    carried = [c for c in orders.columns if c not in (*keys, "amount", "seq")]
    earliest = F.min(F.struct(*row_order(orders), "amount", *[c for c in carried if c != "ts"])).alias("_first")
    gross = orders.groupBy(*keys).agg(earliest).select(
        *keys, F.col("_first.amount").alias("gross"), *[F.col("_first")[c].alias(c) for c in carried]
    )
    if identity:
        own = list(dict.fromkeys([*keys, *identity]))
        once = refunds.groupBy(*own).agg(F.min("amount").alias("amount"))
    else:
        once = refunds.dropDuplicates([c for c in refunds.columns if c != "seq"])
    back = once.groupBy(*keys).agg(F.sum("amount").alias("refunded"))
    refunded = F.coalesce("refunded", F.lit(0.0))
    return gross.join(back, keys, "left").select(
        *keys, *carried, "gross", refunded.alias("refunded"), (F.col("gross") - refunded).alias("net")
    )


def _users(df: DataFrame, user: str) -> DataFrame:
    return df.select(*with_tenant(df, user)).distinct()


def users_without(events: DataFrame, identifies: DataFrame, user: str = "user_id") -> DataFrame:
    """Active users who were never identified."""
    return _users(events, user).join(_users(identifies, user), with_tenant(events, user), "left_anti")


def users_with(
    events: DataFrame, names: Sequence[str], user: str = "user_id", population: DataFrame | None = None
) -> DataFrame:
    """Users who did one of the given events; with ``population``, its rows for such users."""
    did = events.filter(F.col("event_name").isin(*names))
    if population is None:
        return _users(did, user)
    return population.join(_users(did, user), with_tenant(population, user), "left_semi")


def orphan_aliases(aliases: DataFrame, events: DataFrame, user: str = "user_id") -> DataFrame:
    """Aliases whose previous id never shows up in any activity."""
    scope = with_tenant(events)
    seen = events.select(*scope, F.col(user).alias("previous_id")).distinct()
    return aliases.join(seen, [*scope, "previous_id"], "left_anti").select(*aliases.columns)


def reconcile_batches(sent: DataFrame, delivered: DataFrame) -> DataFrame:
    """Sent against delivered batches: ``ok``, ``missing``, ``extra`` or ``duplicated``."""
    keys = with_tenant(sent, "schema_type", "batch_id")
    s = sent.groupBy(*keys).agg(F.count("*").alias("n_sent"))
    d = delivered.groupBy(*keys).agg(F.count("*").alias("n_delivered"))
    n_sent = F.coalesce("n_sent", F.lit(0))
    n_delivered = F.coalesce("n_delivered", F.lit(0))
    status = (
        F.when(n_delivered == 0, "missing")
        .when(n_sent == 0, "extra")
        .when(n_delivered > n_sent, "duplicated")
        .when(n_delivered < n_sent, "missing")
        .otherwise("ok")
    )
    return s.join(d, keys, "full_outer").select(
        *keys, n_sent.alias("n_sent"), n_delivered.alias("n_delivered"), status.alias("status")
    )


def metrics_align(
    a: DataFrame, b: DataFrame, tolerance: str, on: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Samples of ``a`` with the sample of ``b`` nearest in time, within ``tolerance``.

    Adds ``other_ts`` and ``other_value``. The earlier sample wins a tie. Samples of different tenants never meet.
    """
    keys = with_tenant(a, *on)
    order = row_order(a)
    other = b.select(*keys, *row_order(b), F.struct(F.col("ts"), F.col(value).alias("value")).alias("_pick"))
    back = asof_backward(a, other.withColumnRenamed("_pick", "_before"), keys, ["_before"], order)
    both = asof_forward(back, other.withColumnRenamed("_pick", "_after"), keys, ["_after"], order)
    gap_before = epoch_us("ts") - epoch_us("_before.ts")
    gap_after = epoch_us("_after.ts") - epoch_us("ts")
    use_before = F.col("_after").isNull() | (F.col("_before").isNotNull() & (gap_before <= gap_after))
    picked = F.when(use_before, F.col("_before")).otherwise(F.col("_after"))
    gap = F.abs(epoch_us("ts") - epoch_us("_pick.ts"))
    near = F.when(gap <= epoch_us(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {tolerance}")), F.col("_pick"))
    return (
        both.withColumn("_pick", picked)
        .withColumn("_near", near)
        .select(*a.columns, F.col("_near.ts").alias("other_ts"), F.col("_near.value").alias("other_value"))
    )
