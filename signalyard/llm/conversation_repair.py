"""Conversation repair: the cheapest edits that make the role initials ``(s?(ua)+)?``, by weighted CYK parsing.

The repair grammar is in Chomsky normal form. A nonterminal is a pair of states of the role automaton: it derives the rows
that lead from one to the other, each kept, given another role or deleted, with rows inserted anywhere (leaf cells and
products are closed under insertion). A cell holds the least (cost, audit) of a nonterminal over a span of rows. A derivation
passes some state at every place of its span, so one split per span gives the same cell as all of them, and the chart holds
spans of 1, 2, 4, ... rows only: n - 1 products for n rows. Spans up to ``BLOCK`` rows meet in a task, longer ones level by
level, so a conversation of any length is spread over tasks.

Equal costs over one span mean equally many insertions for equal other edits, so no audit is a prefix of another, and
the least audit of a product is the product of the least audits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import batch_of, ship
from signalyard.plans import Ordered, prev_row, running_sum
from signalyard.session import durable

# Rows of a span that one task puts together, and spans that meet at each further level.
BLOCK, FAN = 256, 64

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_NEVER = 1 << 60

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 accept.
_STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_CELLS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
_NUMBER = {cell: k for k, cell in enumerate(_CELLS)}
# The grammar: for each nonterminal (p, q) its productions (p, r) (r, q).
RULES = [
    [(_NUMBER[p, r], _NUMBER[r, q]) for r in range(4) if (p, r) in _NUMBER and (r, q) in _NUMBER] for p, q in _CELLS
]

Spans = tuple[np.ndarray, np.ndarray]  # costs and audits, a row per span and a column per nonterminal


def product(left: Spans, right: Spans) -> Spans:
    """Cells of spans that consist of a left and a right part, by all productions of the grammar."""
    n = len(left[0])
    costs = np.full((n, len(_CELLS)), _NEVER, np.int64)
    audits = np.full((n, len(_CELLS)), "", object)
    for cell, rules in enumerate(RULES):
        for a, b in rules:
            cost = left[0][:, a] + right[0][:, b]
            best = costs[:, cell]
            at = np.flatnonzero((cost <= best) & (cost < _NEVER))
            if not len(at):
                continue
            text = left[1][at, a] + right[1][at, b]
            tied = cost[at] == best[at]
            at, text = (x[~tied | (text < audits[at, cell])] for x in (at, text))
            costs[at, cell] = cost[at]
            audits[at, cell] = text
    return costs, audits


def _terminal(edits: dict[tuple[int, int], tuple[int, str]]) -> Spans:
    costs = np.full((1, len(_CELLS)), _NEVER, np.int64)
    audits = np.full((1, len(_CELLS)), "", object)
    for cell, (cost, audit) in edits.items():
        if (cost, audit) < (costs[0, _NUMBER[cell]], audits[0, _NUMBER[cell]]):
            costs[0, _NUMBER[cell]], audits[0, _NUMBER[cell]] = cost, audit
    return costs, audits


def _insertions() -> Spans:
    """Cells of no rows at all: nothing, or the fewest insertions from one state to another."""
    found = {(p, p): (0, "") for p in range(4)}
    for _ in range(4):
        for (p, q), (cost, audit) in list(found.items()):
            for role in "ua":
                to = _STEPS.get((q, role))
                if to is not None:
                    step = (cost + INSERT, audit + "I")
                    found[p, to] = min(found.get((p, to), step), step)
    return _terminal(found)


def _leaf(initial: str, forced: bool, truncated: bool) -> Spans:
    """Cells of one row, closed under insertion."""
    edits = {(p, p): (DELETE, "D") for p in range(4)}
    extra = TRUNCATED if truncated else 0
    for (p, role), q in _STEPS.items() if not forced else ():
        options = [(KEEP + extra, "K")] if role == initial else []
        options += [(REROLE + extra, "R")] if role in "ua" else []
        for option in options:
            edits[p, q] = min(edits.get((p, q), option), option)
    around = _insertions()
    return product(product(around, _terminal(edits)), around)


# Kinds of rows: 3 * (number of the initial) + 0 (plain), 1 (truncated) or 2 (must go).
_INITIALS = "sua."
_LEAVES = [_leaf(i, fault == 2, fault == 1) for i in _INITIALS for fault in range(3)]
_LEAF_COSTS = np.concatenate([c for c, _ in _LEAVES])
_LEAF_AUDITS = np.concatenate([a for _, a in _LEAVES])


def parse(spans: Spans, segment: np.ndarray) -> Spans:
    """One row of cells per segment: neighbours are put together, then neighbours of those, and so on."""
    costs, audits = spans
    while len(segment) > 1 and (segment[1:] == segment[:-1]).any():
        head = np.concatenate([[True], segment[1:] != segment[:-1]])
        begins = np.flatnonzero(head)
        within = np.arange(len(segment)) - np.repeat(begins, np.diff(np.append(begins, len(segment))))
        left = np.flatnonzero(within % 2 == 0)
        paired = left[(left + 1 < len(segment)) & ~np.append(head, True)[left + 1]]
        cost, audit = product((costs[paired], audits[paired]), (costs[paired + 1], audits[paired + 1]))
        costs[paired], audits[paired] = cost, audit
        costs, audits, segment = costs[left], audits[left], segment[left]
    return costs, audits


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted batches cut between keys, with the number of each row's run."""
    held: pa.RecordBatch | None = None

    def runs(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, bool)
        for k in keys:
            codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        return np.cumsum(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        run = runs(batch)
        last = int(np.searchsorted(run, run[-1]))
        held = batch.slice(last)
        if last:
            yield batch.slice(0, last), run[:last]
    if held is not None:
        yield held, np.zeros(held.num_rows, np.int64)


def _cells(batch: pa.RecordBatch, run: np.ndarray, found: Spans) -> pa.RecordBatch:
    first = pa.array(np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])))
    keys = [batch.column(k).take(first) for k in ("conv_id", "block")]
    lists = [pa.array(found[0].tolist(), pa.list_(pa.int64())), pa.array(found[1].tolist(), pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([*keys, *lists], names=["conv_id", "block", "costs", "audits"])


def _parse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, run in _whole_runs(batches, ["conv_id", "block"]):
        kind = batch.column("kind").to_numpy()
        yield _cells(batch, run, parse((_LEAF_COSTS[kind], _LEAF_AUDITS[kind]), run))


def _parse_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, run in _whole_runs(batches, ["conv_id", "block"]):
        shape = (batch.num_rows, len(_CELLS))
        costs = np.array(batch.column("costs").flatten().to_numpy(), np.int64).reshape(shape)
        audits = np.array(batch.column("audits").flatten().to_pylist(), object).reshape(shape)
        yield _cells(batch, run, parse((costs, audits), run))


_EDITS = pa.schema([("place", pa.int64()), ("edit", pa.string()), ("i", pa.int64()), ("new_role", pa.string())])


def edits_of(audit: str) -> dict[str, np.ndarray]:
    """The rows that an audit leaves: place from 0, edit, number of the source row (0: inserted), role if it is a new one."""
    letters = np.frombuffer(audit.encode(), np.uint8)
    source = np.cumsum(letters != ord("I"))
    out = np.flatnonzero(letters != ord("D"))
    letter = letters[out]
    # An odd number of rows begins with a system row, which is never a new one.
    after = np.arange(len(out)) - len(out) % 2
    role = np.where(after % 2 == 0, "user", "assistant").astype(object)
    role[letter == ord("K")] = None
    return {
        "place": np.arange(len(out)), "edit": np.array([*"DIKR"], object)[np.searchsorted([68, 73, 75, 82], letter)],
        "i": np.where(letter == ord("I"), 0, source[out]), "new_role": role,
    }


def _lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, audit in enumerate(batch.column("audit").to_pylist()):
            found = batch_of(_EDITS, **edits_of(audit))
            own = batch.column("conv_id").take(pa.array(np.full(found.num_rows, row)))
            yield pa.RecordBatch.from_arrays([own, *found.columns], names=["conv_id", *_EDITS.names])


def numbered_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, i (from 1), fault and the row before, in the order of turn (nulls first), role and text."""
    keys = ["conv_id"]
    filled = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    placed = (
        Ordered.of(filled, keys, ["turn", "role", "text"])
        .scan(i=running_sum(F.lit(1).cast("long")), before=prev_row(F.struct("turn", "role")))
        .frame()
    )
    placed = durable(placed.withColumn("_digest", F.sha2(F.col("text").cast("binary"), 256)))
    seen = Ordered.of(placed, ["conv_id", "role", "_digest"], ["i"]).scan(_nth=running_sum(F.lit(1))).frame()
    filled_text = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    fault = (
        F.when(filled_text == "", "blank")
        .when(F.col("_nth") > 1, "duplicate")
        .when(~F.substring(filled_text, -1, 1).isin(".", "!", "?"), "truncated")
    )
    return durable(seen.select("conv_id", "turn", "role", "text", "i", "before", fault.alias("fault")))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report per conversation, repaired rows) of conv_id, turn, role, text.

    Rows are taken by turn (nulls first), ties by role and text; a null role or text is one space; a null conv_id is a
    conversation like any other. A row's fault is the first of: blank (no ``[^\\x20\\x09-\\x0D]``), duplicate (role and text
    seen earlier in the conversation), truncated (last such character not one of ``.!?``). Edits: keep 0, another role 3,
    delete 4 (the only one for blank and duplicate rows), insert an empty row 3; a truncated row that stays costs 3 more.

    Report: conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs) and audit, the initials of the cheapest edits (ties:
    the least text). Repaired rows: conv_id, place (from 0), edit, turn (null where inserted), role, text. An empty table gives empty
    results; other columns are not carried; equal rows are duplicates.
    """
    ship(conversations.sparkSession)
    rows = numbered_rows(conversations)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(F.col("fault").isin("blank", "duplicate"), 2).when(F.col("fault") == "truncated", 1).otherwise(0)
    block = F.floor((F.col("i") - 1) / BLOCK)
    kind = (3 * number + fault).cast("int").alias("kind")
    ddl = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    cell_ddl = f"{ddl}, block long, costs array<bigint>, audits array<string>"

    level = (
        rows.select("conv_id", block.alias("block"), "i", kind)
        .repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "i")
        .mapInArrow(_parse_rows, cell_ddl)
    )
    spans = -(-(rows.agg(F.max("i")).first()[0] or 0) // BLOCK)
    while spans > 1:
        level = (
            level.withColumn("_at", F.col("block"))
            .withColumn("block", F.floor(F.col("block") / FAN))
            .repartition("conv_id", "block")
            .sortWithinPartitions("conv_id", "block", "_at")
            .mapInArrow(_parse_spans, cell_ddl)
        )
        spans = -(-spans // FAN)
    ends = [F.struct(F.col("costs")[k].alias("cost"), F.col("audits")[k].alias("audit")) for k in (_NUMBER[0, 0], _NUMBER[0, 3])]
    parsed = durable(level.select("conv_id", F.least(*ends).alias("best")).select("conv_id", "best.*"))

    pair = F.concat(F.substring("before.role", 1, 1), initial)
    turned = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("before.turn"))
    counted = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if(turned), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if((F.col("i") > 1) & ~pair.isin("su", "ua", "au")).alias("illegal"),
    )
    same = counted["conv_id"].eqNullSafe(parsed["conv_id"])
    report = counted.join(parsed, same).select(counted["*"], parsed["cost"], parsed["audit"])

    edits = parsed.select("conv_id", "audit").mapInArrow(_lay_out, f"{ddl}, place long, edit string, i long, new_role string")
    on = rows["conv_id"].eqNullSafe(edits["conv_id"]) & (rows["i"] == edits["i"])
    repaired = edits.join(rows, on, "left").select(
        edits["conv_id"], edits["place"], edits["edit"], rows["turn"],
        F.coalesce(edits["new_role"], rows["role"]).alias("role"), F.coalesce(rows["text"], F.lit("")).alias("text"),
    )
    return report, repaired


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its ``role:text`` lines, joined by newlines.

    The digest is a chain over the rows of a conversation, so one task reads them in order, as a stream: it holds one Arrow
    batch and the state of the hash.
    """
    ship(repaired.sparkSession)
    ddl = f"conv_id {repaired.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"
    lines = repaired.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, owner = None, None

        def done(ids: list, found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(found, pa.string())], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            kind, ids, found = batch.schema.field("conv_id").type, [], []
            for conv, place, line in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "line")), strict=True):
                if place == 0:
                    if state is not None:
                        ids.append(owner)
                        found.append(state.hexdigest())
                    state, owner = hashlib.sha256(line.encode()), conv
                else:
                    state.update(b"\n" + line.encode())
            yield done(ids, found)
        if state is not None:
            yield done([owner], [state.hexdigest()])

    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "place", "line").mapInArrow(stream, ddl)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a faulty log leaves them, by crc32(``conv_id:turn``) % 20; a null is one space.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it a user's.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    chance = F.crc32(name.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), chance.alias("_c")
    )
    text = F.when(F.col("_c") == 1, "").when(F.col("_c") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_c") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_c") == 0, 0).when(F.col("_c") == 3, 2).otherwise(1)
    return rows.withColumn("_k", F.explode(F.array_repeat(F.lit(1), times))).select("conv_id", "turn", role.alias("role"), text.alias("text"))
