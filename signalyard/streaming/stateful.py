"""Per-key state that Catalyst has no form for: the previous counter value, registered properties, logs around events.

State processors (``transformWithStateInPandas``) get the rows of a key in Arrow batches, in no order. ``SortedRows`` puts them
in time order within bounded memory: batches are sorted one by one, and when there are several, laid down in the state store in
blocks and merged a block at a time. So a key may have any number of rows in a micro-batch.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from signalyard.operators.keys import row_order, with_tenant
from signalyard.operators.metrics import with_series
from signalyard.plans.trailing import width_us

# The processors travel to the workers with their helpers, which therefore need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a sorted batch that are read back at a time.
BLOCK_ROWS = 1000


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _packed(rows: pd.DataFrame) -> bytes:
    part = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema) as out:
        out.write_batch(part)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(bytes(data)) as source:
        return source.read_pandas()


class SortedRows:
    """The rows of a key in the order of ``by``, a part at a time."""

    def __init__(self, handle: StatefulProcessorHandle, by: Sequence[str], block_rows: int) -> None:
        self._by, self._block_rows = list(by), block_rows
        self._blocks = handle.getMapState("sorted", "run int, block int", "rows binary")

    def _put(self, run: int, rows: pd.DataFrame) -> int:
        """Lay down a sorted batch; the number of its blocks."""
        starts = range(0, len(rows), self._block_rows)
        for block, start in enumerate(starts):
            self._blocks.updateValue((run, block), (_packed(rows.iloc[start : start + self._block_rows]),))
        return len(starts)

    def _get(self, run: int, block: int) -> pd.DataFrame:
        data = self._blocks.getValue((run, block))[0]
        self._blocks.removeKey((run, block))
        return _unpacked(data)

    def _upto(self, rows: pd.DataFrame, bound: tuple) -> int:
        """How many of the sorted rows are not after ``bound``."""
        before, same = np.zeros(len(rows), bool), np.ones(len(rows), bool)
        for name, limit in zip(self._by, bound, strict=True):
            values = rows[name].to_numpy()
            before |= same & (values < limit)
            same &= values == limit
        return int((before | same).sum())

    def parts(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ordered = (b.sort_values(self._by, kind="stable", ignore_index=True) for b in batches if len(b))
        first = next(ordered, None)
        if first is None:
            return
        second = next(ordered, None)
        if second is None:
            yield first
            return
        sizes = [self._put(0, first), self._put(1, second)]
        del first, second
        for rows in ordered:
            sizes.append(self._put(len(sizes), rows))
        heads = {run: self._get(run, 0) for run in range(len(sizes))}
        read = [1] * len(sizes)
        while heads:
            # Rows up to the least end of a block that has a successor can have nothing before them any more.
            ends = [tuple(h[c].iloc[-1] for c in self._by) for run, h in heads.items() if read[run] < sizes[run]]
            bound = min(ends) if ends else None
            taken = []
            for run in list(heads):
                n = len(heads[run]) if bound is None else self._upto(heads[run], bound)
                taken.append(heads[run].iloc[:n])
                heads[run] = heads[run].iloc[n:]
                if not len(heads[run]):
                    if read[run] < sizes[run]:
                        heads[run] = self._get(run, read[run])
                        read[run] += 1
                    else:
                        del heads[run]
            yield pd.concat(taken, ignore_index=True).sort_values(self._by, kind="stable", ignore_index=True)


def _steps(value: np.ndarray, before: float) -> np.ndarray:
    """Reset-aware growth from sample to sample; NaN before the first sample means no growth yet."""
    previous = np.concatenate([[before], value[:-1]])
    grown = np.where(value < previous, value, value - previous)
    return np.where(np.isnan(previous), 0.0, grown)


class _Expiring(StatefulProcessor):
    """A processor whose key is let go at one moment of event time, which every micro-batch may move."""

    def _expire_at(self, moment_ms: int) -> None:
        due = list(self.handle.listTimers())
        if due != [moment_ms]:
            for old in due:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(moment_ms)

    def close(self) -> None:
        pass


class CounterSteps(_Expiring):
    """The last sample of a series, from one micro-batch to the next."""

    def __init__(self, ttl_ms: int, block_rows: int, by: Sequence[str]) -> None:
        self._ttl_ms, self._block_rows, self._by = ttl_ms, block_rows, list(by)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self._last = handle.getValueState("last", "us bigint, value double")
        self._sorted = SortedRows(handle, self._by, self._block_rows)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        newest = initialState.sort_values("us").iloc[-1]
        self._last.update((int(newest["us"]), float(newest["value"])))
        self._expire_at(int(newest["us"]) // 1000 + self._ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self._last.get() if self._last.exists() else None
        # Samples up to the state of the last micro-batch are late, however many parts this one has.
        bound, last_value = (known[0], known[1]) if known is not None else (None, float("nan"))
        newest = bound
        for part in self._sorted.parts(rows):
            at, value = part["us"].to_numpy(), part["value"].to_numpy(dtype="float64")
            late = np.zeros(len(part), dtype=bool) if bound is None else at <= bound
            step = np.zeros(len(part))
            fresh = value[~late]
            if len(fresh):
                step[~late] = _steps(fresh, last_value)
                last_value, newest = float(fresh[-1]), int(at[~late][-1])
            yield part.assign(step=step, late=late)
        if newest is not None:
            self._last.update((newest, last_value))
            self._expire_at(max(newest // 1000 + self._ttl_ms, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._last.clear()
        return iter(())


def counter_stream(
    metrics: DataFrame, ttl: str = "1 day", delay: str = "1 hour", initial: DataFrame | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Cumulative counter samples with ``step``, the stream form of ``counter_steps``.

    Reset-aware. The last sample per series is state; it is dropped once the series is silent for
    ``ttl`` of event time. A sample not newer than the state is flagged ``late`` and has step 0; samples
    older than the watermark (``delay``) are dropped by Spark. ``initial`` is a batch table of samples (of the
    columns of ``metrics``) whose newest per series is the state to begin with. Samples of one time go by ``seq`` where there is one;
    without it their order is that of arrival, which is no order when a micro-batch has several files.
    """
    def shaped(df: DataFrame, watermark: bool) -> tuple[DataFrame, list[str]]:
        series = with_series(df)
        series = series.withWatermark("ts", delay) if watermark else series
        keys = with_tenant(series, "name", "series_key")
        value = F.col("value").cast("double").alias("value")
        return series.select(*keys, "ts", F.unix_micros("ts").alias("us"), *ties, value), keys

    ties = [c for c in row_order(metrics) if c != "ts"]
    rows, keys = shaped(metrics, True)
    start = None
    if initial is not None:
        # The newest sample only: of a long history one row per series reaches the state.
        known = shaped(initial, False)[0].groupBy(*keys).agg(F.max_by(F.struct("us", "value"), F.struct("us", *ties)).alias("_s"))
        start = known.select(*keys, "_s.*").groupBy(*keys)
    stepped = rows.groupBy(*keys).transformWithStateInPandas(
        CounterSteps(width_us(ttl) // 1000, block_rows, ["us", *ties]),
        outputStructType=f"{_fields(rows)}, step double, late boolean",
        outputMode="append",
        timeMode="EventTime",
        initialState=start,
    )
    return stepped.select(*keys, "ts", "value", "step", "late")


class HeldProperties(_Expiring):
    """What a client has registered: one entry of map state per property."""

    def __init__(self, columns: list[str], block_rows: int) -> None:
        self._columns, self._block_rows = columns, block_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self._held = handle.getMapState("held", "name string", "text string")
        self._newest = handle.getValueState("newest", "ms bigint")
        self._sorted = SortedRows(handle, ["us", "is_event", "seq"], self._block_rows)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        for name, text in zip(initialState["key"], initialState["value"]):
            self._held.updateValue((name,), (text if isinstance(text, str) else "null",))
        self._newest.update((int(initialState["us"].max()) // 1000,))
        self._expire_at(max(int(initialState["us"].max()) // 1000, timerValues.getCurrentWatermarkInMs()) + 1)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {name[0]: text[0] for name, text in self._held.iterator()}
        before = dict(held)
        newest = self._newest.get()[0] if self._newest.exists() else 0
        for part in self._sorted.parts(rows):
            newest = max(newest, int(part["us"].iloc[-1]) // 1000)
            is_event = part["is_event"].to_numpy(dtype=bool)
            texts = _texts(part, is_event, held)
            if is_event.any():
                yield part.loc[is_event, self._columns].assign(super_props=texts)
        for name in before.keys() - held.keys():
            self._held.removeKey((name,))
        for name, text in held.items():
            if before.get(name) != text:
                self._held.updateValue((name,), (text,))
        self._newest.update((newest,))
        self._expire_at(max(newest, timerValues.getCurrentWatermarkInMs()) + 1)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._held.clear()
        self._newest.clear()
        return iter(())


def _texts(part: pd.DataFrame, is_event: np.ndarray, held: dict[str, str]) -> np.ndarray:
    """For each event the properties after the changes before it, as JSON; ``held`` is brought up to date.

    A property at a time: its value at an event is that of its last change before the event's place.
    """
    events, changes = np.flatnonzero(is_event), np.flatnonzero(~is_event)
    changed = part.iloc[changes]
    texts = changed["value"].where(changed["value"].notna(), "null").to_numpy(dtype=object)
    texts = np.where(changed["op"].to_numpy() == "register", texts, None)
    codes, names = pd.factorize(changed["key"].to_numpy(dtype=object))
    out = np.full(len(events), "", dtype=object)
    order = np.argsort(codes, kind="stable")
    ends = np.searchsorted(codes[order], np.arange(len(names) + 1))
    own = {name: order[a:b] for name, a, b in zip(names, ends[:-1], ends[1:], strict=True)}
    for name in sorted(held.keys() | own.keys()):
        mine = own.get(name, np.zeros(0, np.int64))
        values = np.concatenate([[held.get(name)], texts[mine]])
        shown = np.array([None if v is None else f",{json.dumps(name)}:{v}" for v in values], dtype=object)
        shown[values == None] = ""  # noqa: E711
        out = out + shown[np.searchsorted(changes[mine], events)]
        if values[-1] is None:
            held.pop(name, None)
        else:
            held[name] = values[-1]
    return ("{" + pd.Series(out, dtype=object).str[1:] + "}").to_numpy(dtype=object)


def super_props_stream(
    changes: DataFrame, events: DataFrame, client: str = "client_id", ttl: str = "30 days", initial: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Events with ``super_props``, the properties registered by their client so far, as JSON.

    Arrival order across micro-batches, time order inside one, a change before an event of the same
    time. ``changes`` has (client, ts, seq, op, key, value), ``events`` has (client, ts, seq, row) with
    ``row`` any JSON text; merge with ``merge_properties`` afterwards. A client id lives as long as its process:
    what it registered is let go once it is silent for ``ttl`` of event time. Rows older than the newest by more than
    ``ttl`` are dropped by Spark. ``initial`` is a batch table (client, ts, key, value) of what is registered to begin with, one row
    per client and key.
    """
    keys = with_tenant(events, client)
    none = F.lit(None).cast("string")
    us = F.unix_micros("ts").alias("us")
    both = changes.select(
        *keys, "ts", us, "seq", F.lit(False).alias("is_event"), "op", "key", "value", none.alias("row")
    ).unionByName(
        events.select(
            *keys, "ts", us, "seq", F.lit(True).alias("is_event"), none.alias("op"), none.alias("key"), none.alias("value"), "row"
        )
    )
    both = both.withWatermark("ts", ttl)
    columns = [*keys, "us", "seq", "row"]
    start = None if initial is None else initial.select(*keys, us, "key", "value").groupBy(*keys)
    found = both.groupBy(*keys).transformWithStateInPandas(
        HeldProperties(columns, block_rows),
        outputStructType=f"{_fields(both.select(*columns))}, super_props string",
        outputMode="append",
        timeMode="EventTime",
        initialState=start,
    )
    return found.select(*keys, F.timestamp_micros("us").alias("ts"), "seq", "row", "super_props")


# Stands for a missing time and for a missing level: integers with nulls would reach Python as doubles.
NO_TIME, NO_LEVEL = -(2**63), 2**63 - 1


class _LogsInOrder:
    """Logs by session and time, asked for ranges of time."""

    def __init__(self, parts: list[pd.DataFrame]) -> None:
        rows = pd.concat(parts, ignore_index=True)
        codes, sessions = pd.factorize(rows["session"].to_numpy(dtype=object))
        at = rows["us"].to_numpy()
        self._sessions, self._times = pd.Index(sessions), np.unique(at)
        # One number per (session, place of the time); a session has one place more than there are times.
        self._wide = len(self._times) + 1
        places = codes * self._wide + np.searchsorted(self._times, at)
        order = np.argsort(places, kind="stable")
        self._places, self._level = places[order], rows["level"].to_numpy()[order]
        self._errors = np.concatenate([[0], np.cumsum(rows["error"].to_numpy()[order])])

    def between(self, session: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, errors and least level of the logs of each session from ``low`` to ``high``, both ends included."""
        codes = self._sessions.get_indexer(session)
        begin = np.searchsorted(self._places, codes * self._wide + np.searchsorted(self._times, low, "left"))
        end = np.searchsorted(self._places, codes * self._wide + np.searchsorted(self._times, high, "right"))
        end = np.where(codes < 0, begin, end)
        n = end - begin
        worst = np.full(len(n), NO_LEVEL)
        # Least levels of 1, 2, 4, ... logs in a row; two such stretches cover a range.
        least, length = self._level, 1
        while (n >= length).any():
            own = np.flatnonzero((n >= length) & (n < 2 * length))
            worst[own] = np.minimum(least[begin[own]], least[end[own] - length])
            least = np.minimum(least[:-length], least[length:]) if len(least) > length else least
            length *= 2
        return n, self._errors[end] - self._errors[begin], worst


class NearLogs(StatefulProcessor):
    """Events and logs of a block of time, for a bucket of sessions, until the block is complete."""

    def __init__(self, before: int, after: int, block: int) -> None:
        self._before, self._after, self._block = before, after, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self._events = handle.getListState("events", "rows binary")
        self._logs = handle.getListState("logs", "rows binary")

    def _met(self, events: pd.DataFrame, logs: _LogsInOrder | None) -> pd.DataFrame:
        n = errors = np.zeros(len(events), np.int64)
        worst = np.full(len(events), NO_LEVEL)
        if logs is not None:
            at = events["us"].to_numpy()
            n, errors, worst = logs.between(events["session"].to_numpy(dtype=object), at - self._before, at + self._after)
        return events[["us", "row"]].assign(n_logs=n, n_errors=errors, worst=worst)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            is_event = part["is_event"].to_numpy(dtype=bool)
            events = part.loc[is_event, ["session", "us", "row"]]
            if key[1] == NO_TIME:
                yield self._met(events, None)
                continue
            if len(events):
                self._events.appendValue((_packed(events),))
            if len(events) < len(part):
                self._logs.appendValue((_packed(part.loc[~is_event, ["session", "us", "error", "level"]]),))
        if key[1] != NO_TIME and not list(self.handle.listTimers()):
            self.handle.registerTimer(-(-((key[1] + 1) * self._block + self._after) // 1000))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._events.exists():
            logs = _LogsInOrder([_unpacked(r[0]) for r in self._logs.get()]) if self._logs.exists() else None
            for (data,) in self._events.get():
                yield self._met(_unpacked(data), logs)
        self._events.clear()
        self._logs.clear()

    def close(self) -> None:
        pass
