"""Benchmark decontamination: an FM-index per shard of documents, searched for all benchmark windows at once.

A shard is a run of documents as one sequence of words. Words that no benchmark item has are terminators: each
is a symbol of its own that nothing searches for. Backward search over wavelet-matrix ranks finds the suffixes
that begin with a window, sampled suffix positions locate them, and their places merge into removal spans.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import Rolling, Words, blocks, ship, utf8

# Words of a window, and text of benchmark items that one pass over the documents takes (more items, more passes).
WINDOW = 13
PASS_BYTES = 32 << 20
# Words of a shard (a longer document is a shard of its own), and distance of sampled suffix positions.
SHARD_WORDS = 1 << 20
SAMPLED = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# The complement of [\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def hashed_words(data: np.ndarray, starts: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of a block and a hash of each."""
    lower = _LOWER[data]
    words = Words(lower, starts, _LETTER[lower])
    return words, Rolling.of_bytes(lower).runs(words.begin, words.end)


@dataclass(frozen=True)
class Queries:
    """Distinct windows as rows of symbols (1 for the first known word; 0 pads on the left), and who has them."""

    known: np.ndarray  # sorted word hashes
    windows: np.ndarray
    lengths: np.ndarray
    item_starts: np.ndarray
    items: np.ndarray

    @staticmethod
    def of(items: list[tuple[int, str]], size: int = WINDOW) -> Queries:
        column = pa.array([t for _, t in items], pa.string())
        words, hashes = hashed_words(*utf8(column))
        known, symbol = np.unique(hashes, return_inverse=True)
        symbol = symbol + 1
        rows, owners = [], []
        for k, (item, _) in enumerate(items):
            own = symbol[words.starts[k] : words.starts[k + 1]]
            if not len(own):
                continue
            if len(own) < size:
                own = np.concatenate([np.zeros(size - len(own), np.int64), own])
            found = np.lib.stride_tricks.sliding_window_view(own, size)
            rows.append(found)
            owners += [item] * len(found)
        if not rows:
            empty = np.zeros(0, np.int64)
            return Queries(known, np.zeros((0, size), np.int64), empty, np.zeros(1, np.int64), empty)
        windows, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.array(owners, np.int64)], 1), axis=0)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1))
        return Queries(known, windows, (windows > 0).sum(1), starts, pairs[:, 1])

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word; 0 for a word that no item has."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int32)
        seen = np.zeros(1 << 18, bool)
        seen[self.known >> np.uint64(46)] = True
        maybe = np.flatnonzero(seen[hashes >> np.uint64(46)])
        place = np.minimum(np.searchsorted(self.known, hashes[maybe]), len(self.known) - 1)
        out = np.zeros(len(hashes), np.int32)
        out[maybe] = np.where(self.known[place] == hashes[maybe], place + 1, 0)
        return out


class Bits:
    """A bit sequence with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.packbits(bits, bitorder="little").tobytes()
        padded += bytes(-len(padded) % 8 + 8)
        self._words = np.frombuffer(padded, "<u8")
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(self._words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self._words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    def __init__(self, values: np.ndarray, alphabet: int):
        self._levels: list[tuple[int, Bits, int]] = []
        for level in reversed(range(max(1, int(alphabet).bit_length()))):
            one = (values >> level) & 1 == 1
            bits = Bits(one)
            self._levels.append((level, bits, len(values) - int(one.sum())))
            values = np.concatenate([values[~one], values[one]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        begin = np.zeros(len(at), np.int64)
        for level, bits, zeros in self._levels:
            one = (symbol >> level) & 1 == 1
            r0, r1 = bits.rank(begin), bits.rank(at)
            begin = np.where(one, zeros + r0, begin - r0)
            at = np.where(one, zeros + r1, at - r1)
        return at - begin

    def get(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for level, bits, zeros in self._levels:
            one, r = bits.get(at), bits.rank(at)
            at = np.where(one, zeros + r, at - r)
            out |= one.astype(np.int64) << level
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order of symbols in which every 0 differs from all others (zeros sort by position, before all else).

    Prefix doubling; from the first round on only suffixes that still tie are sorted again.
    """
    n = len(text)
    zero = np.flatnonzero(text == 0)
    letters = np.flatnonzero(text)
    rank = np.empty(n + 4, np.int64)
    rank[n:] = -1
    rank[zero] = np.arange(len(zero))
    order = letters[np.argsort(text[letters], kind="stable")]
    out = np.concatenate([zero, order])
    head = np.concatenate([[True], text[order][1:] != text[order][:-1]]) if len(order) else np.zeros(0, bool)
    place = len(zero) + np.flatnonzero(head)
    rank[order] = np.repeat(place, np.diff(np.append(place, n)))
    open_at = np.arange(len(zero), n)  # rows whose order is not settled
    step = 1
    while len(open_at):
        suffix = out[open_at]
        group = rank[suffix]
        key = group * np.int64(n + 1) + (rank[np.minimum(suffix + step, n)] + 1)
        new = np.argsort(key, kind="stable")
        key, suffix = key[new], suffix[new]
        out[open_at] = suffix
        head = np.concatenate([[True], key[1:] != key[:-1]])
        begins = np.flatnonzero(head)
        sizes = np.diff(np.append(begins, len(key)))
        rank[suffix] = np.repeat(open_at[begins], sizes)
        open_at = open_at[np.repeat(sizes > 1, sizes)]
        step *= 2
    return out


class FmIndex:
    """Count and locate windows of symbols in a text whose zeros are terminators."""

    def __init__(self, text: np.ndarray, alphabet: int):
        rows = suffix_array(text)
        before = np.concatenate([text[-1:], text[:-1]])  # the symbol before each position
        self._tree = WaveletMatrix(before[rows], alphabet)
        counts = np.bincount(text, minlength=alphabet + 2)
        self._smaller = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self._ends = self._smaller + counts
        # A walk back never crosses a terminator: positions after one are sampled as well.
        kept = (rows % SAMPLED == 0) | (before[rows] == 0)
        self._sampled, self._positions = Bits(kept), rows[kept]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows ``[begin, end)`` of each window; zeros on the left of a window are padding."""
        begin = np.zeros(len(windows), np.int64)
        end = np.zeros(len(windows), np.int64)
        last = windows[:, -1]
        begin[:], end[:] = self._smaller[last], self._ends[last]
        live = np.flatnonzero(end > begin)
        for column in range(windows.shape[1] - 2, -1, -1):
            live = live[(windows[live, column] > 0) & (end[live] > begin[live])]
            if not len(live):
                break
            symbol = windows[live, column]
            base = self._smaller[symbol]
            begin[live], end[live] = (
                base + self._tree.rank(symbol, begin[live]),
                base + self._tree.rank(symbol, end[live]),
            )
        return begin, np.maximum(begin, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row."""
        out = np.zeros(len(rows), np.int64)
        steps = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        rows = rows.copy()
        while len(live):
            here = self._sampled.get(rows[live])
            done = live[here]
            out[done] = self._positions[self._sampled.rank(rows[done])] + steps[done]
            live = live[~here]
            symbol = self._tree.get(rows[live])
            rows[live] = self._smaller[symbol] + self._tree.rank(symbol, rows[live])
            steps[live] += 1
        return out


_MATCHES = pa.schema(
    [
        ("row", pa.int64()), ("item_ids", pa.list_(pa.int64())), ("begins", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())), ("n_words", pa.int64()), ("n_hit", pa.int64()),
    ]
)
_COUNT_DDL = "item_ids array<bigint>, begins array<bigint>, ends array<bigint>, n_words bigint, n_hit bigint"


def _lists(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values.astype(np.int64)))


def scan_shard(text: np.ndarray, starts: np.ndarray, queries: Queries) -> dict[str, pa.Array]:
    """Matches per document of a shard. ``starts``: where each document begins; each ends with a terminator."""
    n_docs = len(starts) - 1
    n_words = np.diff(starts) - 1
    index = FmIndex(text, len(queries.known))
    begin, end = index.search(queries.windows)
    counts = end - begin
    window = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    at = index.locate(rows)

    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + queries.lengths[window], -1)
    hit = np.cumsum(edge[:-1]) > 0
    padded = np.concatenate([[False], hit, [False]])
    opens = np.flatnonzero(padded[1:-1] & ~padded[:-2])
    closes = np.flatnonzero(padded[1:-1] & ~padded[2:]) + 1
    doc = np.searchsorted(starts, opens, "right") - 1  # no window crosses a terminator

    n_items = np.diff(queries.item_starts)[window]
    owner = np.repeat(np.searchsorted(starts, at, "right") - 1, n_items)
    place = np.repeat(queries.item_starts[window] - (np.cumsum(n_items) - n_items), n_items) + np.arange(n_items.sum())
    pairs = np.stack([owner, queries.items[place]], 1)
    if len(pairs):
        pairs = np.unique(pairs, axis=0)
    upto = np.arange(n_docs + 1)
    spans = np.searchsorted(doc, upto)
    total = np.concatenate([[0], np.cumsum(hit)])
    return {
        "item_ids": _lists(np.searchsorted(pairs[:, 0], upto), pairs[:, 1]),
        "begins": _lists(spans, opens - starts[doc]),
        "ends": _lists(spans, closes - starts[doc]),
        "n_words": pa.array(n_words),
        "n_hit": pa.array(total[starts[1:]] - total[starts[:-1]]),
    }


def _scan(docs: DataFrame, queries: Queries, text: str) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with its matches."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            kept = pa.concat_arrays([r for r, _, _ in held])
            symbols = np.concatenate([s for _, s, _ in held])
            sizes = np.concatenate([n for _, _, n in held])
            held.clear()
            columns = scan_shard(symbols, np.concatenate([[0], np.cumsum(sizes)]), asked)
            fields = [pa.field("row", kept.type), *[_MATCHES.field(n) for n in _MATCHES.names[1:]]]
            return pa.RecordBatch.from_arrays([kept, *[columns[f.name] for f in fields[1:]]], schema=pa.schema(fields))

        size = 0
        for block in blocks(batches):
            words, hashes = hashed_words(*utf8(block.column("text")))
            symbols = np.zeros(len(hashes) + block.num_rows, np.int32)
            symbols[np.arange(len(hashes)) + words.row] = asked.symbols(hashes)
            held.append((block.column("row"), symbols, np.diff(words.starts) + 1))
            size += len(symbols)
            if size >= SHARD_WORDS:
                yield flush()
                size = 0
        if held:
            yield flush()

    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, {_COUNT_DDL}")


def _merged(begins: Column, ends: Column) -> Column:
    """Spans of one document from several passes, merged: an array of (b, e)."""
    spans = F.array_sort(F.arrays_zip(begins.alias("b"), ends.alias("e")))
    none = F.array().cast("array<struct<b: bigint, e: bigint>>")

    def join(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["b"].alias("b"), F.greatest(last["e"], span["e"]).alias("e"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["e"] >= span["b"])
        return F.when(
            touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))
        ).otherwise(F.concat(done, F.array(F.struct(span["b"].alias("b"), span["e"].alias("e")))))

    return F.aggregate(spans, none, join)


def match_benchmark(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """Every row of ``docs`` with item_ids, begins, ends, n_words, n_hit and contaminated added; no shuffle in one pass.

    ``begins``/``ends`` are the merged removal spans in words; n_hit counts the words inside; ``contaminated`` is
    n_hit > 0 and 20 * n_hit >= n_words. A word lies in no span that crosses documents. A null or empty text has no
    words and no matches; items without words and items without an id ask nothing; an item that repeats counts once;
    an empty ``items`` matches nothing. A column of ``docs`` with such a name, in any case, is replaced.

    Benchmark windows are read into one block per ``pass_bytes`` of item text (counted, not estimated), so what is
    sent to the tasks is bounded; with more blocks the documents are read once per block and spans are merged
    per row, which then needs a shuffle of the matches by doc_id and text hash. The index of a shard never
    holds more than ``SHARD_WORDS`` words or one document.
    """
    ship(docs.sparkSession)
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).dropna()
    sizes = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(sizes / pass_bytes))
    added = ["item_ids", "begins", "ends", "n_words", "n_hit", "contaminated"]
    found = None
    for k in range(passes):
        block = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        queries = Queries.of([(r["item_id"], r["text"]) for r in block.collect()], window)
        one = _scan(docs, queries, text)
        found = one if found is None else found.unionByName(one)
    if passes > 1:
        key = [F.col("row.doc_id"), F.xxhash64(F.to_json("row", {"ignoreNullFields": "false"}))]
        found = found.groupBy(*[c.alias(f"_k{i}") for i, c in enumerate(key)]).agg(
            F.collect_list("row").alias("rows"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
            _merged(F.flatten(F.collect_list("begins")), F.flatten(F.collect_list("ends"))).alias("spans"),
            F.first("n_words").alias("n_words"),
        )
        # Equal rows meet in one group, each once per pass.
        found = found.select(
            F.explode(F.slice("rows", 1, (F.size("rows") / passes).cast("int"))).alias("row"), "item_ids",
            F.col("spans.b").alias("begins"), F.col("spans.e").alias("ends"), "n_words",
            F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["e"] - s["b"]).alias("n_hit"),
        )
    judged = found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    return judged.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added], *added)
