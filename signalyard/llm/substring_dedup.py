"""Substring dedup by level-wise doubling: only windows repeated at one length are looked at at twice that length.

The wanted length is halved as often as it goes; the shortest windows come first. Below the wanted length a window of
that length stands for the wanted windows around it in which its hash is least, and only such anchors are compared: equal
windows have equal anchors, so nothing is lost, and about an eighth of the places are sent. Texts that are equal as a whole
are one text from the start. A block of text sends each hash once, packed with others of its bucket; the number of
buckets follows from the bytes of the table, so what a task holds does not grow with it, whatever repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import Rolling, Words, batch_of, blocks, mix, ship, text_of, utf8
from signalyard.session import durable

# Words of a window, and the least length that a window is halved to.
LENGTH, LEAST = 20, 5
# Text whose hashes one task sends together, and text per bucket of hashes.
SENT_BYTES, BUCKET_BYTES = 16 << 20, 32 << 20

_LAST_ID = 2**63 - 1


def levels(length: int) -> list[int]:
    """Rising window lengths, each twice the one before, up to ``length``."""
    found = [length]
    while found[0] % 2 == 0 and found[0] // 2 >= LEAST:
        found.insert(0, found[0] // 2)
    return found


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Windows:
    """Hashes of the windows of a block: where they begin, and the least hash of a shorter length inside each."""

    def __init__(self, column: pa.Array, length: int):
        data, starts = utf8(column)
        words = Words(data, starts)
        self._grams = Rolling(Rolling.of_bytes(data).runs(words.begin, words.end))
        self._length, self._words = length, words
        self.at = np.flatnonzero(words.windows(length))
        self.row = words.row[self.at]
        self.start = self.at - words.starts[self.row]

    def anchors(self, shorter: int) -> np.ndarray:
        """Per window the least hash of ``shorter`` words in it."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        return sliding_min(self._grams.grams(shorter), self._length - shorter + 1)[self.at]

    def anchor_places(self, shorter: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and row of each place whose hash is the least of some window; equal hashes are places of their own."""
        if not len(self.at):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        width = self._length - shorter + 1
        grams = self._grams.grams(shorter)
        least = np.zeros(len(grams) + width - 1, np.uint64)
        least[self.at + width - 1] = self.anchors(shorter)
        # A place is an anchor when no window over it has a least hash as large but its own.
        found = np.flatnonzero(grams == ~sliding_min(~least, width))
        return grams[found], self._words.row[found]

    def hashes(self) -> np.ndarray:
        return self._grams.grams(self._length)[self.at] if len(self.at) else np.zeros(0, np.uint64)


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(values) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """True where sorted rows begin a new value of the columns."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _parts(*sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    begins = np.flatnonzero(_heads(*sorted_keys)) if len(sorted_keys[0]) else np.zeros(0, np.int64)
    return list(zip(begins.tolist(), [*begins[1:].tolist(), len(sorted_keys[0])], strict=True)) if len(begins) else []


_KEY = np.dtype([("tk1", "<i8"), ("tk2", "<i8"), ("doc_id", "<i8")])


def _keys(batch: pa.RecordBatch, with_id: bool) -> np.ndarray:
    out = np.zeros(batch.num_rows, _KEY)
    for name in ("tk1", "tk2", *(["doc_id"] if with_id else [])):
        out[name] = batch.column(name).to_numpy()
    return out


# Hashes of one bucket from one block: ``docs`` has a key per text, ``counts`` how many of the values are its.
_SENT_DDL = "bucket int, known boolean, docs binary, counts binary, first binary, second binary, places binary"
_SENT = pa.schema(
    [
        ("bucket", pa.int32()), ("known", pa.bool_()), ("docs", pa.binary()), ("counts", pa.binary()),
        ("first", pa.binary()), ("second", pa.binary()), ("places", pa.binary()),
    ]
)


def _sent(rows: list[tuple[int, bool, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of (bucket, known, keys, text number of each value, first, second, places), sorted by text number."""
    out: dict[str, list] = {f.name: [] for f in _SENT}
    for bucket, known, keys, doc, first, second, places in rows:
        begins = np.flatnonzero(_heads(doc))
        out["bucket"].append(bucket)
        out["known"].append(known)
        out["docs"].append(keys[doc[begins]].tobytes())
        out["counts"].append(np.diff(np.append(begins, len(doc))).astype("<i4").tobytes())
        out["first"].append(first.astype("<u8").tobytes())
        out["second"].append(second.astype("<u8").tobytes())
        out["places"].append(places.astype("<i4").tobytes())
    return batch_of(_SENT, **out)


def _received(table: pa.Table, column: str, kind: str) -> np.ndarray:
    parts = [np.frombuffer(b, kind) for b in table.column(column).to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _owners(table: pa.Table) -> np.ndarray:
    """The key of each value of the rows."""
    return np.repeat(_received(table, "docs", _KEY), _received(table, "counts", "<i4"))


_FOUND = pa.schema([("tk1", pa.int64()), ("tk2", pa.int64()), ("part", pa.binary())])
_FOUND_DDL = "tk1 long, tk2 long, part binary"


def _found(keys: np.ndarray, values: np.ndarray) -> pa.Table:
    """One row per text with its values packed; rows come in any order."""
    order = np.lexsort((keys["tk2"], keys["tk1"]))
    keys, values = keys[order], values[order]
    parts = _parts(keys["tk1"], keys["tk2"])
    first = [a for a, _ in parts]
    batch = batch_of(
        _FOUND, tk1=keys["tk1"][first], tk2=keys["tk2"][first], part=[values[a:b].tobytes() for a, b in parts]
    )
    return pa.Table.from_batches([batch])


def send_anchors(batches: Iterator[pa.RecordBatch], length: int, shorter: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The anchors of each text, once; ``places`` tells whether a text holds it at two places."""
    keys: list[np.ndarray] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = n_docs = 0

    def flush() -> pa.RecordBatch:
        value, row = (np.concatenate(c) for c in zip(*held, strict=True))
        texts, same = np.unique(np.concatenate(keys), return_inverse=True)
        doc = same.ravel()[row]
        order = np.lexsort((row, doc, value))
        value, doc, row = value[order], doc[order], row[order]
        # Copies of one text bring the same anchors; only those of one row tell of two places.
        twice = np.zeros(len(value), bool)
        twice[1:] = (value[1:] == value[:-1]) & (row[1:] == row[:-1])
        begins = np.flatnonzero(_heads(value, doc))
        twice = np.maximum.reduceat(twice, begins) if len(begins) else twice[:0]
        value, doc = value[begins], doc[begins]
        bucket = _bucket(value, buckets)
        order = np.lexsort((doc, bucket))
        bucket, value, doc, twice = bucket[order], value[order], doc[order], twice[order]
        none = np.zeros(0, np.uint64)
        return _sent([(int(bucket[a]), False, texts, doc[a:b], value[a:b], none, twice[a:b]) for a, b in _parts(bucket)])

    for block in blocks(batches):
        found = Windows(block.column("text"), length)
        value, row = found.anchor_places(shorter)
        held.append((value, row + n_docs))
        keys.append(_keys(block, False))
        n_docs += block.num_rows
        size += block.column("text").nbytes
        if size >= SENT_BYTES:
            yield flush()
            keys.clear()
            held.clear()
            size = n_docs = 0
    if held:
        yield flush()


def repeated_anchors(table: pa.Table) -> pa.Table:
    """Of one bucket, the anchors that two different texts hold, or one text twice, for each text that holds them."""
    value, owner = _received(table, "first", "<u8"), _owners(table)
    twice = _received(table, "places", "<i4") > 0
    order = np.lexsort((owner["tk2"], owner["tk1"], value))
    value, owner, twice = value[order], owner[order], twice[order]
    begins = np.flatnonzero(_heads(value)) if len(value) else np.zeros(0, np.int64)
    once = _heads(value, owner["tk1"], owner["tk2"])
    if not len(begins):
        return _found(owner, value)
    again = (np.add.reduceat(once.astype(np.int64), begins) > 1) | np.logical_or.reduceat(twice, begins)
    keep = np.repeat(again, np.diff(np.append(begins, len(value)))) & once
    return _found(owner[keep], value[keep])


def send_windows(
    batches: Iterator[pa.RecordBatch], length: int, lower: list[int], buckets: int
) -> Iterator[pa.RecordBatch]:
    """Windows whose anchor repeats, with their next longer anchor and their own hash.

    A window that a smaller place of the same block holds is settled here (``known``); others are sent, once per block.
    """
    held: list[tuple[np.ndarray, ...]] = []
    keys: list[np.ndarray] = []
    size = n_docs = 0

    def flush() -> pa.RecordBatch:
        own, anchor, doc, start = (np.concatenate(c) for c in zip(*held, strict=True))
        texts = np.concatenate(keys)
        ids = texts["doc_id"][doc]
        order = np.lexsort((start, ids, own))
        own, anchor, doc, start, ids = own[order], anchor[order], doc[order], start[order], ids[order]
        begins = np.flatnonzero(_heads(own)) if len(own) else np.zeros(0, np.int64)
        first = np.repeat(begins, np.diff(np.append(begins, len(own))))
        later = (ids != ids[first]) | (start != start[first])
        rows = []
        gone = np.flatnonzero(later)
        if len(gone):
            gone = gone[np.argsort(doc[gone], kind="stable")]
            none = np.zeros(0, np.uint64)
            rows.append((int(_bucket(own[gone[:1]], buckets)[0]), True, texts, doc[gone], none, none, start[gone]))
        own, anchor, doc, start = own[~later], anchor[~later], doc[~later], start[~later]
        bucket = _bucket(anchor, buckets)
        order = np.lexsort((start, doc, bucket))
        own, anchor, doc, start, bucket = own[order], anchor[order], doc[order], start[order], bucket[order]
        rows += [(int(bucket[a]), False, texts, doc[a:b], anchor[a:b], own[a:b], start[a:b]) for a, b in _parts(bucket)]
        return _sent(rows)

    for block in blocks(batches):
        found = Windows(block.column("text"), length)
        parts = [np.frombuffer(b, "<u8") for got in block.column("found").to_pylist() for b in got or ()]
        again = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        keep = np.isin(found.anchors(lower[0]), again)
        held.append((found.hashes()[keep], found.anchors(lower[-1])[keep], found.row[keep] + n_docs, found.start[keep]))
        keys.append(_keys(block, True))
        n_docs += block.num_rows
        size += block.column("text").nbytes
        if size >= SENT_BYTES:
            yield flush()
            keys.clear()
            held.clear()
            size = n_docs = 0
    if held:
        yield flush()


def later_windows(table: pa.Table) -> pa.Table:
    """Of one bucket, per text the starts of windows that begin earlier elsewhere."""
    settled = table.filter(table.column("known"))
    table = table.filter(pa.compute.invert(table.column("known")))
    anchor, own = _received(table, "first", "<u8"), _received(table, "second", "<u8")
    start, owner = _received(table, "places", "<i4"), _owners(table)
    # The shorter length first: a window whose anchor is alone is not looked at any further.
    order = np.argsort(anchor, kind="stable")
    sorted_anchor = anchor[order]
    alone = _heads(sorted_anchor)
    alone[:-1] &= alone[1:]
    order = order[~alone]
    anchor, own, start, owner = anchor[order], own[order], start[order], owner[order]
    order = np.lexsort((start, owner["doc_id"], own, anchor))
    anchor, own, start, owner = anchor[order], own[order], start[order], owner[order]
    begins = np.flatnonzero(_heads(anchor, own)) if len(own) else np.zeros(0, np.int64)
    first = np.repeat(begins, np.diff(np.append(begins, len(own))))
    later = (owner["doc_id"] != owner["doc_id"][first]) | (start != start[first])
    keys = np.concatenate([owner[later], _owners(settled)])
    return _found(keys, np.concatenate([start[later], _received(settled, "places", "<i4")]))


def _text_key(column: str | Column) -> list[Column]:
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
    return [F.xxhash64(text).alias("tk1"), F.xxhash64(F.lit("second"), text).alias("tk2")]


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """tk1, tk2 (a text's key), first_id and starts of every text that loses words, as a table in the shared folder.

    ``first_id`` is the least doc_id with this text, ``parts`` the packed 32-bit starts of its windows of ``length`` words
    that begin earlier elsewhere. Rows of the text with a larger doc_id lose all their windows.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    lower = levels(length)[:-1] or [length]
    texts = docs.select(
        *_text_key("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("doc_id"), text_of().alias("text")
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return send_anchors(batches, length, lower[0], buckets)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return send_windows(batches, length, lower, buckets)

    anchors = texts.drop("doc_id").mapInArrow(first_pass, _SENT_DDL).groupBy("bucket").applyInArrow(repeated_anchors, _FOUND_DDL)
    found = anchors.groupBy("tk1", "tk2").agg(F.collect_list("part").alias("found"))
    copies = texts.groupBy("tk1", "tk2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    known = durable(copies.join(found, ["tk1", "tk2"], "left"))
    # A key with the doc_id in it: copies of one text do not meet in one task.
    asked = known.filter("found IS NOT NULL").select("tk1", "tk2", F.col("first_id").alias("doc_id"), "found")
    windows = (
        texts.join(asked, ["tk1", "tk2", "doc_id"])
        .select("tk1", "tk2", "doc_id", "text", "found")
        .mapInArrow(second_pass, _SENT_DDL)
        .groupBy("bucket")
        .applyInArrow(later_windows, _FOUND_DDL)
    )
    parts = windows.groupBy("tk1", "tk2").agg(F.collect_list("part").alias("parts"))
    lost = known.drop("found").join(parts, ["tk1", "tk2"], "left").filter("parts IS NOT NULL OR last_id > first_id")
    return durable(lost.drop("last_id"))


def _kept_texts(data: np.ndarray, words: Words, keep: np.ndarray, n_rows: int) -> list[bytes]:
    """For each row its kept words joined by one space."""
    begin, size = words.begin[keep], (words.end - words.begin)[keep] + 1
    upto = np.cumsum(size)
    place = np.repeat(begin - (upto - size), size) + np.arange(int(upto[-1]) if len(upto) else 0)
    out = np.append(data, np.uint8(0))[place]
    out[upto - 1] = 0x20
    raw = out.tobytes()
    ends = np.concatenate([[0], upto])[np.searchsorted(words.row[keep], np.arange(n_rows + 1))]
    return [raw[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every row of ``docs`` with its text cut to the words that stay, joined by one space; n_words and n_removed added.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window of ``length`` words over it also begins earlier: in a document
    with a smaller doc_id, or earlier in the same one. Windows are judged on the input. A null or empty text has no words
    and comes back empty; documents shorter than a window lose nothing, whatever repeats. Null ids are one document after all
    others; rows that share a doc_id are one document by their places, so equal rows keep the same words. Other columns
    stay as they are, also those called n_words or n_removed in any case, which come back as ``<name>_in``; the
    columns' order stays.
    """
    lost = repeated_windows(docs, length)
    names = [f"{c}_in" if c.lower() in ("n_words", "n_removed") else c for c in docs.columns]
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    packed = packed.select("row", *_text_key(F.col("row.text")), F.col("row.doc_id").cast("long").alias("doc_id"))
    joined = packed.join(lost.hint("shuffle_merge"), ["tk1", "tk2"], "left").select(
        "row", text_of("row.text").alias("text"), (F.coalesce("doc_id", F.lit(_LAST_ID)) > F.col("first_id")).alias("copy"), "parts"
    )
    ddl = f"row {joined.schema['row'].dataType.simpleString()}, text string, n_words long, n_removed long"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, starts = utf8(block.column("text"))
            words = Words(data, starts)
            n_words = np.diff(words.starts)
            edge = np.zeros(len(words) + 1, np.int64)
            copy = block.column("copy").fill_null(False).to_numpy(zero_copy_only=False)
            for row, parts in enumerate(block.column("parts").to_pylist()):
                if copy[row]:
                    if n_words[row] >= length:
                        edge[words.starts[row]] += 1
                        edge[words.starts[row + 1]] -= 1
                elif parts:
                    at = np.concatenate([np.frombuffer(p, "<i4") for p in parts]) + words.starts[row]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + length, -1)
            keep = np.cumsum(edge[:-1]) == 0
            total = np.concatenate([[0], np.cumsum(~keep)])
            kept = pa.array(_kept_texts(data, words, keep, block.num_rows), pa.binary()).cast(pa.string())
            lost_words = total[words.starts[1:]] - total[words.starts[:-1]]
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), kept, pa.array(n_words), pa.array(lost_words)],
                names=["row", "text", "n_words", "n_removed"],
            )

    done = joined.mapInArrow(apply, ddl)
    kept = [
        F.col("text") if c == "text" else F.col("row")[c].alias(name) for c, name in zip(docs.columns, names, strict=True)
    ]
    return done.select(*kept, "n_words", "n_removed")
