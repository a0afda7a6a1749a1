"""Token ids in files, compressed by Re-Pair, in ascending document order.

A shard is a run of whole documents. Its frequent pairs of neighbouring symbols become nonterminals, round by
round; no pair spans two documents. A shard stores its rules, the length that each nonterminal expands to, and where
each document's symbols begin, so any document can be decoded alone.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalyard.llm.common import batch_of, blocks, ship
from signalyard.llm.tokenizers_io import word_ids
from signalyard.session import durable, shared_dir

# Ids of a shard (a longer document is a shard of its own).
SHARD_IDS = 1 << 20
# Rules of a shard, rounds of replacement, occurrences that make a pair frequent, and the share of the
# symbols that a round must save to be followed by another.
MAX_RULES, MAX_ROUNDS, MIN_COUNT, MIN_SAVED = 16_000, 8, 16, 0.01
_MAGIC = b"RPTK"
_SLOTS = 17  # bits of the table that finds a pair's rule


def compress(ids: np.ndarray, lengths: np.ndarray, base: int, max_rules: int = MAX_RULES):
    """Symbols of a shard, symbols per document, and rules: rule ``k`` is the pair that symbol ``base + k`` stands for.

    In a round all frequent pairs are replaced together, the most frequent one where two claim the same table slot
    (the other waits for a later round). Where occurrences overlap, every other one counts, from the left.
    """
    narrow = base + max_rules <= 1 << 16
    symbol_type, bits = (np.uint16, np.uint32(16)) if narrow else (np.uint32, np.uint64(32))
    key_type = np.uint32 if narrow else np.uint64
    factor = key_type(0x9E3779B1) if narrow else key_type(0x9E3779B97F4A7C15)
    shift = key_type(32 - _SLOTS if narrow else 64 - _SLOTS)
    symbols = ids.astype(symbol_type)
    last = np.zeros(len(symbols), bool)  # of a document
    ends = np.cumsum(lengths)
    last[ends[lengths > 0] - 1] = True
    rules: list[np.ndarray] = []
    made = 0
    for _ in range(MAX_ROUNDS):
        if len(symbols) < 2 or made >= max_rules:
            break
        key = (symbols[:-1].astype(key_type) << bits) | symbols[1:]
        ordered = np.sort(key[~last[:-1]])
        if not len(ordered):
            break
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(begins, len(ordered)))
        often = counts >= MIN_COUNT
        pairs, counts = ordered[begins[often]], counts[often]
        # Half of the rules that are left go to this round, so that later rounds can join what it made.
        top = np.argsort(-counts, kind="stable")[: max(1, (max_rules - made + 1) // 2)]
        pairs = pairs[top]
        if not len(pairs):
            break
        with np.errstate(over="ignore"):
            slot = (pairs * factor) >> shift
        _, first = np.unique(slot, return_index=True)
        pairs, slot = pairs[np.sort(first)], slot[np.sort(first)]
        table = np.full(1 << _SLOTS, -1, np.int32)
        table[slot] = np.arange(len(pairs), dtype=np.int32)
        with np.errstate(over="ignore"):
            rule = table[(key * factor) >> shift]
        hit = (rule >= 0) & ~last[:-1]
        hit &= pairs[np.maximum(rule, 0)] == key
        at = np.flatnonzero(hit)
        if not len(at):
            break
        opens = np.concatenate([[True], np.diff(at) != 1])
        run = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        symbols[at] = (base + made + rule[at]).astype(symbol_type)
        last[at] |= last[at + 1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        before = len(symbols)
        symbols, last = symbols[stay], last[stay]
        rules.append(pairs)
        made += len(pairs)
        if len(at) < MIN_SAVED * before:
            break
    stored = np.concatenate(rules) if rules else np.zeros(0, key_type)
    mask = key_type((1 << int(bits)) - 1)
    pair_rules = np.stack([stored >> bits, stored & mask], 1).astype(np.uint32)
    per_doc = np.zeros(len(lengths), np.int64)
    filled = np.flatnonzero(lengths > 0)
    per_doc[filled] = np.diff(np.concatenate([[0], np.flatnonzero(last) + 1]))
    return symbols, per_doc, pair_rules


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each nonterminal stands for. A rule only names nonterminals made before it."""
    out = np.zeros(len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        out[k] = (out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1)
    return out


class Grammar:
    """Rules ready for decoding: the ids of every nonterminal, one after another."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, base: int):
        self.base, self.lengths = base, lengths
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.ids = np.zeros(self.starts[-1], np.uint32)
        at = self.starts.tolist()
        for k, pair in enumerate(rules.tolist()):
            place = at[k]
            for symbol in pair:
                if symbol < base:
                    self.ids[place] = symbol
                    place += 1
                else:
                    begin, end = at[symbol - base], at[symbol - base + 1]
                    self.ids[place : place + end - begin] = self.ids[begin:end]
                    place += end - begin

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.int64)
        rule = symbols - self.base
        made = rule >= 0
        sizes = np.ones(len(symbols), np.int64)
        sizes[made] = self.lengths[rule[made]]
        out = np.repeat(symbols.astype(np.uint32), sizes)
        # Places of what nonterminals expand to, and where their ids are kept.
        begins = np.cumsum(sizes) - sizes
        wide, kept = sizes[made], self.starts[rule[made]]
        inside = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        out[np.repeat(begins[made], wide) + inside] = self.ids[np.repeat(kept, wide) + inside]
        return out


def shard_bytes(doc_ids: list[int | None], packed: list[bytes], base: int) -> bytes:
    """A shard in file form: header, then its arrays in the order of the header's ``parts``."""
    lengths = np.array([len(p) // 4 for p in packed], np.int64)
    ids = np.frombuffer(b"".join(packed), "<u4")
    symbols, per_doc, rules = compress(ids, lengths, base)
    grown = expansion_lengths(rules, base)
    null = np.array([d is None for d in doc_ids], bool)
    parts = {
        "doc_id": np.array([0 if d is None else d for d in doc_ids], "<i8"), "null_id": null.astype("<u1"),
        "n_ids": lengths.astype("<i8"), "n_symbols": per_doc.astype("<i8"), "rules": rules.astype("<u4").ravel(),
        "expansion": grown.astype("<i8"), "symbols": symbols.astype(f"<u{symbols.itemsize}"),
    }
    stored = {k: v.tobytes() for k, v in parts.items()}
    body = b"".join(stored.values())
    header = json.dumps(
        {"base": base, "crc32": zlib.crc32(body), "parts": {k: [v.dtype.str, len(stored[k])] for k, v in parts.items()}}
    ).encode()
    return _MAGIC + struct.pack("<II", len(header), len(body)) + header + body


class Shard:
    """A stored shard: decode any of its documents by position."""

    def __init__(self, header: dict, body: bytes):
        if zlib.crc32(body) != header["crc32"]:
            raise ValueError("a shard's checksum does not fit its content")
        at = 0
        part = {}
        for name, (kind, size) in header["parts"].items():
            part[name] = np.frombuffer(body, kind, size // np.dtype(kind).itemsize, at)
            at += size
        self.doc_ids = [None if n else d for d, n in zip(part["doc_id"].tolist(), part["null_id"].tolist(), strict=True)]
        self.n_ids = part["n_ids"]
        self._first = np.concatenate([[0], np.cumsum(part["n_symbols"])])
        self._symbols = part["symbols"]
        self._grammar = Grammar(part["rules"].reshape(-1, 2), part["expansion"], header["base"])

    def document(self, k: int) -> np.ndarray:
        return self._grammar.expand(self._symbols[self._first[k] : self._first[k + 1]])

    def documents(self) -> list[bytes]:
        data = self._grammar.expand(self._symbols).astype("<u4").tobytes()
        upto = (4 * np.concatenate([[0], np.cumsum(self.n_ids)])).tolist()
        return [data[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]


def read_shards(path: str) -> Iterator[Shard]:
    """The shards of a file, one at a time."""
    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_stream(place, compression=None) as file:
        while head := file.read(12):
            if head[:4] != _MAGIC:
                raise ValueError(f"{path} is no token file")
            n_header, n_body = struct.unpack("<II", head[4:])
            header = json.loads(file.read(n_header))
            yield Shard(header, file.read(n_body))


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


_WRITTEN = pa.schema(
    [("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]
)


def write_tokens(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int = 2, base: int | None = None, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Write the ids of every document to ``folder``; returns the manifest: part, path, n_docs, n_ids, n_bytes, start.

    Rows are range-sorted by doc_id (null first); rows that share an id are ordered by a hash of their text.
    Each part is written under a temporary name and then renamed, so a repeated task replaces its own file. A
    null or empty text is ``end_id`` alone. ``base`` is the first symbol that is no id (by default, of the vocabulary). ``start`` counts the ids in
    all parts before: a running sum over one row per part. The manifest is a written table.
    """
    ship(docs.sparkSession)
    target = as_uri(folder).rstrip("/")
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = word_ids(vocabulary)
        encode, first = library.encode, base or max(library.size, end_id + 1)
        part = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(target)
        path, hidden = f"{root}/part-{part:06d}.rptk", f"{root}/_part-{part:06d}.{uuid.uuid4().hex}"
        store.create_dir(root)
        total = {"n_docs": 0, "n_ids": 0, "n_bytes": 0}
        with store.open_output_stream(hidden, compression=None) as file:
            held: tuple[list, list] = ([], [])
            size = 0

            def flush() -> None:
                data = shard_bytes(*held, first)
                file.write(data)
                total["n_docs"] += len(held[0])
                total["n_ids"] += sum(map(len, held[1])) // 4
                total["n_bytes"] += len(data)
                held[0].clear()
                held[1].clear()

            for block in blocks(batches):
                ids = encode(block.column("text"))
                for doc_id, own in zip(block.column("doc_id").to_pylist(), ids, strict=True):
                    if held[0] and size + len(own) // 4 >= shard_ids:
                        flush()
                        size = 0
                    held[0].append(doc_id)
                    held[1].append(own + end)
                    size += len(own) // 4 + 1
            if held[0]:
                flush()
        store.move(hidden, path)
        yield batch_of(_WRITTEN, part=[part], path=[f"{target}/part-{part:06d}.rptk"], **{k: [v] for k, v in total.items()})

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    ddl = "part long, path string, n_docs long, n_ids long, n_bytes long"
    written = durable(ordered.mapInArrow(run, ddl).filter("n_docs > 0"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document in the files of a manifest."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                for shard in read_shards(path):
                    upto = start + np.cumsum(shard.n_ids)
                    yield batch_of(
                        _READ, doc_id=shard.doc_ids, start=upto - shard.n_ids, n_tokens=shard.n_ids, ids=shard.documents()
                    )
                    start = int(upto[-1])

    files = manifest.select("path", F.col("start").cast("long").alias("start"))
    # About one file per task: a hash of few paths would leave some tasks with several.
    spread = files.repartitionByRange(max(1, min(manifest.count(), 10_000)), "start")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_folder(spark) -> str:
    return f"{shared_dir(spark)}/tokens/{uuid.uuid4().hex}"
