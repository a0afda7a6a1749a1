"""Line dedup: hashes of lines in one global order, first occurrences kept while streaming.

Lines are range-partitioned by (hash, document descending, position), so a very common line spreads over several
partitions. Each partition is read once, in order, an Arrow batch at a time. A batch decides all its lines but those of
its first and last hash: these may go on elsewhere, and wait for a small total per hash. What comes back is a
compressed bitmap per document that loses a line, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import batch_of, blocks, ship, text_key, text_of
from signalyard.session import durable

MIN_CHARS, MIN_DOCS = 20, 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_EDGE = " \t\n\x0b\x0c\r"


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """h1, h2 (a 128-bit hash of the line's key), rank (falls as doc_id rises), doc_id, text_key, pos of every long line."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        F.posexplode(F.split(text_of(), "\n", -1)).alias("pos", "line"),
    )
    key = F.translate(F.btrim("line", F.lit(_EDGE)), _UPPER, _LOWER)
    return rows.withColumn("key", key).filter(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
        # Descending order by document; a null id comes last.
        F.coalesce(-F.col("doc_id") - 1, F.lit(2**63 - 1)).alias("rank"), "doc_id", "text_key", "pos",
    )


# kind: 0 a line to drop, 1 a line that waits for its hash's total, 2 what a batch knows of such a hash.
_DECIDED = pa.schema(
    [
        ("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("rank", pa.int64()), ("doc_id", pa.int64()),
        ("text_key", pa.int64()), ("pos", pa.int32()), ("batch", pa.int64()), ("ranks", pa.list_(pa.int64())),
    ]
)
_DECIDED_DDL = "kind int, h1 long, h2 long, rank long, doc_id long, text_key long, pos int, batch long, ranks array<bigint>"
_LINE = ["h1", "h2", "rank", "doc_id", "text_key", "pos"]


def decide(batch: pa.RecordBatch, number: int, min_docs: int) -> Iterator[pa.RecordBatch]:
    """The lines of a sorted batch, which has a ``number`` of its own: dropped, waiting, or (not returned) kept."""
    h1, h2, rank = (batch.column(c).to_numpy() for c in ("h1", "h2", "rank"))
    new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    begins = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    new_doc = new | np.concatenate([[True], rank[1:] != rank[:-1]])
    n_docs = np.add.reduceat(new_doc.astype(np.int64), begins)
    edge = (run == 0) | (run == run[-1])
    drop = ~edge & (n_docs[run] >= min_docs) & (rank != rank[begins][run])
    for kind, chosen in ((0, drop), (1, edge)):
        lines = batch.filter(pa.array(chosen))
        n = lines.num_rows
        own = {c: lines.column(c) for c in _LINE}
        yield batch_of(_DECIDED, kind=[kind] * n, batch=[number] * n, ranks=[None] * n, **own)
    shares = []
    for k in {0, int(run[-1])}:
        own = rank[(run == k) & new_doc][:min_docs]  # the first documents are enough to tell
        shares.append((int(h1[begins[k]]), int(h2[begins[k]]), own.tolist()))
    none = [None] * len(shares)
    yield batch_of(
        _DECIDED, kind=[2] * len(shares), h1=[s[0] for s in shares], h2=[s[1] for s in shares], rank=none, doc_id=none,
        text_key=none, pos=none, batch=[number] * len(shares), ranks=[s[2] for s in shares],
    )


_BITMAP = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_dropped", pa.int64()), ("keep", pa.binary())])


def pack_keep(dropped: list[int]) -> bytes:
    """A compressed bitmap of a document's lines up to the byte of the last one that goes: 1 stays."""
    bits = np.ones(max(dropped) // 8 * 8 + 8, bool)
    bits[dropped] = False
    return zlib.compress(np.packbits(bits).tobytes())


def keep_flags(keep: bytes | None, n_lines: int) -> np.ndarray:
    flags = np.ones(n_lines, bool)
    if keep is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n_lines]
        flags[: len(bits)] = bits.astype(bool)
    return flags


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text_key, n_dropped and the compressed keep bitmap of every document that loses lines.

    A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code points
    in at least ``min_docs`` documents lose their lines but in the largest doc_id that holds them. Rows that share a
    doc_id are one document; null ids together are one, smaller than all others. A document's bitmap is only as
    long as its own lines.
    """
    ship(docs.sparkSession)
    ordered = (
        line_hashes(docs, min_chars)
        .repartitionByRange("h1", "h2", "rank", "pos")
        .sortWithinPartitions("h1", "h2", "rank", "pos")
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches, first):
            if batch.num_rows:
                yield from decide(batch, number, min_docs)

    # Written once: the sampled ranges must be the same for lines and totals.
    decided = durable(ordered.mapInArrow(stream, _DECIDED_DDL))
    shares = decided.filter("kind = 2")
    ranks = shares.select("h1", "h2", F.explode("ranks").alias("rank")).distinct()
    totals = ranks.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("rank").alias("first"))
    # A total goes to each batch that waits for it, so that no join key has more lines than a batch.
    answers = shares.select("h1", "h2", "batch").join(totals.filter(F.col("n") >= min_docs), ["h1", "h2"])
    late = (
        decided.filter("kind = 1")
        .join(answers.drop("n"), ["batch", "h1", "h2"])
        .filter(F.col("rank") != F.col("first"))
    )
    lost = decided.filter("kind = 0").unionByName(late.select(*decided.columns))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dropped = batch.column("dropped").to_pylist()
            yield batch_of(
                _BITMAP, doc_id=batch.column("doc_id"), text_key=batch.column("text_key"),
                n_dropped=[len(d) for d in dropped], keep=[pack_keep(d) for d in dropped],
            )

    per_doc = lost.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("dropped"))
    return per_doc.mapInArrow(pack, "doc_id long, text_key long, n_dropped long, keep binary")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of ``docs`` with its text cut to the lines that stay, joined by newlines; n_lines and n_dropped added.

    n_lines counts before dropping; a null or empty text is one empty line and comes back as an empty text. Other columns
    stay as they are (one called n_lines or n_dropped, in any case, is replaced); the columns' order stays.
    """
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key"), "keep"
    )
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    on = F.col("row.doc_id").cast("long").eqNullSafe(F.col("_doc_id")) & (text_key("row.text") == F.col("_text_key"))
    joined = packed.join(bitmaps.hint("shuffle_hash"), on, "left").select("row", text_of("row.text").alias("text"), "keep")
    ddl = f"row {joined.schema['row'].dataType.simpleString()}, text string, n_lines long, n_dropped long"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts, lines, lost = [], [], []
            for text, keep in zip(block.column("text").to_pylist(), block.column("keep").to_pylist(), strict=True):
                split = text.split("\n")
                if keep is not None:
                    flags = keep_flags(keep, len(split))
                    text = "\n".join(line for line, stays in zip(split, flags.tolist(), strict=True) if stays)
                texts.append(text)
                lines.append(len(split))
                lost.append(0 if keep is None else len(split) - int(flags.sum()))
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(lost, pa.int64())],
                names=["row", "text", "n_lines", "n_dropped"],
            )

    done = joined.mapInArrow(apply, ddl)
    added = ["n_lines", "n_dropped"]
    kept = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added]
    return done.select(*kept, *added)
