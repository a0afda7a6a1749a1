"""Near-duplicate classes: ProbMinHash signatures, banding, exact verification, connected components.

Shingles are five consecutive words (lower-cased A-Z, split at white space), each of weight 1 however often a text has it, as
in the similarity that decides. Each shingle is a Poisson process whose arrivals fall on the components of a signature; a
component keeps its first arrival, and a shingle stops as soon as its next arrival is later than all of its text's
components. Two signatures agree in a component with the Jaccard similarity of the sets.

Rows with equal shingle sets are one node. Nodes that share a band are candidates; links are decided by
the Jaccard similarity of the whole shingle sets. In a bucket every node is checked against one leader, which is linear.
Nodes that this leaves in different components of one bucket are then compared whole in blocks, of which only links come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import Rolling, Words, batch_of, blocks, mix, ship, text_key, utf8
from signalyard.session import durable

SHINGLE = 5
THRESHOLD = 0.8
# 24 bands of 4: a pair of similarity 0.8 shares no band with probability 3e-6.
BANDS, ROWS = 24, 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(data: np.ndarray, starts: np.ndarray, size: int = SHINGLE):
    """Distinct shingles of a block: row, hash, count, and a key in which equal hashes of different rows differ.

    Keys ascend. A row of fewer words than ``size``, but not none, has all its words as its one shingle.
    """
    lower = _LOWER[data]
    words = Words(lower, starts)
    by_word = Rolling(Rolling.of_bytes(lower).runs(words.begin, words.end))
    first = np.flatnonzero(words.windows(size))
    row, value = words.row[first], by_word.grams(size)[first]
    short = np.flatnonzero((np.diff(words.starts) > 0) & (np.diff(words.starts) < size))
    if len(short):
        whole = by_word.runs(words.starts[short], words.starts[short + 1])
        row, value = np.concatenate([row, short]), np.concatenate([value, whole])
    salted = mix(value ^ mix(row.astype(np.uint64) + np.uint64(1)))
    key, at, count = np.unique(salted, return_index=True, return_counts=True)
    return row[at], value[at], count, key


def signatures(row: np.ndarray, value: np.ndarray, weight: np.ndarray, n_rows: int, size: int) -> np.ndarray:
    """ProbMinHash signatures, one row of ``size`` shingle hashes per text (zeros for a text without shingles)."""
    time = np.full(n_rows * size, np.inf)
    winner = np.zeros(n_rows * size, np.uint64)
    # A text of one shingle: it wins everywhere.
    alone = np.bincount(row, minlength=n_rows)[row] == 1
    winner.reshape(n_rows, size)[row[alone]] = value[alone, None]
    live = np.flatnonzero(~alone)
    arrival = np.zeros(len(row))
    step = np.uint64(0)
    with np.errstate(over="ignore"):
        while len(live):
            drawn = mix(value[live] + step * np.uint64(0x9E3779B97F4A7C15))
            step += np.uint64(1)
            uniform = (drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53
            component = ((drawn & np.uint64(0x7FF)) * np.uint64(size)) >> np.uint64(11)
            now = arrival[live] - np.log1p(-uniform) / weight[live]
            arrival[live] = now
            slot = row[live] * size + component.astype(np.int64)
            np.minimum.at(time, slot, now)
            won = time[slot] == now
            winner[slot[won]] = value[live[won]]
            latest = time.reshape(n_rows, size).max(1)
            live = live[now < latest[row[live]]]
    return winner.reshape(n_rows, size)


def band_hashes(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A hash per band; the band's number is part of it."""
    parts = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), bands))
    for k in range(rows):
        out = mix(out ^ parts[:, :, k])
    return out.view(np.int64)


_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("node", pa.int64()), ("bands", pa.list_(pa.int64()))]
)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, node (equal for equal shingle sets) and band hashes of every row; no shuffle.

    A text without words has neither node nor bands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n = block.num_rows
            row, value, _, _ = shingle_sets(*utf8(block.column("text")))
            found = band_hashes(signatures(row, value, np.ones(len(row)), n, BANDS * ROWS))
            sizes = np.bincount(row, minlength=n)
            node = np.zeros(n, np.uint64)
            with np.errstate(over="ignore"):
                np.add.at(node, row, mix(value))
                node = mix(node + sizes.astype(np.uint64)).view(np.int64)
            filled = sizes > 0
            upto = np.concatenate([[0], np.cumsum(np.where(filled, BANDS, 0))]).astype(np.int32)
            yield batch_of(
                _SIGNED,
                doc_id=block.column("doc_id"),
                text_key=block.column("text_key"),
                node=pa.array(node, mask=~filled),
                bands=pa.ListArray.from_arrays(pa.array(upto), pa.array(found[filled].ravel())),
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, node long, bands array<long>")


_SETS = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])


def shingle_table(texts: DataFrame) -> DataFrame:
    """node and its distinct shingles (sorted 64-bit hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n = block.num_rows
            row, value, _, _ = shingle_sets(*utf8(block.column("text")))
            order = np.lexsort((value, row))
            packed = value[order].astype("<u8")
            upto = np.searchsorted(row[order], np.arange(n + 1)).tolist()
            yield batch_of(
                _SETS,
                node=block.column("node"),
                shingles=[packed[a:b].tobytes() for a, b in zip(upto[:-1], upto[1:], strict=True)],
            )

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two arrays of distinct values."""
    both = np.sort(np.concatenate([a, b]))
    shared = int((both[1:] == both[:-1]).sum())
    return shared / max(1, len(both) - shared)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets have at least the threshold's Jaccard similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("a", "b", "sa", "sb"))
            found = [
                (a.as_py(), b.as_py())
                for a, b, sa, sb in zip(*columns, strict=True)
                if similarity(np.frombuffer(sa.as_buffer(), "<u8"), np.frombuffer(sb.as_buffer(), "<u8")) >= THRESHOLD
            ]
            yield batch_of(_LINKS, a=[a for a, _ in found], b=[b for _, b in found])

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all linked nodes; a component is named after its least node.

    Alternating large-star and small-star steps; each round is one written table, so lost executors cost a
    round at most. A node of very many links is only ever grouped by a combined minimum.
    """
    edges = durable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs if not large else pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        seen = both.join(least, "u")
        if large:
            made = seen.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            made = seen.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v"))
            )
        return made.filter("u != v").distinct()

    def state(table: DataFrame):
        return table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    while before[0]:
        edges = durable(star(durable(star(edges, large=True)), large=False))
        after = state(edges)
        if after == before:
            break
        before = after
    least = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(least)


# Members of a bucket that meet the members of another block in one task.
_BLOCK = 1024
# Shingles that are looked up at once.
_LOOKUP = 1 << 20


def shared_numbers(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Of each set the values that another one has too, numbered from 0, and how many numbers there are."""
    every = np.concatenate(sets)
    every.sort()
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    del every
    numbers = []
    for own in sets:
        at = np.searchsorted(twice, own)
        held = at < len(twice)
        held[held] = twice[at[held]] == own[held]
        numbers.append(at[held].astype(np.int32))
    return numbers, len(twice)


def compare_block(group: pa.Table) -> pa.Table:
    """Links between members of a bucket that lie in different components.

    All pairs of two blocks (or of one) are compared whole, but for pairs whose sizes alone rule the threshold out,
    pairs that share an earlier bucket (they meet there) and pairs whose components have met here meanwhile.
    """
    n = group.num_rows
    node = group.column("node").to_numpy()
    part = group.column("part").to_numpy()
    component = group.column("component").to_numpy().copy()
    bands = np.array(group.column("bands").to_pylist(), np.int64).reshape(n, BANDS)
    band = int(np.flatnonzero(bands[0] == group.column("bucket")[0].as_py())[0])
    sets = [np.frombuffer(s.as_buffer(), "<u8") for s in group.column("shingles")]
    size = np.array([len(s) for s in sets])
    shared, upto = shared_numbers(sets)
    held = np.zeros(upto, bool)
    crossing = len(set(part.tolist())) > 1 or group.column("low")[0].as_py() != group.column("high")[0].as_py()

    found = []
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        rest = rest[component[rest] != component[i]]
        if crossing:
            rest = rest[part[rest] != part[i]]
        # No pair is more alike than the smaller set is large next to the larger one.
        rest = rest[np.minimum(size[rest], size[i]) / np.maximum(size[rest], size[i]) >= THRESHOLD]
        if band and len(rest):
            rest = rest[~(bands[rest, :band] == bands[i, :band]).any(1)]
        if not len(rest):
            continue
        held[shared[i]] = True
        runs = np.cumsum(size[rest]) // _LOOKUP
        for some in np.split(rest, np.flatnonzero(np.diff(runs)) + 1):
            ends = np.cumsum([len(shared[j]) for j in some])
            hits = np.concatenate([[0], np.cumsum(held[np.concatenate([shared[j] for j in some])])])
            both = np.diff(hits[ends], prepend=0)
            for j in some[both / (size[some] + size[i] - both) >= THRESHOLD].tolist():
                left, right = sorted((int(component[i]), int(component[j])))
                if left != right:
                    component[component == right] = left
                    found.append((int(node[i]), int(node[j])))
        held[shared[i]] = False
    return pa.Table.from_batches([batch_of(_LINKS, a=[a for a, _ in found], b=[b for _, b in found])])


def _more_links(buckets: DataFrame, found: DataFrame, sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links within buckets whose members are still in different components; a large bucket is split into blocks."""
    rows = buckets.select("bucket", "node").join(found, "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    mixed = (
        rows.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("component").alias("c0"), F.max("component").alias("c1"))
        .filter("n > 2 AND c0 != c1")
        .select("bucket", F.ceil(F.col("n") / _BLOCK).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    members = rows.join(mixed, "bucket").withColumn("part", part)
    spread = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "component"
    )
    whole = spread.join(sets, "node").join(nodes.select("node", "bands"), "node")
    return whole.groupBy("bucket", "low", "high").applyInArrow(compare_block, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, class_id and alone per row.

    class_id is the least doc_id of the texts linked to it, directly or through others. Null and empty texts, and texts
    without words, are in no class but their own (class_id = doc_id, alone). Equal texts, and rows that repeat, share a class. A null doc_id has a class, named by the least non-null doc_id in it (null if
    there is none). Texts are compared whole. Other columns are not read.
    """
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = durable(signed(own))
    filled = rows.filter("node IS NOT NULL")
    # Bands follow from the distinct shingles alone: all rows of a node have the same.
    nodes = filled.groupBy("node").agg(
        F.min("bands").alias("bands"), F.min(F.struct("doc_id", "text_key")).alias("at"), F.min("doc_id").alias("least"),
    )
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    buckets = durable(spread.join(shared.drop("n"), "bucket"))

    pairs = durable(buckets.filter("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct())
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "at"), "node")
    keyed = own.withColumn("text_key", text_key())
    on = keyed["doc_id"].eqNullSafe(asked["at.doc_id"]) & (keyed["text_key"] == asked["at.text_key"])
    texts = keyed.join(asked.hint("shuffle_hash"), on).select("node", "text")
    if _repeats(rows):
        texts = texts.dropDuplicates(["node"])

    sets = durable(shingle_table(texts))
    links = durable(linked(pairs, sets))
    found = durable(components(links))
    more = durable(_more_links(buckets, found, sets, nodes))
    if not more.isEmpty():
        # Whole components meet through any of their links.
        found = components(links.unionByName(more))

    named = nodes.select("node", "least").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = named.groupBy("component").agg(F.min("least").alias("class_id"))
    of_node = named.join(classes, "component").select("node", "class_id")
    alone = rows.filter("node IS NULL").select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(True).alias("alone"))
    many = filled.join(of_node, "node").select("doc_id", "text_key", "class_id", F.lit(False).alias("alone"))
    return many.unionByName(alone)


def _repeats(rows: DataFrame) -> bool:
    """Whether some row occurs twice, text and id."""
    return not rows.groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty()


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without near-duplicates: of each class the row with the least doc_id stays, with all its columns.

    Of rows equal in id and text one stays. Texts without words are kept: they are in no class. Classes of null ids
    only lose nothing but repeats.
    """
    classes = near_duplicates(docs)
    mine = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_key")
    # Texts without words are in no class: each stays.
    lone = F.when(F.col("alone") | F.col("class_id").isNull(), F.struct("doc_id", "text_key"))
    first = classes.groupBy("class_id", lone.alias("lone")).agg(F.min(mine).alias("at"))
    stay = first.select(F.col("at.doc_id").alias("_doc_id"), F.col("at.text_key").alias("_text_key"))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    key = [F.col("row.doc_id").cast("long"), text_key("row.text")]
    on = key[0].eqNullSafe(F.col("_doc_id")) & (key[1] == F.col("_text_key"))
    kept = packed.join(stay.hint("shuffle_hash"), on, "left_semi")
    if _repeats(classes):
        kept = kept.groupBy(key[0].alias("_doc_id"), key[1].alias("_text_key")).agg(F.first("row").alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
