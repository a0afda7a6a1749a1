"""Ranked lexical search: documents are grouped by which terms of an item they hold, best groups first.

Items are read into the tasks in blocks of a fixed number of terms; documents are read twice per block: once to count in how many
documents each term occurs, once to score. In a task the documents of a block of text become presence bitmaps, one per term. For
an item the bitmaps, turned to one mask per document, group the documents; a mask's score is at most what its terms could give.
Masks are scored from the highest such bound down, until the next bound is below the item's k-th best score of the task so far. Each task
returns k documents per item, of which k remain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalyard.llm.common import batch_of, blocks, ship, text_of, utf8
from signalyard.llm.decontaminate import hashed_words

# Terms of items (with repeats) that one pass over the documents takes, and documents of one set of bitmaps.
PASS_TERMS, MOST_DOCS = 200_000, 2048
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Items:
    """The items of a pass: distinct terms as sorted hashes, and per item its term numbers with their repeats."""

    known: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @staticmethod
    def of(texts: list[str]) -> Items:
        words, hashes = hashed_words(*utf8(pa.array(texts, pa.string())))
        known, number = np.unique(hashes, return_inverse=True)
        own = [np.unique(number[a:b], return_counts=True) for a, b in zip(words.starts[:-1], words.starts[1:], strict=True)]
        return Items(known, [t for t, _ in own], [r for _, r in own])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each term, -1 where no item has it."""
        if not len(self.known):
            return np.full(len(hashes), -1, np.int64)
        seen = np.zeros(1 << 18, bool)
        seen[self.known >> np.uint64(46)] = True
        maybe = np.flatnonzero(seen[hashes >> np.uint64(46)])
        place = np.minimum(np.searchsorted(self.known, hashes[maybe]), len(self.known) - 1)
        out = np.full(len(hashes), -1, np.int64)
        out[maybe] = np.where(self.known[place] == hashes[maybe], place, -1)
        return out


class Postings:
    """Of one block of documents: terms per document, and the documents and counts of every known term."""

    def __init__(self, column: pa.Array, items: Items):
        words, hashes = hashed_words(*utf8(column))
        self.sizes = np.diff(words.starts)
        number = items.numbers(hashes)
        hit = np.flatnonzero(number >= 0)
        n = len(column)
        pairs, self.tf = np.unique(number[hit] * n + words.row[hit], return_counts=True)
        self.term, self.doc = (pairs // n, pairs % n) if len(pairs) else (pairs, pairs)
        self.starts = np.searchsorted(self.term, np.arange(len(items.known) + 1))


_COUNTED = pa.schema([("term", pa.int64()), ("n", pa.int64())])
# Numbers below 0 for what is counted over all documents.
_DOCS, _TERMS = -1, -2


def count_terms(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    """Documents with each term, documents with any, terms with repeats: one set of rows per task."""
    df = np.zeros(len(items.known), np.int64)
    docs = terms = 0
    for block in blocks(batches):
        found = Postings(block.column("text"), items)
        df += np.diff(found.starts)
        docs += int((found.sizes > 0).sum())
        terms += int(found.sizes.sum())
    held = np.flatnonzero(df)
    yield batch_of(_COUNTED, term=np.append(held, [_DOCS, _TERMS]), n=np.append(df[held], [docs, terms]))


def term_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Ranking:
    """The best documents of each item so far, at most ``k``: higher scores first, then smaller ids, nulls last."""

    def __init__(self, n_items: int, k: int):
        self._k = k
        self.scores = [np.zeros(0, np.int64)] * n_items
        self.ids = [np.zeros(0, np.int64)] * n_items
        self.least = np.ones(n_items, np.int64)  # a score below this cannot enter

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        ok = scores >= self.least[item]
        scores, ids = np.append(self.scores[item], scores[ok]), np.append(self.ids[item], ids[ok])
        best = np.lexsort((ids, -scores))[: self._k]
        self.scores[item], self.ids[item] = scores[best], ids[best]
        if len(best) == self._k:
            self.least[item] = max(1, int(scores[best[-1]]))


def score_item(found: Postings, m: np.ndarray, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray, item: int, ranking: Ranking) -> None:
    """Adds the documents of a block that may be among the item's best."""
    begin, end = found.starts[terms], found.starts[terms + 1]
    there = end > begin
    begin, end, weights = begin[there], end[there], weights[there]
    if not len(begin):
        return
    size = end - begin
    place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    column = np.repeat(np.arange(len(begin)), size)
    doc, tf = found.doc[place], found.tf[place]
    # What each term can give at most in this block.
    most = np.zeros(len(begin), np.int64)
    np.maximum.at(most, column, term_score(tf, m[doc]))
    if int(weights @ most) < ranking.least[item]:
        return
    presence = np.zeros((len(begin), len(m)), bool)
    presence[column, doc] = True
    bitmaps = np.packbits(presence, axis=1)
    held = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps, axis=0), count=len(m)))
    masks = np.ascontiguousarray(np.packbits(presence[:, held], axis=0).T)
    distinct, at, group = np.unique(masks.view(f"S{masks.shape[1]}").ravel(), return_index=True, return_inverse=True)
    bound = presence[:, held[at]].T.astype(np.int64) @ (weights * most)
    order = np.argsort(-bound, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by_rank = np.argsort(rank[group.ravel()], kind="stable")
    upto = np.concatenate([[0], np.cumsum(np.bincount(rank[group.ravel()], minlength=len(distinct)))])
    counts = np.zeros(presence.shape, np.int64)
    counts[column, doc] = tf
    done, step = 0, 16
    while done < len(order) and bound[order[done]] >= ranking.least[item]:
        until = int(np.searchsorted(-bound[order], -ranking.least[item], "right"))
        until = min(until, done + step)
        chosen = held[by_rank[upto[done] : upto[until]]]
        scores = weights @ term_score(counts[:, chosen], m[chosen])
        ranking.add(item, scores, ids[chosen])
        done, step = until, 2 * step


_BEST = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def best_of_task(
    batches: Iterator[pa.RecordBatch], items: Items, weights: np.ndarray, n_docs: int, n_terms: int, k: int
) -> Iterator[pa.RecordBatch]:
    """The ``k`` best documents of a task for every item."""
    ranking = Ranking(len(items.terms), k)
    own = [weights[t] * r for t, r in zip(items.terms, items.repeats, strict=True)]
    for block in blocks(batches):
        for begin in range(0, block.num_rows, MOST_DOCS):
            part = block.slice(begin, MOST_DOCS)
            found = Postings(part.column("text"), items)
            if not len(found.doc):
                continue
            m = 75 + (25 * found.sizes * n_docs) // n_terms
            ids = part.column("doc_id").fill_null(_NO_ID).to_numpy()
            for item, terms in enumerate(items.terms):
                score_item(found, m, ids, terms, own[item], item, ranking)
    sizes = [len(s) for s in ranking.scores]
    if sum(sizes):
        ids = np.concatenate(ranking.ids)
        yield batch_of(
            _BEST, query=np.repeat(np.arange(len(sizes)), sizes), score=np.concatenate(ranking.scores),
            doc_id=pa.array(ids, pa.int64(), mask=ids == _NO_ID),
        )


def search(docs: DataFrame, items: DataFrame, k: int = 20, pass_terms: int = PASS_TERMS) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score of the ``k`` best documents with a score above 0 for each item.

    Terms are the maximal runs of digits, letters and characters beyond ASCII, A-Z lower-cased. With N documents that hold a
    term, L terms in all, n in a document, df documents with a term and tf its occurrences in one: a term weighs
    w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 75 + (25nN) div L, and a score sums w * ((10^9 tf) div (1000 tf + 12 m)) over the
    item's terms, repeats included. Equal scores are ordered by doc_id, a null id last.

    A null or empty text has no terms: it is never found, and such an item finds nothing; so does an item whose terms no document holds.
    Rows of ``docs`` that repeat are ranked one by one; equal rows of ``items`` are one item, rows that share an item_id with other
    texts are ranked apart. Other columns are not read. The items of a pass are collected: at most about ``pass_terms`` terms, counted
    beforehand, and at least one item.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    asked = items.select("item_id", "text").distinct().withColumn("_n", F.regexp_count("text", F.lit(_TERM))).filter("_n > 0")
    passes = max(1, math.ceil((asked.agg(F.sum("_n")).first()[0] or 0) / pass_terms))
    kind = items.schema["item_id"].dataType.simpleString()
    result = None
    for number in range(passes):
        block = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
        rows = block.select("item_id", "text").collect()
        own = spark.sparkContext.broadcast(Items.of([r["text"] for r in rows]))

        def count(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            return count_terms(batches, own.value)

        counted = texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
        totals = {r["term"]: r["n"] for r in counted}
        n_docs, n_terms = totals.get(_DOCS, 0), totals.get(_TERMS, 0)
        df = np.zeros(len(own.value.known))
        for term, n in totals.items():
            if term >= 0:
                df[term] = n
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)

        def best(batches: Iterator[pa.RecordBatch], own=own, weights=weights, totals=(n_docs, n_terms)) -> Iterator[pa.RecordBatch]:
            return best_of_task(batches, own.value, weights, *totals, k)

        found = texts.mapInArrow(best, "query long, doc_id long, score long")
        names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], f"query long, item_id {kind}")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        # No more names than items of the pass, whose terms are bounded.
        part = ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        result = part if result is None else result.unionByName(part)
    return result
