"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Presence of a hashed n-gram counts, not how often it occurs. Each chosen feature is scaled by the log of how much likelier it
is in toxic texts, and a logistic regression weighs the scaled features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import batch_of, blocks, ship, utf8
from signalyard.session import durable

GRAMS = (4, 5, 6)
BITS = 18
# Labelled texts per class that the classifier is fitted on (those with the least hash of doc_id).
SAMPLE_PER_CLASS = 3000
# Every n-gram whose presence depends on the class at this chi-square (one degree of freedom, 0.1 %) has a weight.
SIGNIFICANT = 10.83
THRESHOLD = 0.3

# An odd number near 2^64 divided by the golden ratio: multiplication spreads n-grams over the features.
_SPREAD = np.uint64(int((5**0.5 - 1) / 2 * 2**64) | 1)

# Lower case; ASCII other than letters and digits is a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
for _first in "aA":
    _FOLD[ord(_first) : ord(_first) + 26] = np.arange(ord("a"), ord("z") + 1)


def gram_features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every n-gram of a block. Each text has a space put before and after it."""
    n = len(starts) - 1
    shift = np.arange(n) * 2
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    row = np.repeat(np.arange(n), np.diff(starts))
    padded[np.arange(len(data)) + 2 * row + 1] = _FOLD[data]
    bounds = np.append(starts[:-1] + shift, len(padded))
    owner = np.repeat(np.arange(n), np.diff(bounds))
    rows, features = [], []
    # An n-gram of at most seven bytes is one number, exact before it is hashed.
    packed = padded.astype(np.uint64)
    for size in range(2, max(GRAMS) + 1):
        packed = (packed[:-1] << np.uint64(8)) | padded[size - 1 :]
        if size not in GRAMS:
            continue
        inside = owner[: len(packed)] == owner[size - 1 : size - 1 + len(packed)]
        rows.append(owner[: len(packed)][inside])
        hashed = (packed[inside] + np.uint64(size << 56)) * _SPREAD
        features.append((hashed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(features)


@dataclass(frozen=True)
class Model:
    """Log-odds per hashed feature (zero for those not chosen) and the intercept."""

    weight: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        row, feature = gram_features(data, starts)
        seen = self.weight[feature] != 0
        pairs = np.unique((row[seen] << BITS) | feature[seen])
        total = np.bincount(pairs >> BITS, weights=self.weight[pairs & ((1 << BITS) - 1)], minlength=len(starts) - 1)
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -30, 30)))


def log_ratio(yes: np.ndarray, every: np.ndarray, n_yes: float, n: float) -> np.ndarray:
    """How much likelier a feature is in toxic texts, as a smoothed log ratio of presences."""
    return np.log((yes + 1) / (n_yes + 2)) - np.log((every - yes + 1) / (n - n_yes + 2))


def fit(
    chosen: np.ndarray, ratio: np.ndarray, features: list[np.ndarray], toxic: np.ndarray, share: np.ndarray, steps: int = 300
) -> Model:
    """Weigh the ``chosen`` features, scaled by ``ratio``, by a logistic regression on sparse rows.

    ``features``: which of them each text has; ``share``: how many labelled texts a text stands for. Memory follows the
    features that the texts have, not their number times that of the features.
    """
    n = len(features)
    if not n:
        return Model(np.zeros(1 << BITS), 0.0)
    prior = float((share * toxic).sum() / share.sum())
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    if len(set(toxic.tolist())) < 2 or not len(chosen):
        return Model(np.zeros(1 << BITS), float(np.log(prior / (1 - prior))))
    place = np.zeros(1 << BITS, np.int64)
    place[chosen] = np.arange(len(chosen))
    column = place[np.concatenate(features)]
    row = np.repeat(np.arange(n), [len(f) for f in features])
    x = ratio[column]
    # Accelerated gradient steps on the weighted, L2-penalized logistic loss.
    weight = share / share.sum()
    penalty = 1e-3
    bound = 0.25 * float(weight @ (np.bincount(row, weights=x * x, minlength=n) + 1)) + penalty
    b = b_ahead = np.log(prior / (1 - prior))
    w = w_ahead = np.zeros(len(chosen))
    momentum = 1.0
    for _ in range(steps):
        odds = np.bincount(row, weights=x * w_ahead[column], minlength=n) + b_ahead
        error = weight * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - toxic)
        slope = np.bincount(column, weights=x * error[row], minlength=len(chosen))
        w_next = w_ahead - (slope + penalty * w_ahead) / bound
        b_next = b_ahead - error.sum() / bound
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        w_ahead = w_next + (momentum - 1) / after * (w_next - w)
        b_ahead = b_next + (momentum - 1) / after * (b_next - b)
        w, b, momentum = w_next, b_next, after
    out = np.zeros(1 << BITS)
    out[chosen] = w * ratio
    return Model(out, float(b))


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_COUNTS = pa.schema([("feature", pa.int64()), ("yes", pa.int64()), ("every", pa.int64())])
_EXAMPLES = pa.schema([("toxic", pa.int32()), ("features", pa.binary())])


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, significant: float = SIGNIFICANT
) -> Model:
    """Fit on at most ``per_class`` labelled texts of each class that are not held out.

    The sample is the rows with the least hash of doc_id; every text stands for as many as its class has in the sample's place, so
    the prior is that of all training labels. Features are all n-grams of more than four texts that reach ``significant``, however many.
    A doc_id with several labels is toxic if one says so; null labels and ids are ignored.
    """
    ship(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    # At most 2 * per_class rows.
    sample = F.broadcast(picked[0].unionByName(picked[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id").select("toxic", "text")
    texts = durable(texts.filter("toxic IS NOT NULL"))
    n, n_yes = texts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()

    def present(block: pa.RecordBatch, among: np.ndarray | None = None) -> np.ndarray:
        row, feature = gram_features(*utf8(block.column("text")))
        if among is not None:
            row, feature = row[among[feature]], feature[among[feature]]
        return np.unique((row << BITS) | feature)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yes, every = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for block in blocks(batches):
            pairs = present(block)
            feature = pairs & ((1 << BITS) - 1)
            toxic = block.column("toxic").to_numpy()[pairs >> BITS]
            every += np.bincount(feature, minlength=1 << BITS)
            yes += np.bincount(feature[toxic == 1], minlength=1 << BITS)
        seen = np.flatnonzero(every)
        yield batch_of(_COUNTS, feature=seen, yes=yes[seen], every=every[seen])

    counts = texts.mapInArrow(count, "feature long, yes long, every long").groupBy("feature").agg(
        F.sum("yes").alias("yes"), F.sum("every").alias("every")
    )
    # The features that tell the classes apart: chi-square of presence. There are at most 2^BITS.
    expected = F.col("every") * (n_yes / max(1, n))
    spread = expected * (1 - F.col("every") / max(1, n)) * ((n - n_yes) / max(1, n))
    chi = F.when((F.col("every") > 4) & (spread > 0), F.pow(F.col("yes") - expected, 2) / spread)
    best = counts.withColumn("chi", chi).filter(F.col("chi") >= significant).toArrow().sort_by("feature")
    chosen = best.column("feature").to_numpy()
    ratio = log_ratio(*(best.column(c).to_numpy().astype(np.float64) for c in ("yes", "every")), n_yes, n)
    among = np.zeros(1 << BITS, bool)
    among[chosen] = True

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            pairs = present(block, among)
            upto = np.searchsorted(pairs >> BITS, np.arange(block.num_rows + 1)).tolist()
            packed = (pairs & ((1 << BITS) - 1)).astype("<i4")
            yield batch_of(
                _EXAMPLES, toxic=block.column("toxic"),
                features=[packed[a:b].tobytes() for a, b in zip(upto[:-1], upto[1:], strict=True)],
            )

    # At most 2 * per_class rows of ids.
    rows = sorted((r["toxic"], bytes(r["features"])) for r in texts.mapInArrow(extract, "toxic int, features binary").collect())
    toxic = np.array([t for t, _ in rows], np.float64)
    share = np.array([total[t] / max(1, int((toxic == t).sum())) for t, _ in rows])
    return fit(chosen, ratio, [np.frombuffer(f, "<i4") for _, f in rows], toxic, share)


_OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, from its whole text; no shuffle.

    A null or empty text is scored as an empty one. Repeated rows get equal scores; a null id stays null.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield batch_of(_OUT, doc_id=block.column("doc_id"), score=shared.value.scores(*utf8(block.column("text"))))

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
