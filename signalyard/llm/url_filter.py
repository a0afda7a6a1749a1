"""URL filter: longest matching rule, else gradient-boosted trees on lexical features. DataFrame functions only.

Trees are grown on binned features from gradient sums per (leaf, feature, bin), which one aggregation per tree level
brings to the driver: their number depends on the trees alone. A grown tree is a CASE expression, so the
model is part of the plan and scores inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.session import durable

# (rule, verdict): host, then a path prefix.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# Different labelled URLs that trees are grown on at most, those with the least hash; trees, depth and bins per feature.
TRAIN_ROWS = 50_000
TREES, DEPTH, BINS, RATE, PENALTY = 12, 3, 16, 0.4, 1.0

FEATURES = [
    "url_chars", "host_chars", "path_chars", "host_depth", "path_depth", "digit_share", "entropy", "n_params", "n_hyphens",
    "top_share", "second_share",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://`` up to ``/ ? #``; path from there up to ``? #``. Both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host or one of its parents, and the beginning of the path), and its verdict."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the URL alone. Entropy is that of the URL's letters and digits, in bits."""
    url = F.coalesce(url, F.lit(""))
    folded = F.lower(url)
    total = F.length(F.regexp_replace(folded, "[^a-z0-9]", "")).cast("double")
    terms = F.lit(0.0)
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        n = (F.length(folded) - F.length(F.replace(folded, F.lit(c), F.lit("")))).cast("double")
        terms = terms + F.when(n > 0, -n / total * F.log2(n / total)).otherwise(0.0)
    query = F.when(F.instr(url, "?") > 0, F.substring_index(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "#", 1)).otherwise("")
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    return {
        "url_chars": F.length(url).cast("double"),
        "host_chars": F.length(host).cast("double"),
        "path_chars": F.length(path).cast("double"),
        "host_depth": (F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))).cast("double"),
        "path_depth": (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
        "digit_share": digits / F.greatest(F.length(url), F.lit(1)).cast("double"),
        "entropy": terms,
        "n_params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "n_hyphens": (F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).cast("double"),
    }


@dataclass(frozen=True)
class Shares:
    """The smoothed share of blocked URLs of every suffix of so many labels, as a table (suffix, share)."""

    labels: int
    table: DataFrame
    prior: float

    @staticmethod
    def of(known: DataFrame, labels: int, prior: float) -> Shares:
        """From ``known`` (host, label, weight), all of it, however many suffixes there are."""
        share = (F.sum(F.col("weight") * F.col("label")) + 10 * prior) / (F.sum("weight") + 10)
        found = known.groupBy(_suffix(F.col("host"), labels).alias("suffix")).agg(share.alias("share"))
        return Shares(labels, durable(found), prior)

    def at(self, host: Column) -> Column:
        """The share of a host's suffix; the prior where no labelled URL has it. A subquery, which Spark joins by the table's size."""
        mine = self.table.where(F.col("suffix") == _suffix(host.outer(), self.labels)).select(F.max("share"))
        return F.coalesce(mine.scalar(), F.lit(self.prior))


@dataclass(frozen=True)
class UrlModel:
    """Suffix statistics, and trees as nested (feature, cut, left, right) or leaf values."""

    base: float
    top: Shares | None
    second: Shares | None
    trees: tuple

    def features(self, url: Column, host: Column, path: Column) -> dict[str, Column]:
        """All features; without statistics there are no trees that read the suffix shares."""
        known = self.top is not None and self.second is not None
        return lexical(url, host, path) | ({"top_share": self.top.at(host), "second_share": self.second.at(host)} if known else {})

    def score(self, feature: dict[str, Column]) -> Column:
        """Probability that a URL is to be blocked."""
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _tree(tree, feature)
        return 1 / (1 + F.exp(-total))


def _tree(node, feature: dict[str, Column]) -> Column:
    if isinstance(node, float):
        return F.lit(node)
    name, cut, left, right = node
    return F.when(feature[name] <= cut, _tree(left, feature)).otherwise(_tree(right, feature))


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Distinct quantiles of each feature as places to cut."""
    at = [k / BINS for k in range(1, BINS)]
    found = rows.agg(*[F.percentile_approx(f, at, 10_000).alias(f) for f in FEATURES]).first()
    return {f: sorted(set(found[f] or [])) for f in FEATURES}


def train(urls: DataFrame, label: Column, max_rows: int = TRAIN_ROWS) -> UrlModel:
    """Grow trees on the rows of ``urls`` (url, host, path) where ``label`` (1: block) is not null.

    Suffix statistics cover all labelled rows. Trees grow on at most ``max_rows`` different URLs, those with the least hash, each weighing as
    many rows as it has. Without labelled rows, or with one class only, the model is the smoothed prior.
    """
    rows = urls.withColumn("label", label.cast("double")).filter("label IS NOT NULL")
    known = durable(rows.groupBy("url", "host", "path", "label").agg(F.count("*").cast("double").alias("weight")))
    n, k = known.agg(
        F.coalesce(F.sum("weight"), F.lit(0.0)), F.coalesce(F.sum(F.col("weight") * F.col("label")), F.lit(0.0))
    ).first()
    prior = (k + 1) / (n + 2)
    base = log(prior / (1 - prior))
    if k in (0, n):
        return UrlModel(base, None, None, ())
    top, second = (Shares.of(known, labels, prior) for labels in (1, 2))
    sample = known.orderBy(F.xxhash64("url"), "url").limit(max_rows)
    named = UrlModel(base, top, second, ()).features(F.col("url"), F.col("host"), F.col("path"))
    values = durable(sample.select("label", "weight", *[c.alias(f) for f, c in named.items()]))
    cuts = _cuts(values)
    own = {f: F.col(f) for f in FEATURES}
    bins = [
        F.struct(F.lit(f).alias("feature"), sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias("bin"))
        for f in FEATURES
    ]
    binned = values.withColumn("bins", F.array(*bins))
    trees: list = []
    w = F.col("weight")
    for _ in range(TREES):
        p = UrlModel(base, top, second, tuple(trees)).score(own)
        step = durable(binned.select("bins", *FEATURES, (w * (p - F.col("label"))).alias("g"), (w * p * (1 - p)).alias("h")))
        trees.append(_grow(step, cuts, own))
    return UrlModel(base, top, second, tuple(trees))


def _grow(rows: DataFrame, cuts: dict[str, list[float]], own: dict[str, Column]):
    """One regression tree on gradients; at most 2^DEPTH leaves, one aggregation per level."""
    splits: dict[int, tuple[str, float]] = {}  # heap numbering: children of i are 2i and 2i + 1
    leaves: dict[int, float] = {}
    totals: dict[int, tuple[float, float]] = {}
    for depth in range(DEPTH):
        node = F.lit(1)
        for level in range(depth):
            for i in range(1 << level, 2 << level):
                if i in splits:
                    name, cut = splits[i]
                    node = F.when(node == i, F.when(own[name] <= cut, 2 * i).otherwise(2 * i + 1)).otherwise(node)
        sums = (
            rows.select(node.alias("node"), F.explode("bins").alias("b"), "g", "h")
            .groupBy("node", "b.feature", "b.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            .collect()
        )
        found: dict[int, dict[str, dict[int, tuple[float, float]]]] = {}
        for r in sums:
            found.setdefault(r["node"], {}).setdefault(r["feature"], {})[r["bin"]] = (r["g"], r["h"])
        for i in range(1 << depth, 2 << depth):
            if i not in found:
                continue
            g = sum(v[0] for v in found[i][FEATURES[0]].values())
            h = sum(v[1] for v in found[i][FEATURES[0]].values())
            totals[i] = (g, h)
            best = (1e-6, "", 0.0, (0.0, 0.0))
            for name in FEATURES:
                left_g = left_h = 0.0
                for k, cut in enumerate(cuts[name]):
                    more = found[i].get(name, {}).get(k, (0.0, 0.0))
                    left_g, left_h = left_g + more[0], left_h + more[1]
                    gain = (
                        left_g**2 / (left_h + PENALTY) + (g - left_g) ** 2 / (h - left_h + PENALTY) - g**2 / (h + PENALTY)
                    )
                    # Rounded: sums differ in their last digits with the order of additions.
                    if round(gain, 6) > best[0]:
                        best = (round(gain, 6), name, cut, (left_g, left_h))
            if best[1]:
                splits[i] = best[1:3]
                totals[2 * i], totals[2 * i + 1] = best[3], (g - best[3][0], h - best[3][1])
    for i, (g, h) in totals.items():
        leaves[i] = round(-RATE * g / (h + PENALTY), 9)

    def build(i: int):
        return (*splits[i], build(2 * i), build(2 * i + 1)) if i in splits else leaves.get(i, 0.0)

    return build(1)


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, max_rows: int = TRAIN_ROWS, threshold: float = 0.5
) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row of ``pages`` (page_id, url).

    Rows that a rule fits are the labelled URLs: the trees learn from them and judge the others. Null urls and urls without ``://``
    have an empty host and path, no rule, and are judged like all others. Repeated rows are judged alike; other columns
    are not read; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    parsed = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
        .withColumns({"host": host, "path": path}).withColumns({"rule": rule, "ruled": verdict})
    )
    model = train(parsed, F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("int")), max_rows)
    named = model.features(F.col("url"), F.col("host"), F.col("path"))
    scored = parsed.withColumns(named).withColumn("score", model.score({f: F.col(f) for f in FEATURES}))
    judged = F.coalesce("ruled", F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", judged.alias("verdict"), "score")

