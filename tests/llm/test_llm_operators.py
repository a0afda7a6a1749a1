"""Operators and the pipeline on small tables with nulls, ties, repeats, long texts, clashing columns and no rows."""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("signalyard.llm")
tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from check import TABLES, _table  # noqa: E402
from signalyard.llm import (  # noqa: E402
    decontaminate, line_dedup, minhash, packing, quality, token_counts, token_files, toxicity, url_filter, warc,
)
from signalyard.llm.common import utf8  # noqa: E402
from signalyard.llm.queries import ORACLES, QUERIES, vocabulary  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, row string, n_lines long, kept int, key string"


def _words(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return [f"{draw.choice('abcdefgh')}{draw.randint(0, 5000)}" for _ in range(n)]


SHARED = "This line of the licence is shared by many."
BASE = _words(1, 300)
ROWS = [
    (1, " ".join(BASE)), (2, " ".join(BASE)), (3, " ".join(BASE[:290])), (4, f"{SHARED}\nown line\n{SHARED}"),
    (5, f" {SHARED.upper()} \nmine"), (6, SHARED), (6, SHARED), (7, None), (8, ""), (None, f"{SHARED}\nno id"), (None, None),
    (9, " ".join(_words(2, 40_000))), (10, "\n".join(["again and again and again it says"] * 30)), (11, "é ß 日本 \x1c <|endoftext|> Σ"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "r", 5, 6, "k") for i, t in ROWS], DDL).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = db.execute(ORACLES[name])
    df = QUERIES[name](spark, FOLDER)
    assert _table(df.columns, df.collect()) == _table([c[0] for c in cursor.description], cursor.fetchall())


def test_quality(docs, none):
    got = quality.repetition(docs).collect()
    assert len(got) == len(ROWS) and quality.repetition(none).count() == 0
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["kept"] and by[9]["kept"] and by[9]["n_words"] == 40_000 and by[1]["row"] == "r"
    assert by[10]["base_failed"] and not by[10]["kept"] and by[10]["n_dup_lines"] == 29
    assert by[7]["base_failed"] and by[8]["base_failed"]


def test_quality_judges_what_the_base_rule_lets_pass(spark):
    """A sentence five times, and a line of two words thirty times, each about a quarter of a text; both pass the base rule."""
    words = [f"word{k:03d}" for k in range(200)]
    sentence = " ".join(f"again{k:02d}" for k in range(12))
    parts = [" ".join(words[40 * k : 40 * k + 40]) for k in range(5)]
    rows = [
        (1, "\n".join(f"{p} {sentence}" for p in parts)),
        (2, "\n".join(f"{w}\nsame line" for w in words[:30]) + "\n" + " ".join(words[30:110])),
        (3, " ".join([*words, sentence])),
    ]
    got = {r["doc_id"]: r for r in quality.repetition(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert got[1]["dup_chars_10"] == 5 * 12 * 7 and got[2]["dup_line_chars"] == 30 * 8 and got[2]["dup_chars_5"] == 0
    assert {k: r["kept"] for k, r in got.items()} == {1: False, 2: False, 3: True}


def test_line_dedup(docs, none):
    got = line_dedup.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "row", "kept", "key", "n_lines", "n_dropped"]
    rows = sorted(((r["doc_id"] or 0, r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr)
    assert len(rows) == len(ROWS) and line_dedup.dedup_lines(none).count() == 0
    # The largest doc_id keeps its lines; both rows of it; a null id counts as one more, smaller document.
    assert [r for r in rows if r[0] == 4] == [(4, "own line", 3, 2)]
    assert [r for r in rows if r[0] == 5] == [(5, "mine", 2, 1)]
    assert [r for r in rows if r[0] == 6] == [(6, SHARED, 1, 0)] * 2
    assert (0, "no id", 2, 1) in rows and (7, "", 1, 0) in rows and (0, "", 1, 0) in rows
    assert [r for r in rows if r[0] == 10][0][2:] == (30, 0)


def test_line_dedup_with_a_line_over_many_batches(spark):
    rows = [(k, f"{SHARED}\nline number {k} is only here, once\na line that just two hold, {k // 2}") for k in range(400)]
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_lines(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert got == {k: int(k != 399) for k in range(400)}


def test_warc(spark, tmp_path):
    big = "<p>" + "x" * 2000 + "</p>"
    rows = [(1, "http://a/", big), (2, None, big), (2, "http://a b\n", big), (3, "u", None), (4, "v", "é"), (None, "w", big), (5, "u", "é")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    manifest = warc.write_warc(pages, str(tmp_path / "a"), roll_bytes=100)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_warc(manifest).collect()), key=repr)
    sha = {t: hashlib.sha1(t.encode()).hexdigest() for t in (big, "", "é")}
    want = [(1, "revisit", 2, 2007, sha[big]), (2, "response", None, 2007, sha[big]), (2, "revisit", 2, 2007, sha[big]),
            (3, "response", None, 0, sha[""]), (4, "response", None, 2, sha["é"]), (5, "response", None, 2, sha["é"]),
            (None, "revisit", 2, 2007, sha[big])]
    assert got == sorted(want, key=repr)
    files = {p.name: p.read_bytes() for p in (tmp_path / "a").iterdir() if p.suffix == ".gz"}
    assert len(files) >= 2 and not [p for p in (tmp_path / "a").iterdir() if p.name.startswith("_")]
    warc.write_warc(pages, str(tmp_path / "b"), roll_bytes=100)
    assert files == {p.name: p.read_bytes() for p in (tmp_path / "b").iterdir() if p.suffix == ".gz"}
    assert warc.read_warc(warc.write_warc(pages.limit(0), str(tmp_path / "c"))).count() == 0


def test_warc_shards_are_found_in_blocks_of_bounds(spark):
    draw = random.Random(3)
    for n in (1, 2, 3, 10, 99, 1000):
        bounds = sorted(draw.sample(range(-5000, 5000), n))
        ids = [*bounds, *(b + 1 for b in bounds), bounds[0] - 1, bounds[-1] + 9]
        rows = spark.createDataFrame([(i,) for i in ids] + [(None,)], "page_id long").withColumn("at", warc._place(bounds)).collect()
        assert [r["at"] for r in rows] == [bisect.bisect_left(bounds, i) for i in ids] + [0]


def test_warc_files_follow_from_the_pages_alone(spark, tmp_path, monkeypatch):
    """More rows than Spark samples for a range, dealt in two ways, give the same files."""
    monkeypatch.setattr(warc, "SHARD_BYTES", 40_000, raising=False)
    pages = spark.range(6000).selectExpr("id * id AS page_id", "concat('http://a/', id) AS url", "repeat(cast(id % 89 AS string), 30) AS html")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, parts in (("a", 3), ("b", 7)):
            assert warc.read_warc(warc.write_warc(pages.repartition(parts), str(tmp_path / name))).count() == 6000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    a, b = ({p.name: p.read_bytes() for p in (tmp_path / name).iterdir() if p.suffix == ".gz"} for name in "ab")
    assert a == b and len(a) >= 4


def _library(name):
    return tokenizers.Tokenizer.from_file(vocabulary(name))


def test_token_counts(docs, none):
    library = _library("byte_bpe_50k.json")
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(docs, vocabulary("byte_bpe_50k.json")).collect()), key=repr)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    assert got == sorted(((*w, w[2] > 1024) for w in want), key=repr)
    assert token_counts.token_counts(none, vocabulary("byte_bpe_50k.json")).count() == 0


def _ids():
    library = _library("word_bpe_49k.json")
    return [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in ROWS]


def test_packing(docs, none):
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"), size=256).collect()
    windows, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
        parts[p["doc_id"], p["doc_tokens"]].append((p["start"], np.frombuffer(p["ids"], "<u4").tolist()))
        assert len(p["ids"]) == 4 * p["length"]
    for own in windows.values():
        assert [o for o, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)]).tolist()][:-1]
        assert sum(n for _, n in own) <= 256
    whole = defaultdict(int)
    for i, ids in _ids():
        whole[i, len(ids) + 1] += 1
    assert {k: sum(len(x) for _, x in v) for k, v in parts.items()} == {k: n * k[1] for k, n in whole.items()}
    for i, ids in _ids():
        if whole[i, len(ids) + 1] == 1:
            assert sum((x for _, x in sorted(parts[i, len(ids) + 1])), []) == [*ids, 1]
    assert packing.pack(none, vocabulary("word_bpe_49k.json")).count() == 0


def test_token_files(docs, none, tmp_path):
    manifest = token_files.write_tokens(docs, vocabulary("word_bpe_49k.json"), str(tmp_path / "t"), shard_ids=5000)
    got = sorted(token_files.read_tokens(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got]).tolist()][:-1]
    want = sorted(((i, [*ids, 2]) for i, ids in _ids()), key=repr)
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got), key=repr) == want
    empty = token_files.write_tokens(none, vocabulary("word_bpe_49k.json"), str(tmp_path / "e"))
    assert token_files.read_tokens(empty).count() == 0


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_against_all_pairs(spark):
    draw = random.Random(9)
    rows = []
    for family in range(12):
        origin = _words(100 + family, 120)
        for _ in range(25):
            own = list(origin)
            for _ in range(draw.choice([0, 1, 2, 3, 4, 6, 9])):
                own[draw.randrange(len(own))] = f"z{draw.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(own)))
    sets = [_shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == {i: root(i) for i in range(len(rows))} and 12 < len(set(got.values())) < 250


def test_near_duplicates_with_repeated_passages(spark):
    """What a text repeats counts once: families with a footer 1 to 100 times over give the classes of all pairs."""
    draw = random.Random(12)
    rows = []
    for family in range(40):
        origin, footer = _words(500 + family, 300), _words(900 + family, 50)
        for times in (0, 1, 10, 50, 100):
            own = list(origin)
            for _ in range(draw.choice([0, 0, 1, 3])):
                own[draw.randrange(len(own))] = f"z{draw.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(own + footer * times)))
    sets = [_shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == {i: root(i) for i in range(len(rows))} and 40 <= len(set(got.values())) < 120


def test_rows_of_a_node_have_equal_bands(spark):
    footer = _words(4, 50)
    rows = [(k, " ".join(BASE + footer * times)) for k, times in enumerate([2, 3, 10, 100])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert len({(r["node"], tuple(r["bands"])) for r in minhash.signed(df).collect()}) == 1


def test_block_comparison_against_all_pairs():
    """No pair of a bucket that reaches the threshold is passed over, whatever share of it a text repeats."""
    draw = np.random.default_rng(13)
    sets = []
    for _ in range(60):
        origin = draw.integers(0, 1 << 62, draw.integers(5, 400), dtype=np.uint64)
        for _ in range(4):
            keep = draw.random(len(origin)) > draw.choice([0.05, 0.1, 0.2])
            sets.append(np.unique(np.concatenate([origin[keep], draw.integers(0, 1 << 62, 3, dtype=np.uint64)])))
    n = len(sets)
    group = pa.table({
        "bucket": np.zeros(n, np.int64), "low": np.zeros(n, np.int64), "high": np.zeros(n, np.int64), "part": np.zeros(n, np.int64),
        "node": np.arange(n), "component": np.arange(n), "shingles": pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
        "bands": pa.array([[0] * minhash.BANDS] * n),
    })
    links = minhash.compare_block(group).to_pylist()
    alike = [(i, j) for i in range(n) for j in range(i + 1, n) if minhash.similarity(sets[i], sets[j]) >= minhash.THRESHOLD]
    assert {(x["a"], x["b"]) for x in links} <= set(alike)

    def groups(pairs):
        of = list(range(n))
        for a, b in pairs:
            of = [min(of[a], of[b]) if c in (of[a], of[b]) else c for c in of]
        return of

    assert groups((x["a"], x["b"]) for x in links) == groups(alike) and len(alike) > 60


def test_near_duplicates_edges(docs, none):
    got = sorted(((r["doc_id"], r["class_id"]) for r in minhash.near_duplicates(docs).collect()), key=repr)
    assert [c for i, c in got if i in (1, 2, 3)] == [1, 1, 1] and len(got) == len(ROWS)
    # Rows 5 and 6 share 5 of 6 shingles, case aside.
    assert [c for i, c in got if i in (5, 6, 7, 8, 9)] == [5, 5, 5, 7, 8, 9]
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, 4, 5, 7, 8, 9, 10, 11, None, None], key=repr)
    assert minhash.near_duplicates(none).count() == 0 and minhash.keep_one(none).count() == 0


def test_decontamination_in_one_pass_and_many(spark, docs, none):
    items = spark.createDataFrame(
        [(1, " ".join(BASE[5:40])), (2, "own LINE"), (2, "own LINE"), (3, None), (None, "own line"), (4, "..."), (5, " ".join(BASE[30:60]))],
        "item_id long, text string",
    )
    asked = ["doc_id", "item_ids", "begins", "ends", "n_words", "n_hit", "contaminated", "row"]
    one = sorted(map(repr, decontaminate.match_benchmark(docs, items).select(*asked).collect()))
    many = sorted(map(repr, decontaminate.match_benchmark(docs, items, pass_bytes=100).select(*asked).collect()))
    assert one == many and len(one) == len(ROWS)
    by = {r["doc_id"]: r for r in decontaminate.match_benchmark(docs, items).collect()}
    assert (by[1]["item_ids"], by[1]["begins"], by[1]["ends"], by[1]["n_hit"]) == ([1, 5], [5], [60], 55) and by[1]["contaminated"]
    assert by[4]["item_ids"] == [2] and by[4]["n_hit"] == 2 and by[8]["n_words"] == 0 and not by[8]["contaminated"]
    assert decontaminate.match_benchmark(none, items).count() == 0
    assert decontaminate.match_benchmark(docs, items.limit(0)).filter("contaminated").count() == 0


def test_toxicity_on_held_out_rows(spark, none):
    draw = random.Random(10)
    rows = []
    for k in range(1200):
        bad = draw.random() < 0.3
        words = _words(1000 + k, draw.randint(20, 200))
        for _ in range(2 if bad else 0):
            words[draw.randrange(len(words))] = draw.choice(["vile", "rotten", "filth!"])
        rows.append((k, " ".join(words), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    labels = df.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int"))
    texts = df.select("doc_id", "text").union(spark.createDataFrame([(9999, None), (None, "vile")], "doc_id long, text string"))
    model = toxicity.train(texts, labels)
    scored = toxicity.score_toxicity(texts, model).join(df.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    assert len(scored) > 200 and np.mean([r["predicted"] == r["toxic"] for r in scored]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.train(texts, labels.limit(0)).intercept == 0.0 and toxicity.score_toxicity(none, model).count() == 0
    # Every text is scored alike however often it is repeated, and a long one by all of its n-grams.
    odd = spark.createDataFrame(
        [(1, "vile", "x"), (1, "vile", "y"), (2, "calm " * 40_000 + "vile rotten filth!", "x"), (3, "calm " * 40_000, "x")],
        "doc_id long, text string, score string",
    )
    got = sorted((r["doc_id"], r["score"]) for r in toxicity.score_toxicity(odd, model).collect())
    assert got[0] == got[1] and got[2][1] > got[3][1]


def test_toxicity_by_hand():
    """Features, ratios and scores next to plain loops; every chosen n-gram gets a weight of the right sign."""

    def grams(text):
        text = f" {text} "
        return {text[i : i + n] for n in toxicity.GRAMS for i in range(len(text) - n + 1)}

    texts = ["calm sea, calm SKY", "", "a-b", "vile"]
    row, feature = toxicity.gram_features(*utf8(pa.array(texts)))
    plain = ["".join(c.lower() if c.isalnum() else " " for c in t) for t in texts]
    assert [len(set(feature[row == k].tolist())) for k in range(4)] == [len(grams(t)) for t in plain]
    assert np.isclose(toxicity.log_ratio(np.array([3.0]), np.array([4.0]), 5, 20)[0], np.log((4 / 7) / (2 / 17)))
    weight = np.zeros(1 << toxicity.BITS)
    weight[feature] = np.linspace(-1, 1, len(feature))
    model = toxicity.Model(weight, 0.25)
    want = [1 / (1 + np.exp(-(sum(weight[f] for f in set(feature[row == k].tolist())) + 0.25))) for k in range(4)]
    assert np.allclose(model.scores(*utf8(pa.array(texts))), want)
    n = 400
    toxic = np.arange(n) % 2 == 0
    own = [np.array([k // 2 + 1000 * int(t)], "<i4") for k, t in enumerate(toxic)]
    chosen = np.unique(np.concatenate(own)).astype(np.int64)
    fitted = toxicity.fit(chosen, np.where(chosen < 1000, -1.0, 1.0), own, toxic.astype(float), np.ones(n))
    assert all((fitted.weight[f[0]] > 0) == t for f, t in zip(own, toxic, strict=True))


def test_urls(spark):
    rows = [(1, "http://A.example.NET/en/1?x=1"), (2, "https://example.net/de/1"), (3, "http://q.org/fr/"), (4, "http://q.org"),
            (5, None), (6, "no host"), (7, "ftp://example.com/de/x#y"), (8, "http://notexample.com/de/1"), (9, "x://?://y/z"), (7, "ftp://example.com/de/x#y")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages).collect()}
    assert [got[k]["rule"] for k in range(1, 10)] == ["example.net/en/", "net/", "org/fr/", None, None, None, "example.com/de/", None, None]
    assert [got[k]["verdict"] for k in (1, 2, 3, 7)] == ["allow", "block", "allow", "block"]
    assert (got[1]["host"], got[1]["path"]) == ("a.example.net", "/en/1") and (got[6]["host"], got[6]["path"]) == ("", "")
    assert (got[9]["host"], got[9]["path"], got[4]["path"]) == ("", "", "")
    assert all(got[k]["verdict"] in ("allow", "block") for k in got) and url_filter.judge_urls(pages.limit(0)).count() == 0


def test_trees_learn_from_lexical_features(spark):
    draw = random.Random(11)
    rows = []
    for k in range(600):
        bad = draw.random() < 0.5
        rows.append((k, f"http://{'9' * draw.randint(5, 9) if bad else 'w'}{k % 7}.site.com/{'a/' * draw.randint(0, 3)}", int(bad)))
    host, path = url_filter.host_and_path(url_filter.F.col("url"))
    df = spark.createDataFrame(rows, "page_id long, url string, label int").withColumns({"host": host, "path": path})
    model = url_filter.train(df, url_filter.F.col("label"))
    named = model.features(*(url_filter.F.col(c) for c in ("url", "host", "path")))
    right = df.withColumns(named).withColumn("p", model.score({f: url_filter.F.col(f) for f in named}))
    assert right.filter("(p >= 0.5) = (label = 1)").count() > 580


def test_every_suffix_has_a_share_and_a_hot_url_leaves_room(spark):
    """300 sites that differ in nothing but the share of blocked URLs, and one URL that makes up half of the rows."""
    rows = [(f"http://s{100 + k}.com/{j}", k % 2) for k in range(300) for j in range(5)] + [("http://s100.com/0", 0)] * 1500
    host, path = url_filter.host_and_path(url_filter.F.col("url"))
    df = spark.createDataFrame(rows, "url string, label int").withColumns({"host": host, "path": path})
    model = url_filter.train(df, url_filter.F.col("label"), max_rows=1000)
    assert model.second.table.count() == 300
    named = model.features(*(url_filter.F.col(c) for c in ("url", "host", "path")))
    right = df.dropDuplicates(["url"]).withColumns(named).withColumn("p", model.score({f: url_filter.F.col(f) for f in named}))
    assert right.filter("(p >= 0.5) = (label = 1)").count() == 1500


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_pipeline_against_single_stages(spark):
    """Each stage works on what its predecessor kept; a brute-force run gives the same documents."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    fine = quality.repetition(docs).filter("kept").collect()
    rows = {r["doc_id"]: rows[r["doc_id"]] or "" for r in fine}
    holders = defaultdict(set)

    def key(line):
        return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})

    for i, text in rows.items():
        for line in text.split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    rows = {i: "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i) for i, t in rows.items()}
    sets = {i: _shingles(t) for i, t in rows.items()}
    parent = {i: i for i in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in rows:
        for j in rows:
            if j < i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    rows = {i: t for i, t in rows.items() if root(i) == i}
    stage = docs
    for name, step in corpus_pipeline.STAGES[:3]:
        stage = step(spark, stage, FOLDER)
        assert stage.columns == docs.columns, name
    got = {r["doc_id"]: r["text"] for r in stage.collect()}
    assert got == rows
    assert all(r["n_chars"] == len(r["text"]) for r in stage.collect())
    clean = corpus_pipeline.decontamination(spark, stage, FOLDER)
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in clean.collect()}


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_pipeline_pieces_against_windows_and_library(spark):
    """Decontamination by plain windows of 13 words, and every piece of run() by the library's ids."""
    stage = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:3]:
        stage = step(spark, stage, FOLDER)
    texts = {r["doc_id"]: r["text"] or "" for r in stage.collect()}

    def words(text):
        return re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())

    asked = defaultdict(set)
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        own = words(r["text"] or "")
        size = min(13, len(own))
        if r["item_id"] is not None and own:
            asked[size] |= {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}
    clean = {}
    for i, text in texts.items():
        own, hit = words(text), set()
        for size, windows in asked.items():
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
        if not (hit and 20 * len(hit) >= len(own)):
            clean[i] = text
    assert 0 < len(clean) < len(texts)
    library = _library("word_bpe_49k.json")
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in clean.items()}
    parts, sequences = defaultdict(list), defaultdict(list)
    for p in corpus_pipeline.run(spark, FOLDER).collect():
        parts[p["doc_id"]].append((p["start"], p["length"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        own = ids[p["doc_id"]]
        assert p["length"] > 0 and p["doc_tokens"] == len(own)
        assert p["ids_crc32"] == zlib.crc32(np.array(own[p["start"] : p["start"] + p["length"]], "<u4").tobytes())
    assert parts.keys() == ids.keys()
    gapless = [(v, len(ids[i])) for i, v in parts.items()] + [(v, None) for v in sequences.values()]
    for runs, total in gapless:
        at = 0
        for start, length in sorted(runs):
            assert start == at
            at += length
        assert at == total or total is None and at <= 2048


ADDED = ["Kept", "n_words", "N_Lines", "n_dropped", "Contaminated", "item_ids", "BEGINS", "class_id", "text_key", "row", "words", "_doc_id", "keep"]


def test_pipeline_keeps_columns_whatever_they_are_called(spark):
    """Every stage returns the columns of its input as they are, also where an operator adds one of that name in another case."""
    rows = [(i, t, *[f"{c}{i}" for c in ADDED]) for i, t in ROWS]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'{c} string' for c in ADDED)}").repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, FOLDER)
        assert got.columns == ["doc_id", "text", *ADDED], name
        for r in got.collect():
            assert tuple(r)[2:] == tuple(f"{c}{r['doc_id']}" for c in ADDED), name
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs, FOLDER).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_pipeline_of_nothing_and_of_nulls(spark, tmp_path):
    for name, rows in (("none", []), ("nulls", [(None, None), (1, None), (2, ""), (2, "")])):
        folder = tmp_path / name
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        assert corpus_pipeline.run(spark, str(folder)).count() == 0
