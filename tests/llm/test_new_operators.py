"""Substring dedup, conversation repair and lexical search against plain Python, on tables with every awkward case."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("signalyard.llm")

from signalyard.llm import conversation_repair as cr  # noqa: E402
from signalyard.llm import lexical_search, queries, substring_dedup  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _texts(seed: int, n: int) -> list[str]:
    """Few different words, shared passages, copies, periodic and empty texts."""
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["é", "日本", "Ab.", "x\x1cy"]
    passages = [" ".join(draw.choice(words) for _ in range(draw.randint(15, 60))) for _ in range(6)]
    out = ["", " \n ", "one two", " ".join(["same"] * 50), "a b c " * 20, " ".join(["p q"] * 11)]
    for _ in range(n):
        parts = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 30)))]
        parts += [draw.choice(passages) for _ in range(draw.choice([0, 1, 1, 2]))]
        out.append(draw.choice([" ", "\n", "\t "]).join(parts))
    return out + draw.sample(out, n // 3) + [draw.choice(passages) + " " + draw.choice(passages)]


def _removed(rows: list[tuple[int | None, str | None]], length: int) -> list[tuple]:
    last = 2**63 - 1
    first: dict[tuple, tuple] = {}
    split = [(last if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for i, ws in split:
        for k in range(len(ws) - length + 1):
            w = tuple(ws[k : k + length])
            first[w] = min(first.get(w, (i, k)), (i, k))
    out = []
    for (i, ws), (doc_id, _) in zip(split, rows, strict=True):
        gone = set()
        for k in range(len(ws) - length + 1):
            if first[tuple(ws[k : k + length])] != (i, k):
                gone |= set(range(k, k + length))
        out.append((doc_id, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("length", "batch"), [(20, 10_000), (20, 7), (7, 50)])
def test_substring_dedup_is_that_of_all_windows(spark, monkeypatch, length, batch):
    monkeypatch.setattr(substring_dedup, "SENT_BYTES", 2000)
    texts = _texts(length, 80)
    rows = list(enumerate(texts)) + [(None, texts[9]), (None, None), (3, texts[12]), (3, texts[12]), (200, texts[30] + " tail"), (-5, texts[20])]
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.createDataFrame([(*r, "r", 4, "p") for r in rows], "doc_id long, text string, row string, N_Words long, parts string")
        done = substring_dedup.remove_repeats(df.repartition(5), length)
        assert done.columns == ["doc_id", "text", "row", "N_Words_in", "parts", "n_words", "n_removed"]
        got = done.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert {(r["row"], r["N_Words_in"], r["parts"]) for r in got} == {("r", 4, "p")}
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got), key=repr) == _removed(rows, length)


def test_substring_dedup_of_nothing_and_of_a_very_long_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.remove_repeats(none).count() == 0
    draw = random.Random(3)
    long = [f"x{draw.randint(0, 10**6)}" for _ in range(300_000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[1000:1100], "own"])), (3, " ".join([*long[-19:], "end"]))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (300_000, 0), 2: (101, 100), 3: (20, 0)}


def test_levels_double():
    assert substring_dedup.levels(20) == [5, 10, 20] and substring_dedup.levels(50) == [25, 50] and substring_dedup.levels(7) == [7]
    values = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 3, 11, 16, 200):
        want = [min(values[k : k + width]) for k in range(201 - width)]
        assert substring_dedup.sliding_min(values, width).tolist() == want


# --- conversations -------------------------------------------------------------------------------------------------


def _ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        filled = text.rstrip("\x20\t\n\x0b\x0c\r")
        if not filled:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if filled[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _cheapest(rows, faults):
    """Every edit of every row in turn, over all states; what remains is the least (cost, audit, lines)."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    @cache
    def best(k, state, inserted):
        found = [(0, "", ())] if k == len(rows) and state in ("", "a") else []
        if inserted < 2:
            for role, name in names.items():
                if (state, role) in steps:
                    cost, audit, lines = best(k, steps[state, role], inserted + 1)
                    found.append((cost + 3, "I" + audit, (f"{name}:", *lines)))
        if k < len(rows):
            _, role, text = rows[k]
            cost, audit, lines = best(k + 1, state, 0)
            found.append((cost + 4, "D" + audit, lines))
            if faults[k] not in ("blank", "duplicate"):
                extra = 3 * (faults[k] == "truncated")
                for kind, initial, name, price in (("K", role[:1], role, 0), *(("R", i, n, 3) for i, n in names.items())):
                    if (state, initial) in steps:
                        cost, audit, lines = best(k + 1, steps[state, initial], 0)
                        found.append((cost + price + extra, kind + audit, (f"{name}:{text}", *lines)))
        return min(found, default=(10**9, "", ()))

    return best(0, "", 0)


def _report(rows):
    rows = _ordered(rows)
    faults = _faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, audit, lines = _cheapest(rows, faults)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit), lines


def _talks(seed, n, most):
    draw = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "umpire", None]
    texts = ["Yes.", "No!", "And", "", " \n", "Why? ", "so\x0b", "Yes.", None] + [f"t{k}." for k in range(6)]
    rows = []
    for conv in range(n):
        for turn in range(draw.randint(0, most)):
            rows.append((None if conv == 3 else conv, draw.choice([turn, turn, turn, turn + 1, None]), draw.choice(roles), draw.choice(texts)))
    return rows


@pytest.mark.parametrize(("block", "fan", "most"), [(256, 64, 9), (4, 3, 40)])
def test_conversation_repair_is_the_cheapest(spark, monkeypatch, block, fan, most):
    monkeypatch.setattr(cr, "BLOCK", block)
    monkeypatch.setattr(cr, "FAN", fan)
    rows = _talks(most, 60, most)
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn, " " if role is None else role, " " if text is None else text))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, cost string, place int")
    report, repaired = cr.repair(df.repartition(4))
    got = {r["conv_id"]: tuple(r)[1:] for r in report.collect()}
    assert got == {conv: _report(talk)[0] for conv, talk in own.items()}
    lines = defaultdict(list)
    for r in sorted(repaired.collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        assert (r["edit"] == "I") == (r["text"] == "" and r["turn"] is None and r["edit"] == "I")
    want = {conv: list(_report(talk)[1]) for conv, talk in own.items()}
    assert {c: v for c, v in want.items() if v} == lines
    hashed = {r["conv_id"]: r["repaired_sha256"] for r in cr.digests(repaired).collect()}
    assert hashed == {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in lines.items()}


def test_one_split_gives_what_all_splits_give():
    """The chart of spans of 1, 2, 4, ... rows against a chart with every span and every split."""
    draw = np.random.default_rng(2)
    for n in (1, 2, 3, 5, 8, 11):
        kind = draw.integers(0, 12, n)
        spans = {(k, k + 1): (cr._LEAF_COSTS[[j]], cr._LEAF_AUDITS[[j]]) for k, j in enumerate(kind)}
        for size in range(2, n + 1):
            for at in range(n - size + 1):
                every = [cr.product(spans[at, mid], spans[mid, at + size]) for mid in range(at + 1, at + size)]
                cells = [min(zip((e[0][0, c] for e in every), (e[1][0, c] for e in every), strict=True)) for c in range(len(cr._CELLS))]
                spans[at, at + size] = (np.array([[c for c, _ in cells]], np.int64), np.array([[a for _, a in cells]], object))
        costs, audits = cr.parse((cr._LEAF_COSTS[kind], cr._LEAF_AUDITS[kind]), np.zeros(n, np.int64))
        assert (costs == spans[0, n][0]).all() and (audits == spans[0, n][1]).all()


def test_damage_and_a_conversation_without_rows(spark, tmp_path):
    rows = [(c, t, r, x) for c in range(60) for t, r, x in ((0, "user", "Hi? a"), (1, "assistant", "Yes. b!"))] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        chance = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        x = "" if chance == 1 else re.sub("[.!?]", "", x) if chance == 2 else x
        want += [(c, t, "user" if chance == 4 else r, x)] * {0: 0, 3: 2}.get(chance, 1)
    assert sorted(map(tuple, cr.damaged(df).collect()), key=repr) == sorted(want, key=repr)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert len(got) == 61 and None in got
    for c in {r[0] for r in rows}:
        talk = [w[1:] for w in want if w[0] == c]
        report, lines = _report(talk) if talk else ((0,) * 6 + ("",), ())
        assert tuple(got[c])[1:-1] == report
        assert got[c]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    report, repaired = cr.repair(df.limit(0))
    assert report.count() == 0 and repaired.count() == 0 and cr.digests(repaired).count() == 0


# --- search --------------------------------------------------------------------------------------------------------


def _fold(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _search(docs, items, k):
    terms = [(i, Counter(_fold(t))) for i, t in docs]
    held = [sum(c.values()) for _, c in terms]
    n_docs, total = sum(n > 0 for n in held), sum(held)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        own, scored = Counter(_fold(text)), []
        for (doc, c), n in zip(terms, held, strict=True):
            if not n:
                continue
            m = 75 + (25 * n * n_docs) // total
            score = 0
            for t, times in own.items():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += times * w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("pass_terms", "most", "k"), [(200_000, 2048, 20), (60, 16, 5)])
def test_search_ranks_as_all_documents_would(spark, monkeypatch, pass_terms, most, k):
    monkeypatch.setattr(lexical_search, "MOST_DOCS", most)
    draw = random.Random(pass_terms)
    words = ["The", "the", "of", "Ünd", "日本", "a1", "B", "zz-top", "é"] + [f"v{int(40 * draw.random() ** 2)}" for _ in range(60)]
    docs = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 5, 30, 30, 80])))) for i in range(250)]
    docs += [(None, docs[40][1]), (None, None), (7, docs[7][1]), (300, docs[41][1]), (301, "the " * 20_000), (302, "!?")]
    items = [(q, " ".join(draw.choice(words) for _ in range(draw.randint(1, 14)))) for q in range(25)]
    items += [(3, items[3][1]), (90, None), (91, ""), (92, "nobody has this"), (None, "the of v1"), (93, " ".join(f"v{j}" for j in range(90)))]
    d = spark.createDataFrame([(*r, 1, "r") for r in docs], "doc_id long, text string, score int, rank string").repartition(4)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, score int")
    found = lexical_search.search(d, b, k, pass_terms)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect()), key=repr) == _search(docs, items, k)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in lexical_search.search(docs, items).collect()] == _search([(1, "a b")], [(1, "a")], 20)


def test_masks_below_the_best_are_not_scored():
    """Groups that cannot reach the k-th best are left out; those that tie with it are not."""
    texts = ["alpha beta"] * 3 + ["beta"] * 50 + ["gamma"] * 50
    items = lexical_search.Items.of(["alpha beta gamma"])
    found = lexical_search.Postings(pa.array(texts), items)
    m = np.full(len(texts), 100, np.int64)
    ranking = lexical_search.Ranking(1, 3)
    seen = []
    add = ranking.add
    ranking.add = lambda item, scores, ids: (seen.append(len(scores)), add(item, scores, ids))
    weights = np.array([1000, 10, 10], np.int64)[np.argsort(np.argsort(items.numbers(items.known)))]
    number = {t: int(items.numbers(lexical_search.hashed_words(*lexical_search.utf8(pa.array([t])))[1])[0]) for t in ("alpha", "beta", "gamma")}
    weights[number["alpha"]], weights[number["beta"]], weights[number["gamma"]] = 1000, 10, 10
    lexical_search.score_item(found, m, np.arange(len(texts)), items.terms[0], weights[items.terms[0]], 0, ranking)
    first = sum(seen)
    lexical_search.score_item(found, m, np.arange(len(texts)), items.terms[0], weights[items.terms[0]], 0, ranking)
    assert sum(seen) - first == 3 and ranking.ids[0].tolist() == [0, 0, 1]
