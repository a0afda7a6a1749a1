"""Pure numpy parts against plain Python."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("signalyard.llm")
public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from signalyard.llm import common  # noqa: E402
from signalyard.llm import decontaminate as dc  # noqa: E402
from signalyard.llm import line_dedup, minhash, packing, quality, token_files, warc  # noqa: E402
from signalyard.llm.common import Rolling, blocks, repeated, utf8  # noqa: E402
from signalyard.llm.token_counts import MergeCounter  # noqa: E402
from signalyard.llm.tokenizers_io import WordIds, _Table  # noqa: E402

PIECES = (
    "aB é É Σ ς İ ß . , ' $ ! \n \t \x1c \x85 1 2 ½ ² ̈ ǰ <|endoftext|> <|startoftext|> — … » don't I'LL 's 日本 ٣ _ a.b x,y aaaa"
).split(" ") + [" ", "  "]


def _texts(n: int, seed: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("remembered", [40, 100_000])
def test_word_ids_are_those_of_the_library(remembered):
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    ours, library = WordIds(path, remembered), tokenizers.Tokenizer.from_file(path)
    texts = _texts(3000, 1)
    for begin in range(0, len(texts), 100):
        part = texts[begin : begin + 100]
        got = [np.frombuffer(b, "<u4").tolist() for b in ours.encode_texts([None, *part])]
        assert got == [[], *[library.encode(t, add_special_tokens=False).ids for t in part]]


def test_merge_counts_are_those_of_the_library():
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    ours, library = MergeCounter(path), tokenizers.Tokenizer.from_file(path)
    texts = [*_texts(2000, 2), "x" * 3000, "ab " * 500, ""]
    plain = [all(ord(c) < 0x500 for c in t) for t in texts]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ours.count(texts, plain).tolist() == want


def test_table_grows():
    table, hashes = _Table(8), np.unique(np.random.default_rng(3).integers(1, 2**63, 4000).astype(np.uint64))
    for k in range(0, len(hashes), 333):
        table.add(hashes[k : k + 333])
    assert (table.find(hashes) == np.arange(len(hashes))).all()
    assert (table.find(hashes + np.uint64(1)) == -1).all()


def test_repeated_and_rolling():
    values = np.array([5, 1, 5, 2, 1, 9], np.uint64)
    assert repeated(values).tolist() == [True, True, True, False, True, False]
    text = np.frombuffer(b"abcabcab", np.uint8)
    found = Rolling.of_bytes(text).grams(3)
    assert found[0] == found[3] and found[1] == found[4] and len(set(found.tolist())) == 3


def test_blocks_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 50, "", "c" * 3]})
    parts = [b.column("text").to_pylist() for b in blocks([batch], limit=12)]
    assert sum(parts, []) == batch.column("text").to_pylist() and len(parts) > 2


def test_quality_counts_by_hand():
    texts = [None, "", "\n\n", "a b c\na b c\n \nx #|", "é é é é"]
    got = quality.measure(*utf8(pa.array(texts, pa.string())), (5,))
    assert got["n_words"].tolist() == [0, 0, 0, 8, 4]
    assert got["word_chars"].tolist() == [0, 0, 0, 9, 4]
    assert got["n_symbols"].tolist() == [0, 0, 0, 2, 0]
    assert got["n_dup_lines"].tolist() == [0, 0, 0, 1, 0]
    assert got["n_repeat_words"].tolist() == [0, 0, 0, 6, 4]
    assert got["dup_line_chars"].tolist() == [0, 0, 0, 6, 0]


def test_fm_index_finds_all_windows():
    draw = random.Random(4)
    items = [(1, "a b c a"), (2, "B c"), (3, "a b"), (4, "..."), (2, "b C")]
    queries = dc.Queries.of(items, 3)
    docs = [" ".join(draw.choice("abcdx") for _ in range(draw.randint(0, 40))) for _ in range(200)] + ["", "b c a b c a"]
    words, hashes = dc.hashed_words(*utf8(pa.array(docs)))
    symbols = np.zeros(len(hashes) + len(docs), np.int32)
    symbols[np.arange(len(hashes)) + words.row] = queries.symbols(hashes)
    starts = np.concatenate([[0], np.cumsum(np.diff(words.starts) + 1)])
    got = dc.scan_shard(symbols, starts, queries)
    windows = [(i, w[k : k + n]) for i, t in items for w in [re.findall("[a-z]+", t.lower())] for n in [min(3, len(w))]
               for k in range(len(w) - n + 1) if n]
    for k, text in enumerate(docs):
        own = text.split()
        hit, found = set(), set()
        for item, w in windows:
            for at in range(len(own) - len(w) + 1):
                if own[at : at + len(w)] == w:
                    found.add(item)
                    hit |= set(range(at, at + len(w)))
        assert got["n_hit"][k].as_py() == len(hit) and got["item_ids"][k].as_py() == sorted(found)
        spans = zip(got["begins"][k].as_py(), got["ends"][k].as_py(), strict=True)
        assert {i for b, e in spans for i in range(b, e)} == hit


def test_suffix_array():
    draw = random.Random(5)
    for _ in range(30):
        text = np.array([draw.randint(0, 3) for _ in range(draw.randint(1, 60))] + [0], np.int32)
        key = [(0, i) if v == 0 else (1, v) for i, v in enumerate(text.tolist())]
        want = sorted(range(len(text)), key=lambda i: key[i:])
        assert dc.suffix_array(text).tolist() == want


@pytest.mark.parametrize("base", [300, 70_000])
def test_re_pair_round_trip(base):
    draw = random.Random(6)
    docs = [[draw.choice([1, 2, 3, 299]) for _ in range(draw.randint(0, 300))] for _ in range(60)] + [[7] * 101]
    packed = [np.array(d, "<u4").tobytes() for d in docs]
    data = token_files.shard_bytes([None, *range(60)], packed, base)
    n = int.from_bytes(data[4:8], "little")
    import json

    shard = token_files.Shard(json.loads(data[12 : 12 + n]), data[12 + n :])
    assert shard.documents() == packed and shard.doc_ids[:2] == [None, 0]
    assert shard.document(60).tolist() == [7] * 101 and shard.document(5).tolist() == docs[5]
    assert len(data) < sum(map(len, packed))
    broken = bytearray(data[12 + n :])
    broken[-1] ^= 1
    with pytest.raises(ValueError):
        token_files.Shard(json.loads(data[12 : 12 + n]), bytes(broken))


def test_packer_places_every_id_once():
    draw = random.Random(7)
    for most_open in (3, 1000):
        packer, want = packing.Packer(16, most_open), {}
        for doc in range(300):
            size = draw.randint(1, 15)
            want[doc] = np.arange(size, dtype="<u4").tobytes()
            packer.add((doc, 0, want[doc], size))
        packer.close()
        got = {}
        for window in packer.closed:
            assert sum(len(p[2]) for p in window) <= 64
            for doc, start, ids, _ in window:
                got.setdefault(doc, {})[start] = ids
        assert {d: b"".join(v[k] for k in sorted(v)) for d, v in got.items()} == want
        assert sum(sum(len(p[2]) for p in w) < 64 for w in packer.closed) <= (1 if most_open > 300 else 300)


def test_sum_of_squares_choice():
    packer = packing.Packer(10)
    for size in (6, 6, 4):
        packer.add((size, 0, b"\0" * 4 * size, size))
    # The first two differ in nothing: 2 windows of 6 cost 4, and 4 fills one of them.
    assert len(packer.closed) == 1 and packer.open == 1


def test_signatures_estimate_similarity():
    draw = random.Random(8)
    words = [f"w{draw.randint(0, 10**6)}" for _ in range(400)]
    texts = [" ".join(words), " ".join(words[:360]), "one two", None, "same"]
    row, value, count, key = minhash.shingle_sets(*utf8(pa.array(texts, pa.string())))
    assert (np.diff(key.astype(object)) > 0).all() and np.bincount(row, minlength=5).tolist() == [396, 356, 1, 0, 1]
    found = minhash.signatures(row, value, np.ones(len(row)), 5, 512)
    assert abs((found[0] == found[1]).mean() - 356 / 396) < 0.06
    assert not found[3].any() and len(set(found[2].tolist())) == 1


def test_keep_bitmaps():
    for lost in ([0], [7], [8], [0, 3, 17]):
        flags = line_dedup.keep_flags(line_dedup.pack_keep(lost), 20)
        assert np.flatnonzero(~flags).tolist() == lost
    assert line_dedup.keep_flags(None, 2).all()


def test_warc_record_parses_back():
    data = warc.record(5, 0, "http://x/\r\nEvil: 1", b"<p>\r\n\r\n</p>", "d" * 40, None)
    headers, block = warc.parse(data)
    assert headers["WARC-Type"] == "response" and block.endswith(b"<p>\r\n\r\n</p>") and "Evil" not in headers
    headers, block = warc.parse(warc.record(None, 2, None, b"x" * 9, "e" * 40, 7))
    assert headers["WARC-Refers-To"] == f"<urn:page:7:{'e' * 40}:0>" and headers["WARC-Truncated"] == "length"
    assert zlib.crc32(block) == zlib.crc32(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")


def _thue_morse(n: int) -> tuple[str, str]:
    """A word and its complement, equal under every polynomial hash modulo 2^64."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_rolling_is_a_polynomial_modulo_the_prime():
    draw = np.random.default_rng(5)
    data = draw.integers(0, 256, 3000).astype(np.uint8)
    prime, values = int(common._PRIME), common._symbols()[data].tolist()

    def plain(begin, end):
        total = 0
        for k in reversed(range(begin, end)):
            total = (total * common._BASE + values[k]) % prime
        mask = (1 << 64) - 1
        return int(common.mix(np.array([(total + (end - begin) * 0x8EBC6AF09C88C6E3) & mask], np.uint64))[0])

    begin = draw.integers(0, 2000, 50)
    end = begin + draw.integers(0, 1000, 50)
    got = Rolling.of_bytes(data).runs(begin, end)
    assert got.tolist() == [plain(int(a), int(b)) for a, b in zip(begin, end, strict=True)]


def test_thue_morse_words_differ():
    one, two = _thue_morse(2048)
    data, starts = utf8(pa.array([one, two, one]))
    a, b, c = Rolling.of_bytes(data).runs(starts[:-1], starts[1:]).tolist()
    assert a == c != b
    by_word = Rolling(np.array([a, b, a], np.uint64)).grams(1)
    assert by_word[0] == by_word[2] != by_word[1]
    counts = quality.measure(*utf8(pa.array([f"{one}\n{two}"])), (5,))
    assert counts["n_dup_lines"].tolist() == [0]
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    library = tokenizers.Tokenizer.from_file(path)
    ids = [np.frombuffer(b, "<u4").tolist() for b in WordIds(path).encode_texts([one, two])]
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in (one, two)]
    _, hashes = dc.hashed_words(data, starts)
    assert len(set(hashes.tolist())) == 2
