"""Byte-pair token counts by rank-synchronous merging of ragged numpy arrays.

A batch of pre-tokens is one flat array of symbols. In each round every pre-token finds its lowest-ranked
pair and merges all its occurrences, all pre-tokens at once; a pre-token without a ranked pair is done and
counts what is left of it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import batch_of, blocks, ship, utf8

# The vocabulary's own split of a text into pre-tokens. Fixed value.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Pre-tokens whose counts a Python worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000
# First byte of a code point from U+0500 on. Below it, all versions of Unicode class letters and digits alike.
_LATER_LETTERS = 0xD4


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


class MergeCounter:
    """Token counts for a byte-level vocabulary file with merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        ids = stored["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in stored["model"]["merges"]]
        self._size = np.int64(len(ids) + 1)
        key = np.array([ids[a] * int(self._size) + ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self._key, self._rank, self._made = key[order], order.astype(np.int64), made[order]
        self._none = np.int64(len(pairs))
        self._first = np.array([ids[s] for s in _byte_symbols()], np.int64)
        self._special = [t["content"] for t in stored["added_tokens"]]
        self._cut = regex.compile("|".join(map(regex.escape, self._special))) if self._special else None
        self._find = regex.compile(PRE_TOKEN).findall
        self._known: dict[str, int] = {}
        self._path, self._library = path, None

    def merged(self, tokens: Sequence[bytes]) -> np.ndarray:
        """How many symbols of each pre-token survive all merges."""
        sizes = np.array([len(t) for t in tokens], np.int64)
        symbol = self._first[np.frombuffer(b"".join(tokens), np.uint8)]
        out = sizes.copy()
        owner = np.repeat(np.arange(len(tokens)), sizes)
        while len(symbol) > 1:
            rank = np.full(len(symbol), self._none)  # of the pair that begins here
            inner = np.flatnonzero(owner[:-1] == owner[1:])
            key = symbol[inner] * self._size + symbol[inner + 1]
            place = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
            known = self._key[place] == key
            pair = np.zeros(len(symbol), np.int64)
            rank[inner[known]] = self._rank[place[known]]
            pair[inner[known]] = self._made[place[known]]
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            length = np.diff(np.append(heads, len(symbol)))
            lowest = np.repeat(np.minimum.reduceat(rank, heads), length)
            chosen = (rank == lowest) & (rank < self._none)
            # In a run such as "aaa" the occurrences overlap: every other one counts, from the left.
            at = np.flatnonzero(chosen)
            if not len(at):
                break
            opens = np.concatenate([[True], np.diff(at) != 1])
            run = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbol[at] = pair[at]
            gone = np.zeros(len(symbol), bool)
            gone[at + 1] = True
            np.subtract.at(out, owner[at], 1)
            stay = ~gone & (lowest < self._none)
            symbol, owner = symbol[stay], owner[stay]
        return out

    def _pre_tokens(self, text: str, plain: bool) -> tuple[list, int]:
        """Pre-tokens of a text, and how many special tokens stand between them."""
        parts = [text]
        if self._cut is not None and any(s in text for s in self._special):
            parts = self._cut.split(text)
        if plain:
            found = [t for p in parts for t in self._find(p)] if len(parts) > 1 else self._find(text)
        else:
            found = [t for p in parts for t in self._split_by_library(p)]
        return found, len(parts) - 1

    def _split_by_library(self, text: str) -> list[str]:
        """For rare scripts, whose letters differ between versions of Unicode: where the library cuts."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def count(self, texts: Sequence[str | None], plain: Sequence[bool]) -> np.ndarray:
        """Tokens of each text. ``plain``: the text has no letters beyond U+0500."""
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        found = [self._pre_tokens(t or "", p) for t, p in zip(texts, plain, strict=True)]
        new = list(set().union(*(tokens for tokens, _ in found)) - known.keys())
        if new:
            known.update(zip(new, self.merged([t.encode() for t in new]).tolist(), strict=True))
        look = known.__getitem__
        return np.array([sum(map(look, tokens)) + special for tokens, special in found], np.int64)


@cache
def counter(path: str) -> MergeCounter:
    """One per Python worker, so that what it has learned serves the next task."""
    return MergeCounter(path)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) per row; no shuffle.

    ``vocabulary`` is the path of a byte-level vocabulary file that every machine can read. A null or
    empty text has no tokens; a null id stays null; repeated rows are counted one by one; other columns are
    not read. A text is never cut, whatever its length.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for block in blocks(batches):
            data, starts = utf8(block.column("text"))
            later = np.concatenate([[0], np.cumsum(data >= _LATER_LETTERS)])
            plain = later[starts[1:]] == later[starts[:-1]]
            yield batch_of(
                _OUT,
                doc_id=block.column("doc_id"),
                n_bytes=np.diff(starts),
                n_tokens=count(block.column("text").to_pylist(), plain.tolist()),
            )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = ids.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
