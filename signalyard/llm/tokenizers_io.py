"""Token ids of whole texts, as the ``tokenizers`` library gives them, at the cost of its distinct words."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa

from signalyard.llm.common import Rolling, utf8

# Distinct words whose ids a Python worker remembers; beyond it the memory starts anew.
REMEMBERED = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Lead bytes of U+0300 and beyond: combining marks, and letters that fold by context.
_RARE_LEAD = 0xCC
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[ord("a") : ord("z") + 1] = True
# Punctuation, apostrophes aside: they may belong to a contraction.
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LATIN = 0xC3  # lead byte of U+00C0 to U+00FF


class _Table:
    """Numbers for 64-bit hashes: open addressing in two numpy arrays, many hashes at a time."""

    def __init__(self, most: int):
        self.used = 0
        self._make(max(10, int(2 * most).bit_length()))

    def _make(self, bits: int) -> None:
        self._bits = bits
        self._hash = np.zeros(1 << bits, np.uint64)
        self._number = np.full(1 << bits, -1, np.int32)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 if it has none."""
        out = np.full(len(hashes), -1, np.int32)
        live, slot = np.arange(len(hashes)), self._slot(hashes)
        while len(live):
            number = self._number[slot]
            same = (self._hash[slot] == hashes[live]) & (number >= 0)
            out[live[same]] = number[same]
            on = ~same & (number >= 0)
            live, slot = live[on], (slot[on] + 1) & ((1 << self._bits) - 1)
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct new hashes in their order."""
        if self.used + len(hashes) > 0.6 * len(self._hash):
            filled = self._number >= 0
            old = self._hash[filled][np.argsort(self._number[filled])]
            self.used = 0
            self._make(int(2 * (len(old) + len(hashes))).bit_length())
            self.add(old)
        number = np.arange(self.used, self.used + len(hashes), dtype=np.int32)
        self.used += len(hashes)
        slot = self._slot(hashes)
        while len(hashes):
            free = self._number[slot] < 0
            _, first = np.unique(slot, return_index=True)
            placed = np.zeros(len(slot), bool)
            placed[first] = True
            placed &= free
            self._hash[slot[placed]], self._number[slot[placed]] = hashes[placed], number[placed]
            hashes, number = hashes[~placed], number[~placed]
            slot = (slot[~placed] + 1) & ((1 << self._bits) - 1)


class WordIds:
    """Ids of texts for a vocabulary that drops white space, put together from the ids of their words.

    The vocabulary's normalizer and pre-tokenizer never join anything across white space, so the ids of a
    text are those of its words in order, and each distinct word goes to the library once. Words are
    found and told apart (by a 64-bit hash) in numpy, a block of texts at a time. In texts below U+0300 without special
    tokens letters are lower-cased first (the normalizer does so anyway) and punctuation is set apart from the
    letter before it (the pre-tokenizer cuts there anyway), which leaves fewer distinct words.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        ids = self._library.get_vocab()
        self.size = max(ids.values()) + 1
        self._ends = np.zeros(self.size, bool)
        self._ends[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        self._remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self._table = _Table(self._remembered)
        self._ids = np.zeros(0, np.uint32)  # of all words, one after another
        self._starts = self._sizes = np.zeros(0, np.int64)  # by word number

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts together, and how many each has."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        found = [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(f) for f in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only: one pre-token each, whose last id ends a word."""
        ids, _ = self._whole([" ".join(words)])
        stops = np.flatnonzero(self._ends[ids]) + 1
        return (ids, np.diff(stops, prepend=0)) if len(stops) == len(words) else self._whole(words)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        self._table.add(hashes)
        plain = np.fromiter((w.isalpha() for w in words), bool, len(words))
        ids, sizes = [self._ids], np.zeros(len(words), np.int64)
        starts, at = np.zeros(len(words), np.int64), len(self._ids)
        for which, encode in ((plain, self._letters), (~plain, self._whole)):
            where = np.flatnonzero(which)
            more, sizes[where] = encode([words[k] for k in where.tolist()])
            starts[where] = at + np.cumsum(sizes[where]) - sizes[where]
            at += len(more)
            ids.append(more)
        self._ids = np.concatenate(ids)
        self._starts = np.concatenate([self._starts, starts])
        self._sizes = np.concatenate([self._sizes, sizes])

    @staticmethod
    def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block's bytes, folded where that is safe, and the begin and end of each word."""
        first = np.zeros(len(data) + 1, bool)
        first[starts] = True
        folded = _FOLD[data]
        latin = np.flatnonzero(data == _LATIN) + 1
        upper = latin[(data[latin] <= 0x9E) & (data[latin] != 0x97)]
        folded[upper] += 32
        letter = _ASCII_LETTER[folded]
        letter[latin[(data[latin] != 0x97) & (data[latin] != 0xB7)]] = True
        mark = _MARK[data]
        special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
        odd = np.unique(np.searchsorted(starts, np.concatenate([special, np.flatnonzero(data >= _RARE_LEAD)]), "right") - 1)
        for row in odd.tolist():
            own = slice(starts[row], starts[row + 1])
            folded[own] = data[own]
            mark[own] = False
        inside = ~_SPACE[data]
        no = np.zeros(1, bool)
        begins = inside & (np.concatenate([~no, ~inside[:-1]]) | first[:-1] | (np.concatenate([no, letter[:-1]]) & mark))
        ends = inside & (np.concatenate([~inside[1:], ~no]) | first[1:] | np.concatenate([begins[1:], no]))
        return folded, np.flatnonzero(begins), np.flatnonzero(ends) + 1

    def encode(self, column: pa.Array) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers; a null text has none."""
        data, starts = utf8(column)
        if not len(data):
            return [b""] * len(column)
        if self._table.used > self._remembered:
            self._forget()
        folded, begin, end = self._words(data, starts)
        hashes = Rolling.of_bytes(folded).runs(begin, end)
        word = self._table.find(hashes)
        missing = np.flatnonzero(word < 0)
        if len(missing):
            new, at = np.unique(hashes[missing], return_index=True)
            raw, where = folded.tobytes(), missing[at]
            self._learn(new, [raw[a:b].decode() for a, b in zip(begin[where].tolist(), end[where].tolist(), strict=True)])
            word[missing] = self._table.find(hashes[missing])
        sizes = self._sizes[word]
        after = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(self._starts[word] - after[:-1], sizes) + np.arange(after[-1])
        packed = self._ids[place].astype("<u4").tobytes()
        upto = (4 * after[np.searchsorted(begin, starts)]).tolist()
        return [packed[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]

    def encode_texts(self, texts: Sequence[str | None]) -> list[bytes]:
        return self.encode(pa.array(texts, pa.string()))


@cache
def word_ids(path: str) -> WordIds:
    """One per Python worker, so that what it has learned serves the next task."""
    return WordIds(path)
