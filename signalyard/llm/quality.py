"""Repetition rules: how much of a text lies in repeated n-grams and repeated lines.

Rolling hashes of words give the hash of every n-gram of a whole Arrow block in a few numpy passes;
there is no loop over documents, words or n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import Rolling, Words, batch_of, blocks, mix, repeated, ship, sums_by, utf8

# Largest share, in percent of a text's word characters, that may lie in n-grams of so many words
# found at least twice (all their occurrences count), and in lines found at least twice: the published limits of the
# Gopher corpus. Words in such n-grams also count for the base rule, so limits near its half would never be met.
GRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_LIMIT = 20

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _gram_column(n: int) -> str:
    return f"dup_chars_{n}"


def measure(data: np.ndarray, starts: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """All counts for the rows of one block."""
    words = Words(data, starts)
    point = (data & 0xC0) != 0x80  # bytes that begin a code point
    chars = np.concatenate([np.zeros(1, np.int64), np.cumsum(point & words.inside)])
    word_chars = chars[words.end] - chars[words.begin]
    out = {
        "n_words": np.diff(words.starts),
        "word_chars": sums_by(words.starts, word_chars),
        "n_symbols": sums_by(starts, _SYMBOL[data]),
    }
    rolling = Rolling.of_bytes(data)
    by_word = Rolling(rolling.runs(words.begin, words.end))
    salt = mix(np.arange(1, len(starts), dtype=np.uint64))

    def covered(n: int) -> np.ndarray:
        """Words inside an n-gram that its row holds at least twice."""
        whole = np.flatnonzero(words.windows(n))
        found = whole[repeated(by_word.grams(n)[whole] ^ salt[words.row[whole]])]
        edge = np.zeros(len(words) + 1, np.int32)
        edge[found] += 1
        edge[found + n] -= 1
        return np.cumsum(edge[:-1]) > 0

    out["n_repeat_words"] = sums_by(words.starts, covered(3))
    for n in lengths:
        out[_gram_column(n)] = sums_by(words.starts, np.where(covered(n), word_chars, 0))

    cut = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([starts[:-1], cut + 1]))
    # A line begins at each row's start and after each newline; one after a row's last byte belongs to that row.
    row = np.sort(np.concatenate([np.arange(len(starts) - 1), np.searchsorted(starts, cut, "right") - 1]))
    stop = np.sort(np.concatenate([cut, starts[1:]]))
    filled = np.flatnonzero(chars[stop] > chars[begin])
    row, begin, stop = row[filled], begin[filled], stop[filled]
    hashed = rolling.runs(begin, stop) ^ salt[row]
    again = repeated(hashed)
    where = np.flatnonzero(again)
    _, first = np.unique(hashed[where], return_index=True)
    later = again.copy()
    later[where[first]] = False
    n_rows = len(starts) - 1
    out["n_dup_lines"] = np.bincount(row[later], minlength=n_rows)
    out["dup_line_chars"] = np.bincount(
        row[again], weights=(chars[stop] - chars[begin])[again], minlength=n_rows
    ).astype(np.int64)
    return out


def repetition(
    docs: DataFrame,
    gram_limits: dict[int, int] | None = None,
    line_limit: int = LINE_LIMIT,
    min_words: int = 50,
    text: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with the counts below, ``base_failed`` and ``kept`` added; no shuffle.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars and dup_chars_<n>
    per length in ``gram_limits`` (long). A column of ``docs`` with such a name, in any case, is replaced. A null text has
    no words; a text without words, or with fewer than ``min_words``, fails the base rule. Texts are
    measured whole, whatever their length; repeated rows are judged one by one.
    """
    limits = dict(gram_limits or GRAM_LIMITS)
    ship(docs.sparkSession)
    counts = [*_COUNTS, *map(_gram_column, limits)]
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in counts)
    lengths = tuple(limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = measure(*utf8(block.column("text")), lengths)
            fields = [pa.field("row", block.schema.field("row").type), *[pa.field(c, pa.int64()) for c in counts]]
            yield batch_of(
                pa.schema(fields), row=block.column("row"), **{c: found[c].astype(np.int64) for c in counts}
            )

    measured = packed.mapInArrow(run, schema)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = 100 * F.col("dup_line_chars") <= line_limit * F.col("word_chars")
    for n, share in limits.items():
        fine &= 100 * F.col(_gram_column(n)) <= share * F.col("word_chars")
    added = [*counts, "base_failed", "kept"]
    judged = measured.withColumns({"base_failed": failed}).withColumn("kept", ~F.col("base_failed") & fine)
    return judged.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added], *added)
