"""Sum-of-squares online packing of documents into windows of a fixed number of tokens.

A document's full windows are sequences of their own. What remains is placed at once, into the fill
level that leaves the smallest sum of squared counts of partly filled windows; the counts per level are one
array. Each task packs the rows of its partition and keeps nothing but its open windows, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import batch_of, blocks, ship
from signalyard.llm.tokenizers_io import word_ids

# A task that holds more open windows than this closes them by cutting pieces.
OPEN_WINDOWS = 4096
# Sequence ids count from the task's partition number times this.
SEQUENCES_PER_TASK = 1 << 32

Piece = tuple[int | None, int, bytes, int]  # doc_id, start, ids, doc_tokens


class Packer:
    """Online packing of items smaller than a window; ``closed`` gets each finished window."""

    def __init__(self, size: int, most_open: int = OPEN_WINDOWS):
        self.size, self.most_open = size, most_open
        self.closed: list[list[Piece]] = []
        self.open = 0
        self._count = np.zeros(size + 1, np.int64)  # open windows per fill level
        self._at: dict[int, list[list[Piece]]] = {}

    def level_for(self, need: int) -> int:
        """The fill level (0: a new window) whose choice gives the least sum of squared counts."""
        last = self.size - need
        here, there = self._count[: last + 1], self._count[need:]
        change = 2 * (there - here) + 2
        change[0] = 2 * there[0] + 1
        change[last] = 1 - 2 * here[last]  # a full window counts no more
        change[1:][here[1:] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))  # ties: the fullest

    def add(self, piece: Piece) -> None:
        need = len(piece[2]) // 4
        level = self.level_for(need)
        window: list[Piece] = []
        if level:
            window = self._at[level].pop()
            self._count[level] -= 1
            self.open -= 1
        window.append(piece)
        if level + need == self.size:
            self.closed.append(window)
            return
        self._at.setdefault(level + need, []).append(window)
        self._count[level + need] += 1
        self.open += 1
        if self.open > self.most_open:
            self.close()

    def close(self) -> None:
        """Close all open windows: fill one with the pieces of the next, cut where it is full."""
        rest = [w for level in sorted(self._at, reverse=True) for w in self._at[level]]
        self._at.clear()
        self._count[:] = 0
        self.open = 0
        window, free = [], self.size
        for doc_id, start, ids, total in (p for w in rest for p in w):
            while ids:
                part, ids = ids[: 4 * free], ids[4 * free :]
                window.append((doc_id, start, part, total))
                start += len(part) // 4
                free -= len(part) // 4
                if not free:
                    self.closed.append(window)
                    window, free = [], self.size
        if window:
            self.closed.append(window)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ]
)
_DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit integers. A document is the ids of its whole text and
    ``end_id``; a null or empty text is ``end_id`` alone. Every id lies in exactly one piece. All sequences of a task
    are full but the last it closes (and, past ``OPEN_WINDOWS`` open windows, one more each time).
    A null id stays null; rows that share an id are documents of their own; other columns are not read.
    """
    ship(docs.sparkSession)
    end = np.asarray([end_id], "<u4").tobytes()

    def rows(windows: list[list[Piece]], first: int) -> pa.RecordBatch:
        out = {name: [] for name in _OUT.names}
        for number, window in enumerate(windows, first):
            offset = 0
            for doc_id, start, ids, total in window:
                length = len(ids) // 4
                for name, value in zip(_OUT.names, (doc_id, start, length, ids, total, number, offset), strict=True):
                    out[name].append(value)
                offset += length
        return batch_of(_OUT, **out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(vocabulary).encode
        packer = Packer(size)
        number = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        for block in blocks(batches):
            known = zip(block.column("doc_id").to_pylist(), encode(block.column("text")), strict=True)
            for doc_id, ids in known:
                ids += end
                total = len(ids) // 4
                whole = total - total % size
                for start in range(0, whole, size):
                    packer.closed.append([(doc_id, start, ids[4 * start : 4 * (start + size)], total)])
                if whole < total:
                    packer.add((doc_id, whole, ids[4 * whole :], total))
            if packer.closed:
                yield rows(packer.closed, number)
                number += len(packer.closed)
                packer.closed = []
        packer.close()
        if packer.closed:
            yield rows(packer.closed, number)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DDL)
