"""What the operators share: shipping the package, Arrow text blocks, polynomial hashes of byte runs."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that one numpy pass works on; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, so that tasks import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="signalyard-ship-")) / "signalyard.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((root / "signalyard").rglob("*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """Tells apart rows that share an id but not the text."""
    return F.xxhash64(text_of(column))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row starts (one more entry than rows); null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def blocks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches that hold at most ``limit`` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes.astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            used = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, used + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in schema)],
        schema=schema,
    )


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer: equal stays equal, everything else is spread evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E6C63D0876A9A47)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD1B54A32D192ED03)
        return x ^ (x >> np.uint64(32))


# Polynomial hashes are taken modulo the prime 2^61 - 1: modulo a power of two, known strings collide for every base.
_PRIME = np.uint64((1 << 61) - 1)
_BASE = 0x0D3C9A1F4B7E62C5
_LOW32, _LOW29 = np.uint64((1 << 32) - 1), np.uint64((1 << 29) - 1)
_CHUNK = 1 << 14
_S3, _S29, _S32, _S61 = (np.uint64(k) for k in (3, 29, 32, 61))


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit values modulo the prime; works in place."""
    over = x >> _S61
    x &= _PRIME
    x += over
    np.subtract(x, _PRIME, out=x, where=x >= _PRIME)
    return x


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values below it, from 32-bit halves."""
    ah, al = a >> _S32, a & _LOW32
    bh, bl = b >> _S32, b & _LOW32
    middle = ah * bl
    middle += al * bh
    ah *= bh
    ah <<= _S3  # 2^64 is 8
    ah += middle >> _S29  # 2^61 is 1
    middle &= _LOW29
    middle <<= _S32
    ah += middle
    al *= bl
    ah += al >> _S61
    al &= _PRIME
    ah += al
    return _reduced(ah)


def _sums(values: np.ndarray) -> np.ndarray:
    """Running sums modulo the prime, one more than values."""
    high = np.cumsum(values >> _S32, dtype=np.uint64)
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values & _LOW32, dtype=np.uint64, out=total[1:])
    total[1:] = _reduced(total[1:])
    total[1:] += high >> _S29
    high &= _LOW29
    high <<= _S32
    total[1:] += high
    return _reduced(total)


@cache
def _symbols() -> np.ndarray:
    return _reduced(mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)))


_kept_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse; those of ordinary blocks are kept."""
    if _kept_powers and len(_kept_powers[0][0]) >= n:
        return _kept_powers[0]
    size = -(-n // (1 << 17)) << 17
    found = []
    for base in (_BASE, pow(_BASE, -1, int(_PRIME))):
        powers = np.ones(1, np.uint64)
        while len(powers) < size:
            step = np.full(len(powers), pow(base, len(powers), int(_PRIME)), np.uint64)
            powers = np.concatenate([powers, _times(powers, step)[: size - len(powers)]])
        found.append(powers)
    if size <= 2 * BLOCK_BYTES:
        _kept_powers[:] = [(found[0], found[1])]
    return found[0], found[1]


class Rolling:
    """Hashes of any run of a sequence in constant time, from prefix sums modulo the prime."""

    def __init__(self, values: np.ndarray, symbols: np.ndarray | None = None):
        up, self._down = _powers(len(values) + 1)
        self._prefix = np.zeros(len(values) + 1, np.uint64)
        for at in range(0, len(values), _CHUNK):  # what a chunk needs stays in the cache
            part = values[at : at + _CHUNK]
            own = _reduced(part.copy()) if symbols is None else symbols[part]
            sums = _sums(_times(own, up[at : at + len(part)]))[1:]
            sums += self._prefix[at]
            self._prefix[at + 1 : at + 1 + len(part)] = _reduced(sums)

    @staticmethod
    def of_bytes(data: np.ndarray) -> Rolling:
        return Rolling(data, _symbols())

    def _between(self, low: np.ndarray, high: np.ndarray, down: np.ndarray) -> np.ndarray:
        own = high + _PRIME
        own -= low
        return _times(_reduced(own), down)

    def runs(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash for each run ``[begin, end)``."""
        own = self._between(self._prefix[begin], self._prefix[end], self._down[begin])
        with np.errstate(over="ignore"):
            return mix(own + (end - begin).astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))

    def grams(self, n: int) -> np.ndarray:
        """A hash for each window of ``n`` consecutive values."""
        count = max(0, len(self._prefix) - n)
        own = self._between(self._prefix[:count], self._prefix[n : n + count], self._down[:count])
        with np.errstate(over="ignore"):
            return mix(own + np.uint64(n))


def repeated(hashes: np.ndarray) -> np.ndarray:
    """True where a value occurs at least twice."""
    if len(hashes) < 2:
        return np.zeros(len(hashes), bool)
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(hashes), bool)
    # A bitmap of leading bits settles most values; the rest are looked up.
    seen = np.zeros(1 << 20, bool)
    seen[twice >> np.uint64(44)] = True
    maybe = np.flatnonzero(seen[hashes >> np.uint64(44)])
    place = np.minimum(np.searchsorted(twice, hashes[maybe]), len(twice) - 1)
    out = np.zeros(len(hashes), bool)
    out[maybe[twice[place] == hashes[maybe]]] = True
    return out


def sums_by(starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each ``[starts[i], starts[i + 1])``."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a block: byte ranges, and where each row's words start."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, letter: np.ndarray | None = None):
        inside = letter if letter is not None else ~_SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[starts] = True
        before = np.concatenate([np.zeros(1, bool), inside[:-1]]) if len(data) else inside
        after = np.concatenate([inside[1:], np.zeros(1, bool)]) if len(data) else inside
        self.inside = inside
        self.begin = np.flatnonzero(inside & (~before | first[:-1]))
        self.end = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.starts = np.searchsorted(self.begin, starts)
        self.row = np.repeat(np.arange(len(starts) - 1), np.diff(self.starts))

    def __len__(self) -> int:
        return len(self.begin)

    def windows(self, n: int) -> np.ndarray:
        """Which windows of ``n`` words (by their first word) stay within one row."""
        count = max(0, len(self) - n + 1)
        return self.row[:count] == self.row[n - 1 : n - 1 + count]
