"""WARC archives: a deterministic sharded writer with revisit records, and a reader.

Records are sorted by page in shards, whose bounds follow from the pages alone, not from how they are partitioned. A task
compresses each record on its own and rolls to the next file at the end of a shard or once the compressed size is reached. Files are written under temporary names, renamed, and listed in a manifest; a repeated task
writes the same bytes under the same names.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalyard.llm.common import batch_of, blocks, ship
from signalyard.llm.token_files import as_uri
from signalyard.session import durable, shared_dir

# Compressed bytes after which a file is followed by the next, and payload bytes from which equal payloads are revisits.
ROLL_BYTES = 64 << 20
REVISIT_BYTES = 1000
# Payload bytes of a shard, of which there are at most so many, and rows that are looked at per shard to place its bounds.
SHARD_BYTES = 16 << 20
_MOST_SHARDS = 10_000
_PER_SHARD = 64
# All records bear this date: the same pages give the same bytes.
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _clean(value: str) -> str:
    """A header value on one line: white space and control characters are percent-encoded."""
    return "".join(c if c.isprintable() and not c.isspace() else quote(c, safe="") for c in value)


def _name(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest}:{copy}>"


def record(page_id: int | None, copy: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit if ``refers_to`` is given. Digests are in lower-case hex."""
    own = _name(page_id, digest, copy)
    block = _HTTP if refers_to is not None else _HTTP + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", own),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _clean(url) if url else own[1:-1]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("WARC-Identified-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers[4:4] = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(refers_to, digest, 0)), ("WARC-Truncated", "length")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class Roller:
    """Writes gzip members to files of about ``limit`` compressed bytes, each under a temporary name until it is full."""

    def __init__(self, folder: str, part: int, limit: int):
        self._store, self._root = fs.FileSystem.from_uri(folder)
        self._store.create_dir(self._root)
        self._folder, self.part, self._limit = folder, part, limit
        self._file, self._hidden = None, ""
        self._bytes = self._records = 0
        self.done: list[dict] = []

    def write(self, data: bytes) -> None:
        if self._file is None:
            self._hidden = f"{self._root}/_{self.part:06d}.{uuid.uuid4().hex}"
            self._file = self._store.open_output_stream(self._hidden, compression=None)
            self._sum = hashlib.sha1()
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self._file.write(member)
        self._sum.update(member)
        self._bytes += len(member)
        self._records += 1
        if self._bytes >= self._limit:
            self.roll()

    def roll(self) -> None:
        if self._file is None:
            return
        self._file.close()
        name = f"part-{self.part:06d}-{len(self.done):05d}.warc.gz"
        self._store.move(self._hidden, f"{self._root}/{name}")
        self.done.append(
            {"path": f"{self._folder}/{name}", "n_records": self._records, "n_bytes": self._bytes, "sha1": self._sum.hexdigest()}
        )
        self._file, self._bytes, self._records = None, 0, 0


_MANIFEST = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha1", pa.string())])


def _place(bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` lie below page_id (none, if it is null).

    Looked up among the first ones of blocks, then inside one block, so the cost of a row is twice the root of their number.
    """

    def below(places: Column) -> Column:
        return F.size(F.filter(places, lambda b: b < F.col("page_id")))

    def listed(numbers: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<long>")

    step = math.isqrt(len(bounds)) + 1
    block = below(listed(bounds[::step]))
    inside = F.slice(listed(bounds), (block - 1) * step + 1, F.lit(step))
    return F.when(block == 0, 0).otherwise((block - 1) * step + below(inside))


def _shard(rows: DataFrame) -> tuple[Column, int]:
    """Number of the shard of a row of ``rows`` (page_id, size), and how many there are; a page_id lies in one shard, a null one in the first.

    The bounds cut the bytes of the page_ids of least hash evenly: the same rows give the same bounds, however they are dealt.
    """
    n_rows, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = min(_MOST_SHARDS, -(-total // SHARD_BYTES))
    if shards <= 1:
        return F.lit(0), 1
    share = int(min(1.0, shards * _PER_SHARD / n_rows) * (1 << 30))
    chosen = rows.filter("page_id IS NOT NULL").filter(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < share)
    found = sorted((r["page_id"], r["size"]) for r in chosen.groupBy("page_id").agg(F.sum("size").alias("size")).collect())
    whole, upto, bounds = sum(size for _, size in found), 0, []
    for page_id, size in found[:-1]:
        before, upto = upto, upto + size
        if before * shards // whole < upto * shards // whole:
            bounds.append(page_id)
    if not bounds:
        return F.lit(0), 1
    return _place(bounds), len(bounds) + 1


def write_warc(
    pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) to ``folder``; returns the manifest, a written table.

    The payload is the html in UTF-8, empty if null. Of records with equal payloads of at least ``revisit_bytes`` the one with the
    largest page_id is a response, the others are revisits of it; of repeated rows with that page_id one is the response. A null
    page_id is written as such and counts as the smallest (equal payloads of null ids alone are all responses). A null url becomes the record's own name. Other columns
    are not read. An empty table gives no files and an empty manifest.
    """
    ship(pages.sparkSession)
    target = as_uri(folder).rstrip("/")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    ids = rows.select("page_id", "digest", F.octet_length("html").alias("size")).filter(F.col("size") >= revisit_bytes)
    shared = ids.groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).filter("n > 1")
    # A reference travels as a row of its own just before its page, so the payloads are shuffled once, for the order.
    references = ids.join(shared, "digest").select("page_id", "digest", "largest").distinct()
    none = F.lit(None).cast("string")
    shard, shards = _shard(rows.select("page_id", (F.octet_length("html").cast("long") + 1).alias("size")))
    both = rows.select("page_id", "digest", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("long").alias("largest")).union(
        references.select("page_id", "digest", F.lit(0), none, none, "largest")
    )
    # A task takes whole shards; which ones does not matter. There are as many tasks as shards, so a task does not grow with the table.
    dealt = both.withColumn("shard", shard).repartitionByRange(shards, "shard")
    ordered = dealt.sortWithinPartitions("shard", "page_id", "digest", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Roller | None = None
        last, copies = None, 0  # how many records of this page_id and payload there are so far
        reference: tuple | None = None
        answered = False  # whether the referred record itself has been written
        done: list[dict] = []
        for block in blocks(batches, "html"):
            for page_id, digest, kind, url, html, largest, part in zip(*(c.to_pylist() for c in block.columns), strict=True):
                if out is None or out.part != part:
                    if out is not None:
                        out.roll()
                        done += out.done
                    out = Roller(target, part, roll_bytes)
                if (page_id, digest) != last:
                    last, copies = (page_id, digest), 0
                if kind == 0:
                    reference, answered = (page_id, digest, largest), False
                    continue
                refers_to = reference[2] if reference is not None and reference[:2] == last else None
                if refers_to is not None and refers_to == page_id and not answered:
                    refers_to, answered = None, True
                out.write(record(page_id, copies, url, html.encode(), digest, refers_to))
                copies += 1
        if out is not None:
            out.roll()
            done += out.done
        if done:
            yield batch_of(_MANIFEST, **{c: [d[c] for d in done] for c in _MANIFEST.names})

    return durable(ordered.mapInArrow(run, "path string, n_records long, n_bytes long, sha1 string"))


def records(path: str, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a file, one member in memory at a time."""
    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_stream(place, compression=None) as file:
        data = b""
        while True:
            data = data or file.read(chunk)
            if not data:
                return
            reader = zlib.decompressobj(31)
            parts = []
            while not reader.eof:
                if not data:
                    data = file.read(chunk)
                    if not data:
                        raise ValueError(f"{path} ends inside a record")
                parts.append(reader.decompress(data))
                data = reader.unused_data
            yield parse(b"".join(parts))


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("a record does not begin with its version")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if f"sha1:{hashlib.sha1(block).hexdigest()}" != headers["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {headers['WARC-Record-ID']} does not fit")
    return headers, block


def _page(urn: str) -> int | None:
    name = urn.strip("<>").split(":")[2]
    return None if name == "none" else int(name)


_READ = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)
_READ_DDL = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
)
_EMIT_BYTES = 4 << 20


def read_warc(manifest: DataFrame) -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type and refers_to of every record.

    Digests of blocks and payloads are computed again and must fit.
    """
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held: list[tuple] = []
                size = 0
                for headers, block in records(path):
                    kind = headers["WARC-Type"]
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    payload, refers_to = None, None
                    if kind == "revisit":
                        refers_to = _page(headers["WARC-Refers-To"])
                    else:
                        payload = block.partition(b"\r\n\r\n")[2]
                        if hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"payload digest of {headers['WARC-Record-ID']} does not fit")
                    held.append(
                        (
                            _page(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], payload,
                            int(headers["WARC-Identified-Payload-Length"]), digest, kind, refers_to,
                        )
                    )
                    size += len(payload or b"")
                    if size >= _EMIT_BYTES:
                        yield batch_of(_READ, **dict(zip(_READ.names, zip(*held, strict=True), strict=True)))
                        held, size = [], 0
                if held:
                    yield batch_of(_READ, **dict(zip(_READ.names, zip(*held, strict=True), strict=True)))

    files = manifest.select("path")
    return files.repartitionByRange(max(1, min(manifest.count(), 10_000)), "path").mapInArrow(run, _READ_DDL)


def archive_folder(spark) -> str:
    return f"{shared_dir(spark)}/warc/{uuid.uuid4().hex}"
