"""A stream of Parquet files that takes a bounded number of rows per trigger, however large a file is.

Offsets are planned from the row counts in the files' footers. The stream itself carries only ranges (file, row group, first
row, number of rows), at most one per row group of a trigger; tasks read the rows. Files found are written to a list in
``index``, in the order in which they were found, and an offset is a place in that list, so a restart goes on exactly there
and a trigger that is repeated reads the same rows.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.pandas.types import to_arrow_schema

# The source and the reading function travel to the workers, which therefore need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RANGES = "path string, row_group int, first long, n_rows long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it; a path without a scheme is local."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


class FileList:
    """The files found so far and the rows of their row groups: numbered parts in a folder, written once each."""

    def __init__(self, path: str, index: str) -> None:
        self._path, self._index = path, index
        self.files: list[tuple[str, list[int]]] = []
        self._parts = 0

    def load(self) -> None:
        """Read the parts that other runs have written."""
        fs, folder = _open(self._index)
        fs.create_dir(folder, recursive=True)
        while fs.get_file_info(name := f"{folder}/{self._parts:09d}.json").type == pafs.FileType.File:
            with fs.open_input_stream(name) as part:
                self.files += [(path, rows) for path, rows in json.loads(part.read())]
            self._parts += 1

    def look(self) -> None:
        """Add the files that have come since, oldest first. Names that begin with ``_`` or ``.`` are not data."""
        self.load()
        fs, root = _open(self._path)
        known = {path for path, _ in self.files}
        found = [
            f for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True))
            if f.type == pafs.FileType.File and f.path not in known
            and not any(p.startswith(("_", ".")) for p in f.path[len(root.rstrip("/")) + 1 :].split("/"))
        ]
        if not found:
            return
        found.sort(key=lambda f: (f.mtime_ns or 0, f.path))
        new = []
        for f in found:
            with fs.open_input_file(f.path) as source:
                footer = pq.read_metadata(source)
            new.append((f.path, [footer.row_group(k).num_rows for k in range(footer.num_row_groups)]))
        index, folder = _open(self._index)
        name = f"{folder}/{self._parts:09d}.json"
        with index.open_output_stream(f"{name}.tmp") as part:
            part.write(json.dumps(new).encode())
        index.move(f"{name}.tmp", name)
        self.files += new
        self._parts += 1

    def after(self, start: dict, n: int) -> dict:
        """The offset ``n`` rows further, or the end of the list."""
        file, row = start["file"], start["row"]
        while file < len(self.files):
            rest = sum(self.files[file][1]) - row
            if rest > n:
                return {"file": file, "row": row + n}
            n -= rest
            file, row = file + 1, 0
        return {"file": file, "row": 0}

    def between(self, start: dict, end: dict) -> Iterator[tuple[str, int, int, int]]:
        """The ranges of rows between two offsets, cut at row groups."""
        for file in range(start["file"], min(end["file"] + 1, len(self.files))):
            path, groups = self.files[file]
            low = start["row"] if file == start["file"] else 0
            high = end["row"] if file == end["file"] else sum(groups)
            begin = 0
            for group, rows in enumerate(groups):
                first, last = max(low, begin), min(high, begin + rows)
                if first < last:
                    yield path, group, first - begin, last - first
                begin += rows


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self._rows = int(options["rows"])
        self._list = FileList(options["folder"], options["index"])

    def initialOffset(self) -> dict:
        return {"file": 0, "row": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        self._list.look()
        end = self._list.after(start, self._rows)
        # Spark copies the iterator, which a generator does not allow.
        return iter(list(self._list.between(start, end))), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        self._list.load()
        return self._list.between(start, end)


class RowRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "signalyard_row_ranges"

    def schema(self) -> str:
        return _RANGES

    def simpleStreamReader(self, schema: T.StructType) -> SimpleDataSourceStreamReader:
        return _Reader(self.options)


def _column(batch: pa.RecordBatch, path: str, field: pa.Field) -> pa.Array:
    """A column by name; else the value of its partition folder; else nulls."""
    if field.name in batch.schema.names:
        return batch.column(field.name).cast(field.type, safe=False)
    for part in path.split("/")[:-1]:
        name, equals, value = part.partition("=")
        if equals and name == field.name and value != "__HIVE_DEFAULT_PARTITION__":
            return pa.array([unquote(value)] * batch.num_rows, pa.string()).cast(field.type)
    return pa.nulls(batch.num_rows, field.type)


def stream_rows(spark: SparkSession, path: str, schema: T.StructType, max_rows: int, index: str) -> DataFrame:
    """Parquet files under ``path`` as a stream with at most ``max_rows`` rows per trigger; nothing is dropped.

    ``index`` is a folder of the stream's own on shared storage, kept as long as its checkpoint. Files must be complete when they
    appear and must not change. Columns that a file lacks come from its partition folders, else are null; further columns are not read.
    Files are read through Arrow, so ``path`` and ``index`` are local, or URIs that Arrow opens (s3, gs, hdfs). Run it with a
    processing-time trigger: ``availableNow`` ends after one trigger of ``max_rows``.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be at least 1")
    wanted = to_arrow_schema(schema, timestamp_utc=True)
    root = path

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = _open(root)[0]
        for r in (r for batch in batches for r in batch.to_pylist()):
            with fs.open_input_file(r["path"]) as source:
                file = pq.ParquetFile(source)
                names = [n for n in wanted.names if n in file.schema_arrow.names]
                seen, first, last = 0, r["first"], r["first"] + r["n_rows"]
                # Without a column of its own a file still has rows.
                for batch in file.iter_batches(8192, row_groups=[r["row_group"]], columns=names or None):
                    low, high = max(first - seen, 0), min(last - seen, batch.num_rows)
                    seen += batch.num_rows
                    if low < high:
                        part = batch.slice(low, high - low)
                        yield pa.RecordBatch.from_arrays([_column(part, r["path"], f) for f in wanted], schema=wanted)
                    if seen >= last:
                        break

    spark.dataSource.register(RowRanges)
    ranges = spark.readStream.format("signalyard_row_ranges").options(folder=path, index=index, rows=str(max_rows)).load()
    # Ranges come in one partition; they are dealt out by themselves, not the rows.
    return ranges.repartition("path", "row_group", "first").mapInArrow(read, schema)
