"""One local session for all tests, and a switch that makes every key look too big for a task."""

from __future__ import annotations

import sys
import time
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from signalyard.plans import skew  # noqa: E402
from signalyard.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("signalyard-tests", cores=8)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@contextmanager
def _forced(session, rows: int, partitions: int):
    was = session.conf.get("spark.sql.shuffle.partitions")
    session.conf.set(skew.HOT_ROWS_CONF, str(rows))
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        yield
    finally:
        session.conf.unset(skew.HOT_ROWS_CONF)
        session.conf.set("spark.sql.shuffle.partitions", was)


@pytest.fixture
def forced_split(spark):
    """``with forced_split(): ...`` splits every key with more than a handful of rows."""

    def use(rows: int = 5, partitions: int = 12):
        return _forced(spark, rows, partitions)

    return use


@pytest.fixture(scope="session")
def table(spark):
    """``table("a int, b string", (1, "x"), ...)`` as a DataFrame."""

    def make(ddl: str, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return make


@pytest.fixture(scope="session")
def rows_of():
    """Rows as plain tuples, sorted by text so that NULLs do not matter."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture
def feed(spark, tmp_path):
    """``feed(df, df, ...)``: one file and one micro-batch per table."""
    count = iter(range(100))

    def make(*parts):
        path = str(tmp_path / f"feed{next(count)}")
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(path)
            time.sleep(0.01)
        return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)

    return make


@pytest.fixture
def drain(spark, tmp_path):
    count = iter(range(100))

    def run(stream, mode="append"):
        path = str(tmp_path / f"out{next(count)}")

        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{path}/t/flush={batch_id}")

        query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{path}/c")
        query = query.trigger(availableNow=True).start()
        assert query.awaitTermination(120), "the stream did not end"
        return spark.read.parquet(f"{path}/t")

    return run
