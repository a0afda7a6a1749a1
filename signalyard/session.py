"""Session settings and the one way this package cuts lineage.

``configure`` only touches runtime SQL settings, so it is safe on a session that a cluster
hands us; ``local_session`` is for tests, the bench and notebooks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on.
RUNTIME_CONF = {
    # Payload merges are "the later key wins"; the default policy raises on a repeated key.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # All signal times are instants; keep day and week boundaries independent of the machine.
    "spark.sql.session.timeZone": "UTC",
    # The default, 96 bits, has no least and greatest value in the footers, so a time range would skip no row group.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state on local disk instead of on the heap: it may outgrow the memory of an executor.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "signalyard", cores: str | int = "*", memory: str = "8g") -> SparkSession:
    """A ``local[n]`` session with as many shuffle partitions as there are threads."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables that must outlive an executor.

    Comes from ``spark.checkpoint.dir`` (or the context's checkpoint folder). Only a ``local``
    master may fall back to a temporary folder: on a cluster such a folder would be invisible to
    the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_fallback:
        _local_fallback[context.applicationId] = tempfile.mkdtemp(prefix="signalyard-")
    return _local_fallback[context.applicationId]


# The tables that the innermost ``durable_scope`` has to remove.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def durable_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``durable`` writes inside, at the end, also after an error.

    Results are lazy: write or collect what is wanted before the scope ends. Scopes may lie in each other, each removes its own
    tables; stored tables (versions, sinks) are never touched.
    """
    mine: list[str] = []
    token = _written.set(mine)
    try:
        yield
    finally:
        _written.reset(token)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in mine:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(hadoop).delete(place, True)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of an executor, and freezes values that a recomputation
    could change (partition ids, sampled bounds). Parquet keeps column pruning and size
    statistics for whatever comes next. The table stays until a ``durable_scope`` around it ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    mine = _written.get()
    if mine is not None:
        mine.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
