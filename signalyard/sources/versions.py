"""Tables that grow by versions in a shared folder.

A version is a folder of changed rows, written first, and a one-row entry that makes it visible, written last. A run that fails in
between leaves no entry, and the next run replaces its rows. Readers see whole versions only, and any earlier one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class VersionedTable:
    """Changed rows per version, in one or more layouts, each partitioned by ``bucket`` or by the values of a column."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def versions(self) -> DataFrame | None:
        """version, n_rows and note of every finished version."""
        try:
            return self.spark.read.schema("version int, n_rows long, note string").parquet(f"{self.path}/versions")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def newest(self) -> int:
        found = self.versions()
        return 0 if found is None else (found.agg(F.max("version")).first()[0] or 0)

    def bucket(self, *keys: str) -> F.Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def add(
        self,
        version: int,
        layouts: dict[str, tuple[DataFrame, list[str]]],
        note: str = "",
        folders: dict[str, tuple[DataFrame, str]] | None = None,
    ) -> None:
        """Write ``version``: each layout is a table and the keys of its buckets; rows are counted in the first.

        ``folders`` are tables with a folder per value of a column, such as a day; a value with many rows is written by many tasks.
        """
        first = next(iter(layouts))
        for name, (rows, keys) in layouts.items():
            placed = rows.withColumn("bucket", self.bucket(*keys)).repartition("bucket")
            placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/version={version}")
        for name, (rows, column) in (folders or {}).items():
            placed = rows.hint("rebalance", F.col(column))
            placed.write.mode("overwrite").partitionBy(column).parquet(f"{self.path}/{name}/version={version}")
        n_rows = layouts[first][0].count()
        entry = self.spark.createDataFrame([(version, n_rows, note)], "version int, n_rows long, note string")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/v={version}")

    def read(self, layout: str, ddl: str, upto: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of all finished versions up to ``upto``, with their version; only the given buckets are read."""
        rows = self._read(layout, f"{ddl}, bucket int, version int", upto)
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def read_folders(self, layout: str, ddl: str, upto: int | None = None) -> DataFrame:
        """The same for a layout with a folder per value; a filter on that column skips the other folders."""
        return self._read(layout, f"{ddl}, version int", upto)

    def _read(self, layout: str, schema: str, upto: int | None) -> DataFrame:
        known = self.versions()
        if known is None:
            return self.spark.createDataFrame([], schema)
        done = [r[0] for r in known.select("version").collect() if upto is None or r[0] <= upto]
        paths = [f"{self.path}/{layout}/version={v}" for v in sorted(done)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{layout}").parquet(*paths)

    def touched(self, rows: DataFrame, *keys: str) -> list[int]:
        """The buckets that rows fall into: never more than there are buckets."""
        return [r[0] for r in rows.select(self.bucket(*keys).alias("b")).distinct().collect()]
