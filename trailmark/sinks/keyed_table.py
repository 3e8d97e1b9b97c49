"""A table whose rows are replaced by key, batch by batch.

Layout below the root::

    parts/PART=P/bucket=B/version=N   the rows of a bucket as batch N left them
    commits/batch_id=N                marker, written when batch N is complete
    staged/batch_id=N                 rows of a batch while it is applied

A batch rewrites only the buckets that hold a key of its own, each into a folder of its
version. Readers take each bucket's newest version up to the last marker, so a batch
becomes visible at once and one that died leaves nothing to be seen. Batch numbers fence:
a batch at or below the last marker was applied and is not applied again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.sinks.folders import Folders

BUCKETS = 64


class KeyedTable(Folders):
    """``part`` is a column of the key that few batches spread over, such as the day."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        part: str,
        buckets: int = BUCKETS,
    ):
        super().__init__(spark)
        self.root = root.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.part = part
        self.buckets = buckets

    def last_batch(self) -> int:
        return max(self._numbers(f"{self.root}/commits", "batch_id="), default=-1)

    def upsert(self, rows: DataFrame, batch_id: int) -> bool:
        """Replaces the rows of the given keys, which are unique in ``rows``, and adds new
        ones. False if the batch had been applied before."""
        last = self.last_batch()
        if batch_id <= last:
            return False
        staged = f"{self.root}/staged/batch_id={batch_id}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        if self._exists(staged):
            self._forget_after(last)
        placed = rows.select(*self.schema.names).withColumn("bucket", bucket)
        placed.write.mode("overwrite").parquet(staged)
        fresh = self.spark.read.schema(placed.schema).parquet(staged)

        # One row per bucket that changes: at most ``buckets`` for each day of the batch.
        touched = [tuple(row) for row in fresh.select(self.part, "bucket").distinct().collect()]
        current = {part: self._version(part, last) for part in touched}
        kept = self._read(current).join(fresh.select(*self.keys), self.keys, "left_anti")
        merged = kept.unionByName(fresh).withColumn("version", F.lit(batch_id))
        if touched:
            # A bucket is one file, of one task; all cores write, however few rows there are.
            tasks = min(len(touched), self.spark.sparkContext.defaultParallelism)
            (
                merged.repartition(tasks, self.part, "bucket")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(self.part, "bucket", "version")
                .parquet(f"{self.root}/parts")
            )
        self._fs_create(f"{self.root}/commits/batch_id={batch_id}")
        self._clean(current, last)
        self._delete(staged)
        return True

    def read(self) -> DataFrame:
        """The table as the last complete batch left it."""
        last = self.last_batch()
        versions = {part: self._version(part, last) for part in self._parts()}
        return self._read(versions).drop("bucket")

    def _parts(self) -> list[tuple]:
        return [
            (value.partition("=")[2], bucket)
            for value in self._names(f"{self.root}/parts", f"{self.part}=")
            for bucket in self._numbers(f"{self.root}/parts/{value}", "bucket=")
        ]

    def _forget_after(self, last: int) -> None:
        """Drops what a batch left that died: its successor may touch other buckets."""
        for part in self._parts():
            for version in self._numbers(self._folder(part), "version="):
                if version > last:
                    self._delete(f"{self._folder(part)}/version={version}")

    def _folder(self, part: tuple) -> str:
        return f"{self.root}/parts/{self.part}={part[0]}/bucket={part[1]}"

    def _version(self, part: tuple, last: int) -> int | None:
        versions = self._numbers(self._folder(part), "version=")
        return max((version for version in versions if version <= last), default=None)

    def _read(self, versions: dict[tuple, int | None]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        paths = [
            f"{self._folder(part)}/version={version}"
            for part, version in versions.items()
            if version is not None
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        # The part and the bucket are folder names; basePath turns them back into columns.
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/parts")
        return reader.parquet(*paths).select(*schema.names)

    def _clean(self, current: dict[tuple, int | None], last: int) -> None:
        """Drops versions before those this batch replaced: readers that began before the
        marker still find what they listed."""
        for part, version in current.items():
            for older in self._numbers(self._folder(part), "version="):
                if version is not None and older < version:
                    self._delete(f"{self._folder(part)}/version={older}")
        for older in self._numbers(f"{self.root}/commits", "batch_id="):
            if older < last:
                self._delete(f"{self.root}/commits/batch_id={older}")
