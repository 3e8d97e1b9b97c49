"""A growing table fed by micro-batches, safe to replay.

Layout below the root::

    batches/batch_id=N             rows of batch N; a replay overwrites this folder only
    rollups/[day=D/]upto=N         merged rows of all batches before N
    rollups_done/upto=N            marker, written after the rollup of N is complete

A batch reads nothing but artefacts of earlier batches, so running it again gives
the same result. Every ``rollup_every`` batches the batches since the last rollup
are merged, for the days they touch, so a reader opens one rollup per day and
fewer than ``rollup_every`` batches however long the stream has run. What a finished
rollup replaced goes one rollup later, so folders do not pile up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.sinks.folders import Folders


class BatchLog(Folders):
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        merge: Callable[[DataFrame], DataFrame],
        by: str | None = None,
        rollup_every: int = 100,
    ):
        super().__init__(spark)
        self.root = root.rstrip("/")
        self.schema = schema
        self.merge = merge
        self.by = by
        self.rollup_every = rollup_every

    def write(self, batch_id: int, rows: DataFrame) -> DataFrame:
        """Stores a batch and returns what was stored."""
        path = self._batch_path(batch_id)
        rows.select(*self.schema.names).write.mode("overwrite").parquet(path)
        return self._read([path])

    def write_any(self, batch_id: int, rows: DataFrame) -> None:
        """Stores a batch unless it is empty and nothing of it was stored before."""
        if not rows.isEmpty() or self._exists(self._batch_path(batch_id)):
            self.write(batch_id, rows)

    def read_before(self, batch_id: int, values: Iterable[str] | None = None) -> DataFrame:
        """Unmerged rows of all batches before ``batch_id``, only for ``values`` if given."""
        base = self._last_rollup(batch_id)
        values = None if values is None else list(values)
        rows = self._read(self._rollup_paths(base, values) + self._batch_paths(base, batch_id))
        if self.by and values is not None:
            rows = rows.where(F.col(self.by).isin(values))
        return rows

    def read_all(self) -> DataFrame:
        """The merged table."""
        ids = self._numbers(f"{self.root}/batches", "batch_id=")
        return self.merge(self.read_before(max(ids, default=-1) + 1))

    def roll_up(self, batch_id: int) -> None:
        """Merges the batches before ``batch_id`` if it is time to."""
        base = self._last_rollup(batch_id)
        if batch_id - base < self.rollup_every:
            return
        touched = self._values_in(self._batch_paths(base, batch_id))
        merged = self.merge(self.read_before(batch_id, touched))
        merged = merged.withColumn("upto", F.lit(batch_id))
        parts = [self.by, "upto"] if self.by else ["upto"]
        if self.by:
            merged = merged.hint("rebalance", self.by)
        (
            merged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts)
            .parquet(f"{self.root}/rollups")
        )
        self._fs_create(f"{self.root}/rollups_done/upto={batch_id}")
        self._clean(base, touched)

    def _clean(self, base: int, touched: list[str] | None) -> None:
        """Drops what only rollups before ``base`` read: a replay starts at ``base`` at
        the earliest, as batches before it were finished."""
        for number in self._numbers(f"{self.root}/batches", "batch_id="):
            if number < base:
                self._delete(self._batch_path(number))
        folders = [f"{self.root}/rollups"]
        if self.by:
            folders = [f"{folders[0]}/{self.by}={value}" for value in touched]
        for folder in folders:
            numbers = self._numbers(folder, "upto=")
            newest = max((n for n in numbers if n <= base), default=0)
            for number in numbers:
                if number < newest:
                    self._delete(f"{folder}/upto={number}")
        for number in self._numbers(f"{self.root}/rollups_done", "upto="):
            if number < base:
                self._delete(f"{self.root}/rollups_done/upto={number}")

    def _values_in(self, paths: list[str]) -> list[str] | None:
        """The days in the given batches: a handful, as batches follow the clock, and
        never more than there are days in the years 1 to 9999."""
        if not self.by:
            return None
        return [row[0] for row in self._read(paths).select(self.by).distinct().collect()]

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rolled = [path for path in paths if "/rollups/" in path]
        plain = [path for path in paths if "/rollups/" not in path]
        parts = []
        if plain:
            parts.append(self.spark.read.schema(self.schema).parquet(*plain))
        if rolled:
            # The day is a folder name here; basePath turns it back into a column.
            reader = self.spark.read.schema(self.schema)
            based = reader.option("basePath", f"{self.root}/rollups").parquet(*rolled)
            parts.append(based.select(*self.schema.names))
        return reduce(DataFrame.unionByName, parts)

    def _batch_path(self, batch_id: int) -> str:
        return f"{self.root}/batches/batch_id={batch_id}"

    def _batch_paths(self, start: int, end: int) -> list[str]:
        numbers = self._numbers(f"{self.root}/batches", "batch_id=")
        return [self._batch_path(number) for number in sorted(numbers) if start <= number < end]

    def _last_rollup(self, batch_id: int) -> int:
        done = self._numbers(f"{self.root}/rollups_done", "upto=")
        return max((number for number in done if number <= batch_id), default=0)

    def _rollup_paths(self, base: int, values: list[str] | None) -> list[str]:
        root = f"{self.root}/rollups"
        if not self.by:
            return [f"{root}/upto={base}"] if base and self._exists(f"{root}/upto={base}") else []
        if values is None:
            folders = self._names(root, f"{self.by}=")
        else:
            folders = [f"{self.by}={value}" for value in values]
        paths = []
        for folder in folders:
            newest = max(
                (n for n in self._numbers(f"{root}/{folder}", "upto=") if n <= base), default=0
            )
            if newest:
                paths.append(f"{root}/{folder}/upto={newest}")
        return paths
