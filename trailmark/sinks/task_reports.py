"""Reports of tasks that appear all at once and are replaced by a rerun.

Layout below the root::

    TABLE/task=T/run=R      rows that run R of task T wrote
    commits/task=T/run=R    marker, written when all tables of the run are complete

Readers take each task's newest marked run, so a run that died between two tables leaves
nothing to be seen, and its rerun doubles nothing. The run before the last stays until
there is a next one, for readers that listed it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from trailmark.sinks.folders import Folders


class TaskReports(Folders):
    def __init__(self, spark: SparkSession, root: str, file_format: str = "parquet"):
        super().__init__(spark)
        self.root = root.rstrip("/")
        self.file_format = file_format

    def write(self, task_id: int, reports: Sequence[tuple[str, DataFrame]]) -> str:
        """Writes (table, rows) pairs of a task's run and makes them visible together.
        Rows of a table that is named twice are added up."""
        task = f"task={task_id}"
        marked = self._runs(f"commits/{task}")
        # Numbers go up from those of unfinished runs too, which this one leaves behind; two
        # that overlap and take the same number do not share a folder.
        folders = [f"{table}/{task}" for table in self._names(self.root, "")]
        begun = [run for folder in folders for run in self._runs(folder)]
        number = 1 + max((int(run.split("-")[0]) for run in begun), default=0)
        run = f"{number:09d}-{uuid.uuid4().hex[:8]}"
        for table, rows in reports:
            writer = rows.hint("rebalance").write.mode("append").format(self.file_format)
            writer.save(f"{self.root}/{table}/{task}/run={run}")
        self._fs_create(f"{self.root}/commits/{task}/run={run}")
        self._clean(task, keep={run, *marked[-1:]}, below=number)
        return run

    def read(self, table: str) -> DataFrame:
        """Rows of ``table`` of all tasks."""
        paths = []
        for task in self._names(f"{self.root}/commits", "task="):
            folder = f"{self.root}/{table}/{task}/run={self._runs(f'commits/{task}')[-1]}"
            paths += [folder] if self._exists(folder) else []
        if not paths:
            raise FileNotFoundError(f"no finished task has written {table}")
        return self.spark.read.format(self.file_format).load(paths)

    def _runs(self, folder: str) -> list[str]:
        names = self._names(f"{self.root}/{folder}", "run=")
        return sorted(name.removeprefix("run=") for name in names)

    def _clean(self, task: str, keep: set[str], below: int) -> None:
        """Drops a task's other runs, unfinished ones included; one that began later than
        this run is not touched."""
        for table in self._names(self.root, ""):
            for run in self._runs(f"{table}/{task}"):
                if run not in keep and int(run.split("-")[0]) < below:
                    self._delete(f"{self.root}/{table}/{task}/run={run}")
