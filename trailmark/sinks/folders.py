"""Folders on any file system Spark can reach, seen from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _exists(self, path: str) -> bool:
        fs, hadoop_path = self._fs(path)
        return fs.exists(hadoop_path)

    def _delete(self, path: str) -> None:
        fs, hadoop_path = self._fs(path)
        fs.delete(hadoop_path, True)

    def _fs_create(self, path: str) -> None:
        fs, hadoop_path = self._fs(path)
        fs.create(hadoop_path, True).close()

    def _names(self, folder: str, prefix: str) -> list[str]:
        fs, hadoop_path = self._fs(folder)
        if not fs.exists(hadoop_path):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
        return [name for name in names if name.startswith(prefix)]

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        return [int(name[len(prefix) :]) for name in self._names(folder, prefix)]
