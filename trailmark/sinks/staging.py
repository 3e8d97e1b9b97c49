"""Intermediate results that several reports read: written once to shared storage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Stand-ins for the shared folder in local mode, by application.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        made = tempfile.mkdtemp(prefix="trailmark-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_folders[application] = made
    return _local_folders[application]


def run_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes ``df`` and returns the written table.

    Later reports start from files that outlive any executor instead of repeating
    the plan behind ``df``.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
