"""Shared folder, stored intermediate tables and small helpers of the operators."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# What the contracts call white space between words: ASCII space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors reach.

    A session without that setting gets a temporary folder on one machine (tests), and is
    an error on a cluster.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="trailmark-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def make_importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, which matters on
    one machine when the driver was started elsewhere. Clusters get it with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a plan ends here, so lost
    executors cost a read and not the work behind it."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


_held: dict = {}


def held(name: object, make: Callable[[], Any]) -> Any:
    """What a worker process remembers from task to task under ``name``. One thing at a time:
    a worker that goes on with another operator's tasks does not carry the last one's along."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def drop_held() -> None:
    """For operators whose tasks remember nothing and need room."""
    _held.clear()
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, which a worker that waits for its next task would
    keep beside the tasks of others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def crc_of(name: str = "doc_id") -> Column:
    """crc32 of an id's decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def hash_sample(df: DataFrame, place: Column, n: int, *ties: str) -> DataFrame:
    """``n`` rows of ``df`` at most: those with the smallest 64-bit hashes ``place``.

    A count sets a cutoff below which about twice as many rows lie, so that all tasks
    together send little more than ``n`` rows to where the order is made.
    """
    share = min(1.0, (2 * n + 100) / max(1, df.count()))
    cutoff = int(share * 2**64) - 2**63
    if cutoff < 2**63:
        df = df.where(place < F.lit(cutoff))
    return df.orderBy(place, *ties).limit(n)


# A key of more than this part of all rows counts as hot: there are at most as many.
HOT_PARTS = 512


def join_counted(
    rows: DataFrame, table: DataFrame, key: str | list[str], count: str
) -> DataFrame:
    """``rows`` joined by ``key`` with ``table``, which has one row per key that says in
    ``count`` how many rows have it.

    The keys that hold more than one row in ``HOT_PARTS`` are at most ``HOT_PARTS``: their
    part of the table is broadcast and their rows stay where they are. The others move.
    """
    total = table.agg(F.sum(count)).head()[0] or 0
    hot = F.col(count) * HOT_PARTS > F.lit(total)
    few = F.broadcast(table.where(hot))
    told = rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti")
    return rows.join(few, key).unionByName(told.join(table.where(~hot), key)).drop(count)
