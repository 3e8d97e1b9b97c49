"""Bloom filters of 64-bit hashes, built by tasks and sent to tasks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trailmark.llm.shingles import mix

# 64 MB. A filter that is too full only lets more rows through to the exact join behind it.
MOST_BITS = 29


def broadcast_field(rows: DataFrame, column: str):
    """(broadcast bits, their number) for the hashes in ``column``: 16 bits for each row,
    2^``MOST_BITS`` at most."""
    bits = 1 << min(MOST_BITS, max(10, (16 * rows.count() - 1).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(), bits):
                np.bitwise_or.at(field, at >> np.uint64(3), _bit(at))
        blob = pa.array([zlib.compress(field.tobytes(), 1)], pa.binary())
        yield pa.RecordBatch.from_arrays([blob], ["field"])

    field = np.zeros(bits // 8, np.uint8)
    # Tasks are few here: the rows that are looked for were stored in large files.
    for row in rows.select(column).coalesce(16).mapInArrow(mark, "field binary").toLocalIterator():
        field |= np.frombuffer(zlib.decompress(row.field), np.uint8)
    return rows.sparkSession.sparkContext.broadcast(field), bits


def holds(field: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes the filter may hold."""
    held = np.ones(len(hashes), bool)
    for at in _places(hashes, bits):
        held &= (field[at >> np.uint64(3)] & _bit(at)) != 0
    return held


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for seed in (1, 2, 3, 4):
        yield mix(hashes.view(np.uint64), seed) & np.uint64(bits - 1)


def _bit(at: np.ndarray) -> np.ndarray:
    return np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8)
