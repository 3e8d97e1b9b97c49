"""Whitening of integer vectors with the covariance of distinct vectors weighted by counts.

Equal vectors are grouped first, so that each is multiplied and whitened once however often
it occurs; its count (or one) is its weight in the fit. Tasks multiply their centred,
weighted vectors; what they send is a row of the covariance at a time, added up by row, so
that the driver gets d rows of d numbers whatever the number of tasks. Results go back to
the rows by a digest of the vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import join_counted, stored

# Eigenvalues up to this share of the largest one are rounding errors of zero.
ZERO = 1e-12

RESULT = (
    "component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
    "identity_error double"
)


@dataclass
class Fit:
    """Of the vectors of one length: total weight, sums, components as columns, their
    eigenvalues and the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums/n, taking whole parts away first, which is exact."""
        whole, rest = self._mean()
        return (x - whole).astype(np.float64) - rest / self.n

    def _mean(self) -> tuple[np.ndarray, np.ndarray]:
        whole = [s // self.n for s in self.sums]
        rest = [s - self.n * m for s, m in zip(self.sums, whole)]
        return np.array(whole, np.int64), np.array(rest, np.float64)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n*x - sums)^2, in whole numbers of any size."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        near = x - whole
        most = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 2**63:
            apart = near * self.n - np.array(rest, np.int64)
            return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
        apart = near.astype(object) * self.n - np.array(rest, object)
        return pa.array([int(v) for v in (apart * apart).sum(axis=1)], pa.decimal128(38, 0))

    def whitened(self, x: np.ndarray) -> np.ndarray:
        real = self.positive()
        scale = np.zeros(len(self.values))
        scale[real] = 1 / np.sqrt(self.values[real])
        return self.centred(x) @ self.components * scale

    def positive(self) -> np.ndarray:
        return self.values > ZERO * max(self.values.max(initial=0.0), 0.0)

    def explained(self) -> list[float]:
        return [float(v / self.trace) if self.trace > 0 else 0.0 for v in self.values]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, which rows, their vectors as a matrix) of a batch with a column ``x``."""
    lists = batch.column("x")
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield size, at, lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), size)


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("weight").to_numpy()


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Of each length: total weight and weighted sums by dimension, in whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            weight = _weights(batch)
            for size, at, x in _by_length(batch):
                own = weight[at]
                most = float(np.abs(x).max(initial=0)) * float(own.sum())
                x, own = (x, own) if most < 2**62 else (x.astype(object), own.astype(object))
                total = totals.setdefault(size, [0] * (size + 1))
                added = [own.sum(), *(own @ x)]
                totals[size] = [a + int(b) for a, b in zip(total, added)]
        rows = [(size, i, value) for size, values in totals.items() for i, value in enumerate(values)]
        kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0))
        columns = list(zip(*rows)) or [(), (), ()]
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["length", "i", "value"])

    parts = distinct.mapInArrow(run, "length int, i int, value decimal(38,0)")
    found: dict[int, dict[int, int]] = {}
    for row in parts.groupBy("length", "i").agg(F.sum("value").alias("value")).collect():
        found.setdefault(row.length, {})[row.i] = int(row.value)
    return {size: (v[0], [v[i] for i in range(1, size + 1)]) for size, v in found.items()}


def _added(parts: DataFrame) -> dict[int, np.ndarray]:
    """Matrices by length from (length, i, row) parts of their rows, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for size, i, row in zip(*(c.to_pylist() for c in batch.columns)):
                values = np.frombuffer(row, np.float64)
                key = (size, i)
                totals[key] = totals[key] + values if key in totals else values
        yield _rows(totals)

    schema = "length int, i int, row binary"
    found: dict[int, dict[int, np.ndarray]] = {}
    for row in parts.repartition("length", "i").mapInArrow(run, schema).collect():
        found.setdefault(row.length, {})[row.i] = np.frombuffer(row.row, np.float64)
    return {size: np.stack([rows[i] for i in range(len(rows))]) for size, rows in found.items()}


def _rows(totals: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    arrays = [
        pa.array([size for size, _ in totals], pa.int32()),
        pa.array([i for _, i in totals], pa.int32()),
        pa.array([row.tobytes() for row in totals.values()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["length", "i", "row"])


def _products(rows: DataFrame, make) -> dict[int, np.ndarray]:
    """Weighted sums of products by length, of the matrices that ``make`` has of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = _weights(batch).astype(np.float64)
            for size, at, x in make(batch):
                product = (x * weight[at, None]).T @ x
                totals[size] = totals[size] + product if size in totals else product
        yield _rows({(size, i): row for size, m in totals.items() for i, row in enumerate(m)})

    return _added(rows.mapInArrow(run, "length int, i int, row binary"))


def fit(distinct: DataFrame, components: int) -> dict[int, Fit]:
    """Components of (x, weight) rows for each length of x."""
    plain = {
        size: Fit(n, sums, np.zeros((size, 0)), np.zeros(0), 0.0)
        for size, (n, sums) in _sums(distinct).items()
    }
    sent = distinct.sparkSession.sparkContext.broadcast(plain)

    def centred(batch: pa.RecordBatch):
        for size, at, x in _by_length(batch):
            if size:
                yield size, at, sent.value[size].centred(x)

    for size, products in _products(distinct, centred).items():
        one = plain[size]
        values, vectors = np.linalg.eigh(products / one.n)
        order = np.argsort(values)[::-1][:components]
        one.values, one.components = np.maximum(values[order], 0.0), vectors[:, order]
        one.trace = float(np.trace(products) / one.n)
    return plain


def _applied(distinct: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """(key, weight, length, deviation, whitened) of every distinct vector."""
    sent = distinct.sparkSession.sparkContext.broadcast(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, x in _by_length(batch):
                one = sent.value[size]
                made = one.whitened(x)
                offsets = np.arange(len(at) + 1, dtype=np.int32) * made.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel()))
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(rows),
                        batch.column("weight").take(rows),
                        pa.array(np.full(len(at), size, np.int32)),
                        one.deviations(x),
                        lists,
                    ],
                    ["key", "weight", "length", "deviation", "whitened"],
                )

    return distinct.mapInArrow(
        run,
        "key binary, weight bigint, length int, deviation decimal(38,0), whitened array<double>",
    )


def _identity_errors(applied: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Of each length: the largest entry of whitened's covariance minus the identity, over
    components that have any variance."""

    def made(batch: pa.RecordBatch):
        sizes = batch.column("length").to_numpy()
        lists = batch.column("whitened")
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            z = lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
            if z.shape[1]:
                yield size, at, np.hstack([np.ones((len(at), 1)), z])

    errors = dict.fromkeys(fits, 0.0)
    for size, products in _products(applied.select("length", "whitened", "weight"), made).items():
        n, means = products[0, 0], products[0, 1:] / products[0, 0]
        apart = products[1:, 1:] / n - np.outer(means, means) - np.eye(len(means))
        real = fits[size].positive()
        errors[size] = float(np.abs(apart[np.ix_(real, real)]).max(initial=0.0))
    return errors


def _by_length_column(length: Column, values: dict[int, Column]) -> Column:
    pairs = [part for size, value in values.items() for part in (F.lit(size), value)]
    return F.element_at(F.create_map(*pairs), length)


def whiten(
    vectors: DataFrame,
    components: int = 8,
    by_count: bool = True,
    id_col: str = "vec_id",
    x_col: str = "x",
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every row and
    component of whole-number vectors ``x_col`` (arrays of bigint).

    The fit list is all rows (``by_count``) or each distinct vector once. Components are
    numbered from 1 by falling eigenvalue. Rows whose vector is null or holds a null are
    left out; equal vectors share results and stay rows of their own, null and repeated ids
    too; other columns are left out. Vectors are fitted with those of their length, and an
    empty vector has no component. A component without variance (one vector, equal vectors,
    more dimensions than vectors) is whitened to 0, explains 0 and does not count as error.
    An empty table gives no rows.
    """
    spark = vectors.sparkSession
    x = vectors[x_col]
    kept = vectors.where(x.isNotNull() & ~F.exists(x, lambda c: c.isNull())).select(
        vectors[id_col].alias("id"),
        F.unhex(F.md5(F.array_join(x, ",").cast("binary"))).alias("key"),
        x.alias("x"),
    )
    weight = F.count(F.lit(1)) if by_count else F.lit(1).cast("bigint")
    grouped = kept.groupBy("key", "x").agg(weight.alias("weight"), F.count(F.lit(1)).alias("rows"))
    distinct = stored(grouped, "whitening-distinct")
    fits = fit(distinct.select("x", "weight"), components)
    if not fits:
        kind = kept.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_col}` {kind}, {RESULT}")
    applied = stored(_applied(distinct.select("key", "x", "weight"), fits), "whitening-applied")
    errors = _identity_errors(applied, fits)
    counted = applied.drop("weight").join(distinct.select("key", "rows"), "key")
    told = join_counted(kept.select("id", "key"), counted, "key", "rows")
    length = F.col("length")
    return told.select(
        "id", "deviation", "length", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).cast("int").alias("component"),
        _by_length_column(length, {s: F.lit(f.n).cast("bigint") for s, f in fits.items()}).alias("n"),
        "deviation",
        "whitened",
        F.get(
            _by_length_column(
                length,
                {
                    s: F.array(*map(F.lit, f.explained())).cast("array<double>")
                    for s, f in fits.items()
                },
            ),
            F.col("at"),
        ).alias("explained"),
        _by_length_column(length, {s: F.lit(e) for s, e in errors.items()}).alias("identity_error"),
    )
