"""Whitening against numpy over all rows, without grouping."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from trailmark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, components=8):
    """{id: [(n, deviation, explained)]}, the covariance and x by id, from all rows."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    x = np.array([v for _, v in kept], np.int64)
    n, sums = len(kept), [int(s) for s in x.sum(axis=0)]
    centred = x - np.array(sums) / n
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1][:components]
    deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return n, kept, deviation, centred, cov, values


def rows_of(seed=3, n=400, d=12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 2, d)) * np.linspace(0.1, 1, d)
    vectors = [base[i] for i in rng.integers(0, n // 8, n // 2)] + list(base)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(vectors)]
    rows += [(10_000 + i, rows[0][1]) for i in range(n)]  # a third are one vector
    rows += [(7, rows[7][1]), (None, rows[3][1]), (None, rows[3][1])]
    bad = [None, [*rows[0][1][:-1], None], [*rows[0][1][:-1], math.nan], [math.inf, *rows[0][1][1:]]]
    return rows + [(20_000 + i, v) for i, v in enumerate(bad)]


def write(spark, tmp_path, rows, extra=True):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    if extra:
        df = df.selectExpr("*", *(f"'x' AS {n}" for n in ("id", "key", "x", "n", "weight", "rows", "component")))
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def test_query_equals_numpy(spark, tmp_path):
    rows = rows_of()
    got = queries.op12_whitening(spark, write(spark, tmp_path, rows)).toPandas()
    n, kept, deviation, centred, cov, values = expected(rows)
    assert len(got) == 8 * len(kept) and set(got.n) == {n}
    by_id = Counter((None if i is None else i, d) for (i, _), d in zip(kept, deviation))
    ids = [None if math.isnan(i) else int(i) for i in got.vec_id]
    told = Counter(zip(ids, got.deviation))
    assert told == {key: 8 * count for key, count in by_id.items()}
    for k, e in enumerate(values, 1):
        assert np.allclose(got.explained[got.component == k], e / np.trace(cov), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    # Each component is one unit eigenvector, of either sign, for all rows.
    vectors = np.linalg.eigh(cov)[1][:, ::-1]
    place = {i: at for at, (i, _) in enumerate(kept)}
    for k in range(1, 9):
        part = got[(got.component == k) & got.vec_id.notna()]
        at = [place[int(i)] for i in part.vec_id]
        want = centred[at] @ vectors[:, k - 1] / np.sqrt(values[k - 1])
        sign = np.sign(want @ part.whitened)
        assert np.allclose(part.whitened, sign * want, atol=1e-8)


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = queries.op12_whitening(spark, folder).toPandas()
    n, kept, deviation, *_ = expected(rows)
    first = got[got.component == 1].set_index("vec_id").deviation
    assert {i: d for (i, _), d in zip(kept, deviation)} == first.to_dict()
    assert len(got) == 8 * n and got.identity_error[0] <= 1e-4


def test_distinct_vectors_once(spark):
    rows = [(i, [100 * (i % 3), i % 3 * i % 7]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, x array<bigint>")
    distinct = {tuple(v) for _, v in rows}
    got = whitening.whiten(df, by_count=False).toPandas()
    assert set(got.n) == {len(distinct)} and len(got) == 60
    x = np.array(sorted(distinct), float)
    trace = ((x - x.mean(axis=0)) ** 2).sum() / len(x)
    assert np.isclose(got[got.component == 1].explained.iloc[0], np.linalg.eigvalsh(np.cov(x.T, bias=True))[-1] / trace)


@pytest.mark.parametrize("rows", [[(1, [5, 7, 9])], [(i, [5, 7, 9]) for i in range(4)]])
def test_no_variance(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, x array<bigint>")).collect()
    assert len(got) == 3 * len(rows)
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {
        (len(rows), 0, 0.0, 0.0, 0.0)
    }


def test_lengths_and_large_numbers(spark):
    rows = [(1, []), (2, [2**40, 0]), (3, [0, 2**40]), (4, [1]), (5, [3]), (6, None), (7, [None])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, x array<bigint>")).collect()
    assert {r.vec_id: int(r.deviation) for r in got} == {2: 2 * 2**80, 3: 2 * 2**80, 4: 4, 5: 4}
    assert sorted(abs(r.whitened) for r in got if r.vec_id in (4, 5)) == [1.0, 1.0]


def test_empty_table(spark, tmp_path):
    got = queries.op12_whitening(spark, write(spark, tmp_path, []))
    assert got.collect() == [] and got.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    ]
