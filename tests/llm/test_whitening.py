"""Golub-Kahan-Lanczos whitening against a dense eigenvalue decomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.llm.whitening import Centre, whiten

ROWS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("n", T.StringType()),  # a column with a name of the result's
    ]
)


def embeddings(llm, vectors, ids=None):
    ids = ids if ids is not None else range(len(vectors))
    return llm.createDataFrame(
        [(i, v if v is None else [None if c is None else float(c) for c in v], "x") for i, v in zip(ids, vectors, strict=True)],
        ROWS,
    )


def dense(vectors):
    x = np.floor(np.asarray(vectors, np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = (n * fit - sums) / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    return x, n, sums, values[::-1], basis[:, ::-1]


def check(rows, vectors, ids, components):
    x, n, sums, values, basis = dense(vectors)
    many = min(components, int((values > values[0] * 1e-11).sum()))
    found = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(ids) * many and set(found) == {(i, c + 1) for i in ids for c in range(many)}
    got = np.array([[found[i, c + 1].whitened for c in range(many)] for i in ids])
    expected = ((n * x - sums) / n) @ basis[:, :many] / np.sqrt(values[:many])
    for c in range(many):
        if all(abs(values[c] - e) > 1e-9 * values[0] for k, e in enumerate(values) if k != c):
            sign = 1 if got[:, c] @ expected[:, c] > 0 else -1
            np.testing.assert_allclose(sign * got[:, c], expected[:, c], atol=1e-8)
        np.testing.assert_allclose(found[ids[0], c + 1].explained, values[c] / values.sum(), rtol=1e-9)
    for i, v in zip(ids, x, strict=True):
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True))
        assert found[i, 1].deviation == exact
    assert {r.n for r in rows} == {n}
    error = {r.identity_error for r in rows}
    assert len(error) == 1 and error.pop() < 1e-10


@pytest.mark.parametrize("width,rows", [(1, 5), (7, 40), (24, 300)])
def test_against_a_dense_decomposition(llm, width, rows):
    vectors = np.random.default_rng(width).normal(size=(rows, width)) @ np.diag(np.arange(1, width + 1))
    found = whiten(embeddings(llm, vectors.tolist()).repartition(3)).collect()
    check(found, vectors, list(range(rows)), 16)


def test_repeated_vectors_are_fitted_once(llm):
    vectors = np.random.default_rng(2).normal(size=(30, 5))
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 200, axis=0)])
    found = whiten(embeddings(llm, vectors.tolist())).collect()
    check(found, vectors, list(range(230)), 16)
    assert found[0].n == 30


def test_fewer_directions_than_dimensions(llm):
    random = np.random.default_rng(3)
    vectors = np.rint(random.normal(size=(60, 3)) * 3) @ np.rint(random.normal(size=(3, 9)) * 3)
    check(whiten(embeddings(llm, vectors.tolist())).collect(), vectors, list(range(60)), 16)
    # fewer rows than dimensions
    vectors = random.normal(size=(4, 20))
    check(whiten(embeddings(llm, vectors.tolist())).collect(), vectors, list(range(4)), 16)


def test_equal_variances(llm):
    """One direction found does not hide another of the same variance."""
    corners = [[s if k == d else 0 for k in range(6)] for d in range(6) for s in (-1, 1)]
    found = whiten(embeddings(llm, corners), components=4).collect()
    check(found, corners, list(range(12)), 4)
    assert len({r.component for r in found}) == 4


def test_rows_that_are_left_out(llm):
    good = [[0.5, 1.0], [2.0, -1.0], [0.25, 3.0]]
    odd = [None, [], [None, 1.0], [math.nan, 1.0], [math.inf, 1.0], [1e30, 0.0], [1.0, 2.0, 3.0]]
    rows = embeddings(llm, good + odd + good[:1], [1, 2, 3, 11, 12, 13, 14, 15, 16, 17, None])
    found = whiten(rows).collect()
    assert {r.vec_id for r in found} == {1, 2, 3, None}
    check([r for r in found if r.vec_id], good, [1, 2, 3], 16)


def test_nothing_to_fit(llm):
    assert whiten(embeddings(llm, [])).collect() == []
    assert whiten(embeddings(llm, [None])).collect() == []
    assert whiten(embeddings(llm, [[1.0, 2.0]] * 5)).collect() == []
    with pytest.raises(ValueError):
        whiten(embeddings(llm, [[1.0]]).withColumnRenamed("vec_id", "component"), "component")


def test_numbers_beyond_64_bits():
    centre = Centre(3, [(1 << 62) + 5, 0])
    x = np.array([[1 << 61, -(1 << 61)], [7, 1]])
    exact = [[3 * int(v) - s for v, s in zip(row, centre.sums, strict=True)] for row in x]
    assert centre.spread(x).tolist() == exact
    assert centre.deviations(x).to_pylist() == [None, None]
    small = Centre(3, [10, 1])
    assert small.deviations(np.array([[3, 0]])).to_pylist() == [1 + 1]


def test_given_table(llm):
    rows = llm.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(200)
    local = rows.select("vec_id", "embedding").collect()
    found = whiten(rows).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    check(found.collect(), np.array([r.embedding for r in local]), [r.vec_id for r in local], 16)
    assert found.agg(F.max("component")).first()[0] == 16
