"""Whitening against numpy on all rows, and its defined cases."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from shoptide.llm import queries, whitening

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, n STRING"


def brute(rows, top=8):
    """x-vectors in Python integers, the covariance in doubles from exactly centred rows."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    sums = [sum(v[j] for v in x) for j in range(d)]
    y = np.array([[float(Fraction(n * v[j] - sums[j], n)) for j in range(d)] for v in x])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviations = [sum((n * v[j] - sums[j]) ** 2 for j in range(d)) for v in x]
    white = y @ vectors[:, :top] / np.sqrt(values[:top])
    return [i for i, _ in good], n, deviations, white, values[:top] / np.trace(y.T @ y / n)


def compare(rows, found):
    ids, n, deviations, white, explained = brute(rows)
    k = white.shape[1]
    assert len(found) == len(ids) * k
    by_component = {c: {} for c in range(1, k + 1)}
    for r in found:
        assert r.n == n and r.identity_error <= 1e-6
        by_component[r.component][r.vec_id] = r
    for c in range(1, k + 1):
        got = by_component[c]
        mine = np.array([got[i].whitened for i in ids])
        sign = np.sign(mine @ white[:, c - 1])
        assert np.allclose(mine * sign, white[:, c - 1], rtol=1e-8, atol=1e-8)
        assert [got[i].deviation for i in ids] == [v if v < 2**63 else None for v in deviations]
        assert all(math.isclose(got[i].explained, explained[c - 1], rel_tol=1e-9) for i in ids)


def test_table_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, folder, "embeddings").collect()]
    compare(rows, queries.op13_whitening(spark, folder).collect())


@pytest.mark.parametrize("spread", [1.0, 1e-4])
def test_badly_conditioned_rows(spark, spread):
    """Dimensions of very different size that nearly depend on each other."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 9)) * np.array([3000.0, 900, 300, 90, 30, 9, 3, 1, 0.5])
    mixed = base @ np.linalg.qr(rng.normal(size=(9, 9)))[0]
    mixed[:, 8] = mixed[:, 0] * 0.5 + mixed[:, 8] * spread
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA).repartition(5)
    compare(rows, whitening.whiten(df).collect())


def test_odd_vectors_are_left_out(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in rng.normal(size=10)]) for i in range(40)]
    odd = [
        (100, None), (101, []), (102, [1.0] * 9 + [None]), (103, [1.0] * 9 + [math.nan]),
        (104, [math.inf] + [0.0] * 9), (105, [1e300] * 10), (106, [1.0, 2.0]),
    ]
    df = spark.createDataFrame([(i, v, None, "x") for i, v in rows + odd], SCHEMA)
    compare(rows, whitening.whiten(df).collect())


def test_repeated_and_null_ids_count(spark):
    rng = np.random.default_rng(7)
    vectors = [[float(c) for c in rng.normal(size=9)] for _ in range(30)]
    rows = [(1, vectors[0]), (1, vectors[0]), (None, vectors[1]), *((i, v) for i, v in enumerate(vectors, 10))]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    found = whitening.whiten(df).collect()
    assert len(found) == 33 * 8 and {r.n for r in found} == {33}
    assert sum(r.vec_id == 1 for r in found) == 16 and sum(r.vec_id is None for r in found) == 8


def test_fewer_rows_than_dimensions(spark):
    """Four points span three directions."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(size=12) * 10]) for i in range(4)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    found = whitening.whiten(df).collect()
    assert {r.component for r in found} == {1, 2, 3}
    assert sum(r.explained for r in found if r.vec_id == 0) == pytest.approx(1)
    assert max(r.identity_error for r in found) < 1e-6


def test_constant_dimension_and_equal_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [*(float(c) for c in rng.normal(size=3)), 7.0]) for i in range(50)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    assert {r.component for r in whitening.whiten(df).collect()} == {1, 2, 3}
    equal = spark.createDataFrame([(i, [1.0, 2.0], 0, "x") for i in range(5)], SCHEMA)
    assert whitening.whiten(equal).collect() == []


def test_empty_table(spark):
    found = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert found.columns == [f.split()[0] for f in whitening.WHITENED.split(", ")]
    assert found.collect() == []


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i) * 2.0**40, 0.0]) for i in range(4)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    found = whitening.whiten(df).collect()
    assert {r.component for r in found} == {1} and {r.deviation for r in found} == {None}


def test_substitution_and_factor():
    rng = np.random.default_rng(10)
    factor, rows = np.triu(rng.normal(size=(6, 6))) + 4 * np.eye(6), rng.normal(size=(20, 6))
    assert np.allclose(whitening.substitute(factor, rows.T).T @ factor, rows)
    singular = np.outer(np.ones(3), np.ones(3))
    upper = whitening.cholesky(singular, 0.0)
    assert np.allclose(upper, np.triu(upper)) and np.allclose(upper.T @ upper, singular, atol=1e-12)
