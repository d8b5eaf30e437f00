"""Whitening against numpy's eigenvectors, and the parts of spectrum slicing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopledger.llm import whitening
from shopledger.llm.common import table


def symmetric(rng, values):
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


def test_inertia():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 30):
        for _ in range(20):
            m = symmetric(rng, rng.normal(size=n))
            assert whitening.inertia(m) == (np.linalg.eigvalsh(m) > 0).sum()
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1  # no pivot on the diagonal
    assert whitening.inertia(np.zeros((3, 3))) == 0 and whitening.inertia(np.zeros((0, 0))) == 0


@pytest.mark.parametrize("values", [
    [9.0, 8.0, 7.5, 3.0, 1.0, 0.5], [5.0, 5.0 - 1e-7, 5.0 - 3e-7, 2.0, 1e-3], [4.0, 4.0, 4.0, 1.0], [3.0] + [1e-18] * 4, [1e9, 1.0, 1e-3], [7.0], [0.0, 0.0],
    list(np.linspace(1, 2, 64)), list(1.0 + 1e-5 * np.arange(40)),
])
def test_leading(values):
    m = symmetric(np.random.default_rng(2), np.array(values))
    found, vectors = whitening.leading(m, 16)
    want = np.sort(np.linalg.eigvalsh(m))[::-1][:16]
    want = want[want > 1e-13 * max(want.max(), 1e-300)] if max(values) else want[:0]
    assert len(found) == len(want) and np.abs(found - want).max(initial=0) <= 1e-12 * max(values)
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max(initial=0) < 1e-8
    assert np.abs(m @ vectors.T - vectors.T * found).max(initial=0) <= 1e-11 * max(values)


def brute(rows):
    """{(vec_id, place among its rows): values} of one length of vectors, and what all share."""
    x = [(i, [math.floor(64.0 * c) + 1_000_000 for c in np.array(v, np.float64)]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors.T[::-1][:16]
    return [(i, n, sum((n * c - int(s)) ** 2 for c, s in zip(v, sums)), (np.array(v) - sums / n) @ vectors.T / np.sqrt(values)) for i, v in x], values / np.trace(cov)


def check(df, rows):
    got = {}
    for r in whitening.whiten(df).collect():
        got.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    want, explained = brute(rows)
    signs = None
    assert len(got) == len({(i, d) for i, _, d, _ in want})
    for i, n, deviation, white in want:
        own = got[i, deviation]
        assert sorted(own) == list(range(1, len(white) + 1))
        values = np.array([own[c].whitened for c in sorted(own)])
        signs = np.sign(values * white) if signs is None else signs
        assert np.abs(values * signs - white).max() < 1e-7
        for c, r in own.items():
            assert r.n == n and abs(r.explained / explained[c - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening(spark):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(400, 20)) * np.linspace(2, 0.2, 20)).astype(np.float32)
    x[300:] = x[:100]  # repeated vectors count once
    x[250] = x[251] + 1e-4  # and those that are equal as whole numbers, mostly
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(900, None), (901, [None] + [1.0] * 19), (902, [float("nan")] * 20), (903, [float("inf")] + [0.0] * 19)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("x", F.lit("x")).withColumn("n", F.lit(1)).repartition(5)
    check(df, rows)


def test_given_tables(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    check(df, [(r.vec_id, r.embedding) for r in df.collect()])


def test_odd_tables(spark):
    kind = "vec_id long, embedding array<double>"
    none = spark.createDataFrame([], kind)
    assert whitening.whiten(none).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)] + [(9, [])], kind)
    assert whitening.whiten(same).collect() == []  # no variance
    two = spark.createDataFrame([(None, [0.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 2.0, 3.0]), (3, [5.0, 2.0, 3.0]), (4, [0.0] * 6)], kind)
    got = sorted(((r.vec_id or 0, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in whitening.whiten(two).collect()))
    # one direction for each of two lengths, none for a lone vector; 64 apart, so each lies 1 off in its own measure
    assert got == [(i, 1, 2, d, pytest.approx(1.0), pytest.approx(1.0)) for i, d in ((0, 4096), (1, 4096), (1, 4096), (2, 65536), (3, 65536))]
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0])], kind)
    assert {r.deviation for r in whitening.whiten(huge).collect()} == {None, 16384}  # the third lies near the mean
