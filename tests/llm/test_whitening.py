"""Whitened embeddings against exact fractions, and awkward vectors."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerline.llm.queries import op12_whitening
from ledgerline.llm.whitening import covariance, whiten

from helpers import SF

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        *[T.StructField(name, T.StringType()) for name in ("x", "n", "component", "i", "label")],
    ]
)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, *"abcde") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, keep):
    """Everything but signs, from whole numbers and fractions."""
    usable = [
        (i, tuple(int(np.floor(256 * float(c))) for c in v))
        for i, v in rows
        if v is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    fit = sorted({x for _, x in usable})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = [[n * x[k] - sums[k] for k in range(d)] for x in fit]
    exact = [[Fraction(sum(c[i] * c[j] for c in centred), n**3) for j in range(d)] for i in range(d)]
    values, vecs = np.linalg.eigh(np.array([[float(v) for v in row] for row in exact]))
    order = np.argsort(-values)[:keep]
    trace = float(sum(exact[k][k] for k in range(d)))
    out = {}
    for row, (i, x) in enumerate(usable):
        far = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        w = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ vecs[:, order] / np.sqrt(values[order])
        for c in range(len(order)):
            out.setdefault((i, c + 1), []).append((n, far, w[c], values[order[c]] / trace))
    return out


def compare(got, want):
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    assert found.keys() == want.keys()
    for c in {k[1] for k in want}:
        keys = [k for k in want if k[1] == c]
        a = np.array([v.whitened for k in keys for v in sorted(found[k], key=lambda r: (r.deviation, r.whitened))])
        b = np.array([v[2] for k in keys for v in sorted(want[k], key=lambda v: (v[1], v[2]))])
        assert np.allclose(a, b, atol=1e-7) or np.allclose(a, -b, atol=1e-7)
        for k in keys:
            assert sorted((r.n, int(r.deviation)) for r in found[k]) == sorted((v[0], v[1]) for v in want[k])
            assert found[k][0].explained == pytest.approx(want[k][0][3], rel=1e-9)
            assert found[k][0].identity_error < 1e-9


def test_query_over_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding) for r in rows], 4)
    compare(op12_whitening(spark, SF).collect(), want)


def test_repeats_nulls_and_far_values(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 5)) * [5, 3, 2, 1, 0.5] + [1e6, 0, -3e5, 7, 0]
    rows = [(k if k % 9 else None, list(map(float, v))) for k, v in enumerate(base)]
    rows += [rows[3]] * 30 + [(5, rows[6][1])]
    unusable = [
        (1, None), (2, []), (3, [1.0, None, 2.0, 3.0, 4.0]), (4, [float("nan")] * 5),
        (5, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (6, [1e300, 0.0, 0.0, 0.0, 0.0]), (7, [1.0, 2.0]),
    ]
    compare(whiten(vectors(spark, rows + unusable), 4).collect(), brute(rows, 4))


def test_sums_beyond_64_bits(spark):
    rows = [(k, [float((-1) ** k * (k + 1) * 2**45), float(k * k * 2**44), 3.0]) for k in range(9)]
    compare(whiten(vectors(spark, rows), 2).collect(), brute(rows, 2))


def test_little_or_no_variance(spark):
    one = whiten(vectors(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])]), 4).collect()
    assert sorted((r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained) for r in one) == [
        (i, c, 1, 0, None, 0.0) for i in (1, 2) for c in (1, 2)
    ]
    line = whiten(vectors(spark, [(k, [float(k), 2.0 * k, 1.0]) for k in range(4)]), 4).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True, 3: True}
    assert all(r.explained == (r.component == 1) and r.identity_error < 1e-9 for r in line)
    assert whiten(vectors(spark, [(1, None), (2, [])]), 4).count() == 0
    assert whiten(vectors(spark, [(1, [1.0])]).limit(0), 4).count() == 0


def test_covariance_from_squares():
    y = np.array([[1, 2, -3], [0, 5, 1], [-2, 2, 2], [4, 0, 0]])
    squares = {k: int((y[:, k] ** 2).sum()) for k in range(3)}
    for k, (i, j) in enumerate([(0, 1), (0, 2), (1, 2)]):
        squares[3 + k] = int(((y[:, i] + y[:, j]) ** 2).sum())
    found, trace = covariance(4, y.sum(axis=0).tolist(), squares)
    assert np.allclose(found, np.cov(y.T, bias=True)) and trace == pytest.approx(np.trace(found))
