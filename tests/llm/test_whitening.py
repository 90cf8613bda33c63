"""Whitening against plain arithmetic on whole numbers and a plain eigenvalue solver."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.whitening import OFFSET, SCALE, eigenvectors, exact_gram, whiten


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 5, 0.5) for i, v in rows], "vec_id long, embedding array<float>, n int, whitened double")


def _good(rows):
    kept = [(i, [float(np.float32(x)) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in kept)
    return [(i, [math.floor(SCALE * x) + OFFSET for x in v + [0.0] * (width - len(v))]) for i, v in kept]


def _check(found, rows, components=8):
    good = _good(rows)
    n, width = len(good), len(good[0][1])
    sums = [sum(x[d] for _, x in good) for d in range(width)]
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(x, sums)] for _, x in good])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > 1e-9 * values[0]).sum())
    per = min(components, rank)
    assert len(found) == n * per
    deviation = sorted((i if i is not None else -1, sum((n * v - s) ** 2 for v, s in zip(x, sums))) for i, x in good)
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.deviation) for r in found if r.component == 1) == deviation
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error <= 1e-9
    for c in range(1, per + 1):
        own = sorted((r for r in found if r.component == c), key=lambda r: (r.vec_id if r.vec_id is not None else -1, r.whitened))
        assert np.allclose([r.explained for r in own], values[c - 1] / np.trace(covariance), rtol=1e-9)
        gaps = [abs(values[c - 1] - v) for k, v in enumerate(values) if k != c - 1]
        if min(gaps) > 1e-6 * values[0]:
            expected = centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            ids = [i if i is not None else -1 for i, _ in good]
            mine = {}
            for i, v in zip(ids, expected):
                mine.setdefault(i, []).append(v)
            sign = 1 if np.dot(expected, [next(r.whitened for r in own if (r.vec_id if r.vec_id is not None else -1) == i) for i in ids]) > 0 else -1
            assert np.allclose(sorted(r.whitened for r in own), sorted(sign * expected), atol=1e-7)


@pytest.mark.parametrize("seed", [1, 2])
def test_whitening_is_plain_arithmetic(spark, seed):
    random = np.random.default_rng(seed)
    mixed = random.standard_normal((12, 12)) * np.logspace(0, -2, 12)
    rows = [(i, [float(x) for x in random.standard_normal(12) @ mixed]) for i in range(300)]
    rows += [(400, None), (401, [1.0, None] + [0.0] * 10), (402, [float("nan")] * 12), (403, [float("inf")] * 12),
             (404, [0.5] * 5), (405, []), (None, [0.25] * 12), (7, rows[7][1]), (7, rows[7][1]), (500, [1e-30] * 12)]
    found = whiten(_table(spark, rows).repartition(4)).collect()
    _check(found, rows)


def test_given_tables(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = QUERIES["op12_whitening"](spark, folder)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    _check(found.collect(), rows)


def test_no_rows_one_row_and_equal_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(5)]
    assert whiten(_table(spark, rows).where("vec_id > 9")).collect() == []
    assert whiten(_table(spark, [(1, None)])).collect() == []
    assert whiten(_table(spark, [(1, [])])).collect() == []
    assert whiten(_table(spark, rows[:1])).collect() == [] and whiten(_table(spark, rows)).collect() == []


def test_large_and_few_entries(spark):
    rows = [(0, [3e15, 1.0]), (1, [0.0, 2.0]), (2, [-1e15, 5.0]), (3, [1e30, 0.0])]
    found = whiten(_table(spark, rows)).collect()
    assert {r.deviation for r in found} == {None} and all(math.isfinite(r.whitened) for r in found)
    narrow = [(i, [float(i), 0.0, 7.0]) for i in range(10)]  # one direction only
    _check(whiten(_table(spark, narrow)).collect(), narrow)


def test_products_are_exact():
    for reach in (10, 2**20, 2**26, 2**40):
        z = np.random.default_rng(0).integers(-reach, reach, (50, 4))
        whole = [[sum(int(a[i]) * int(a[j]) for a in z) for j in range(4)] for i in range(4)]
        assert exact_gram(z).tolist() == whole


@pytest.mark.parametrize("values", [
    [1.0, 0.5, 0.25, 0.1, 0.01, 1e-6],
    [1.0, 1.0, 1.0, 0.5, 0.5, 0.1],  # equal values
    [1.0, 1.0 - 1e-9, 1.0 - 2e-9, 0.5, 0.5 + 1e-12, 1e-3],  # closer than float32 can tell
    [1.0, 1.0 - 3e-15, 0.3, 0.3 - 1e-8, 1e-9, 1e-9 + 1e-15],
    [0.0, 0.0, 0.0, 0.0, 0.0, 2.0],
])
def test_refined_vectors_are_right_to_double_precision(values):
    random = np.random.default_rng(6)
    q = np.linalg.qr(random.standard_normal((6, 6)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(6, dtype=np.longdouble) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    found, x = eigenvectors(a)
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-15)
    wide = x.astype(np.longdouble)
    assert float(np.abs(wide.T @ wide - np.eye(6)).max()) < 1e-15
    assert float(np.abs(a @ wide - wide * found).max()) < 4e-16
    for v in set(values):  # each eigenspace against the one it was made from
        gap = min([abs(v - w) for w in values if w != v] or [1])
        own, mine = q[:, [w == v for w in values]], wide[:, [abs(w - v) < gap / 2 for w in found]]
        assert mine.shape == own.shape
        assert float(np.abs(mine - own @ (own.T @ mine)).max()) < max(1e-15, 3e-18 / gap)


def test_refinement_beats_float32():
    random = np.random.default_rng(9)
    b = random.standard_normal((40, 40))
    a = (b @ b.T).astype(np.longdouble)
    values, x = eigenvectors(a)
    plain = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(float)
    own, other = (float(np.abs(a.astype(float) @ y - y * np.diag(y.T @ a.astype(float) @ y)).max()) for y in (x, plain))
    assert own < 1e-12 and own < other / 1e4
