"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hard_negatives as hn
from tallyloom.llm import vectors


def _table(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 3) for r in rows], "vec_id long, embedding array<float>, label int, _score double, rank int")


def _brute(rows, step):
    good = dict.fromkeys((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), c) for i, v, c in rows
                         if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v))
    out = []
    for q, v, c in good:
        if q % step:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), o, d) for o, w, d in good if o != q]
        scored = sorted((-s, o, d) for s, o, d in scored if -(1 << 63) < s < 1 << 63)
        for p, o, _ in [x for x in scored if x[2] == c][:5]:
            near = [(-n, m) for n, m, d in scored if d != c and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(q, o, k + 1, m, -p, n) for k, (n, m) in enumerate(near)]
    return sorted(out)


def _found(spark, rows, step):
    found = hn.hard_negatives(_table(spark, rows).repartition(3), F.col("_id") % step == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def _clustered(seed, n=260, width=6):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((6, width))
    return [(i, [float(x) for x in centres[i % 6] * random.uniform(0.3, 2) + 0.25 * random.standard_normal(width)],
             int(random.integers(0, 3)) if i % 4 else (i % 6) % 3) for i in range(n)]


@pytest.mark.parametrize("cut", [None, (8, 30, 20)])
def test_hard_negatives_are_brute_force(spark, monkeypatch, cut):
    if cut:  # several groups, short heads and many blocks
        for name, value in zip(("MEMBERS", "HEAD", "BLOCK"), cut):
            monkeypatch.setattr(hn, name, value)
    rows = _clustered(1)
    rows += [(1000 + i, rows[10][1], rows[10][2]) for i in range(40)]  # copies of one label
    rows += [(2000 + i, rows[10][1], i % 3) for i in range(30)]  # and of several
    rows += [(3000, None, 1), (3010, [1.0, None] + [0.0] * 4, 1), (3020, [float("nan")] * 6, 1), (3030, [float("inf")] * 6, 1),
             (3040, [0.5] * 6, None), (None, [0.5] * 6, 1), (3050, [], 1), (3060, [0.0] * 6, 2), (3070, [1.0, 2.0], 0),
             (3080, [0.5] * 6, 77), rows[5], rows[5]]
    assert _found(spark, rows, 10) == _brute(rows, 10)


def test_scores_of_any_size(spark):
    rows = [(0, [9e6, 1.0], 1), (1, [9e6, 2.0], 1), (2, [8e6, 5.0], 2), (3, [1e30, 1.0], 1), (4, [7e6, 1.0], 2), (5, [1.0, 1.0], 1),
            (10, [1.0, 1.0], 1), (6, [8e11, 0.0], 1), (7, [7e11, 3.0], 3), (8, [1e-3, 0.5], 2), (20, [0.0, 0.0], 1), (21, [0.0, 0.0], 2)]
    assert _found(spark, rows, 10) == _brute(rows, 10)


def test_no_rows_no_positives_no_negatives(spark):
    rows = [(0, [1.0, 2.0], 1)]
    for some in ([], rows, rows + [(1, [1.0, 2.0], 2)], rows + [(1, [1.0, 2.0], 1)], [(7, [1.0], 1), (8, [0.9], 2)]):
        assert _found(spark, some or [(None, None, None)], 10) == _brute(some, 10) == []


def test_products():
    random = np.random.default_rng(2)
    a, b = np.floor(random.standard_normal((7, 5)) * 1e3), np.floor(random.standard_normal((9, 5)) * 1e3)
    a[2], b[3] = a[2] * 1e5, b[3] * 1e11
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert vectors.whole_products(a, b).tolist() == [[v if abs(v) < 1 << 63 else vectors.NO_SCORE for v in r] for r in exact]


def test_bounds_hold_and_end_lists_early():
    random = np.random.default_rng(3)
    centres = random.standard_normal((4, 16))
    data = np.floor(256 * np.concatenate([c + 0.05 * random.standard_normal((500, 16)) for c in centres]))
    members = data[::50]
    directions = hn.directions_of(members, 4)
    size, angle = hn._angles(members, directions)
    group = angle.argmin(1)
    reach = np.array([angle[group == g, g].max() for g in range(4)])
    lists = hn.Lists(directions, reach, float(np.linalg.norm(data, axis=1).max()))
    bounds = lists.bounds(data)
    needed = 0
    for q, n, g in zip(members, size, group):
        scores = data @ q
        assert (scores <= n * bounds[:, g] * (1 + 1e-9)).all()
        needed += (n * bounds[:, g] >= np.sort(scores)[-6]).mean()
    assert needed / len(members) < 0.4  # of a list, on clustered rows
