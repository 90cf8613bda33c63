"""Exact and approximate search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import ann
from tallyloom.llm.ann import nearest
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.topk_join import exact_topk


def _table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double, _vid int")


def _brute(rows, k, step, measure):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault((i, tuple(np.float32(x) for x in v)))
    good = [(i, measure(v)) for i, v in good]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.concatenate([v, np.zeros(width - len(v), v.dtype)])) for i, v in good]
    out = []
    for q, v in good:
        if q % step == 0:
            found = sorted(((-(v @ o), i) for i, o in good if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def _whole(v):
    return np.floor(256 * np.array(v, dtype=float)).astype(np.int64)


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_topk_is_brute_force(spark, seed):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((5, 8))
    data = np.concatenate([c + 0.1 * random.standard_normal((60, 8)) for c in centres])
    rows = [(i, [float(np.float32(x)) for x in v], 0.0, 1) for i, v in enumerate(data)]
    rows += [(1000 + i, rows[7][1], 0.0, 1) for i in range(200)]  # copies
    rows += [(2000, None, 0.0, 1), (2010, [1.0, None] + [0.0] * 6, 0.0, 1), (2020, [float("nan")] * 8, 0.0, 1),
             (2030, [float("inf")] * 8, 0.0, 1), (2040, [], 0.0, 1), (2050, [1.0, 2.0], 0.0, 1), (None, [1.0] * 8, 0.0, 1),
             (5, rows[5][1], 0.0, 1), (2060, [0.0] * 8, 0.0, 1)]
    found = exact_topk(_table(spark, rows).repartition(5), F.col("_id") % 10 == 0, 5)
    assert sorted(tuple(r) for r in found.collect()) == _brute(rows, 5, 10, _whole)


def test_large_numbers_stay_exact(spark):
    rows = [(0, [4e6, 1.0], 0.0, 1), (1, [4e6, 1.0], 0.0, 1), (2, [4e6, 2.0], 0.0, 1), (3, [1e30, 1.0], 0.0, 1)]
    found = [tuple(r) for r in exact_topk(_table(spark, rows), F.col("_id") == 0, 5).collect()]
    big = (256 * 4_000_000) ** 2
    assert found == [(0, 1, 2, big + 256 * 512), (0, 2, 1, big + 256 * 256)]


def test_components_of_any_size_take_part(spark):
    rows = [(0, [1.0, 1.0], 0.0, 1), (1, [1.0, 2.0], 0.0, 1), (2, [9e6, 1.0], 0.0, 1), (3, [9e6, 9e6], 0.0, 1), (4, [1e10, 3.0], 0.0, 1),
            (5, [-2e9, 7.0], 0.0, 1), (6, [3e37, 1.0], 0.0, 1), (7, [3e37, 2.0], 0.0, 1), (10, [9.5e6, 0.5], 0.0, 1)]
    found = sorted(tuple(r) for r in exact_topk(_table(spark, rows).repartition(3), F.col("_id") % 10 == 0, 1).collect())
    whole = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, *_ in rows}

    def best(q):
        scores = {i: sum(a * b for a, b in zip(whole[q], w)) for i, w in whole.items() if i != q}
        return max(((s, -i) for i, s in scores.items() if abs(s) < 1 << 63))

    assert found == [(q, 1, -best(q)[1], best(q)[0]) for q in (0, 10)]


@pytest.mark.parametrize("search", [exact_topk, nearest])
def test_no_rows_and_lone_rows(spark, search):
    rows = [(0, [1.0, 2.0], 0.0, 1)]
    assert search(_table(spark, rows).where("vec_id = 7"), F.col("_id") >= 0, 3).collect() == []
    assert search(_table(spark, rows), F.col("_id") >= 0, 3).collect() == []


def test_nearest_on_small_tables_finds_all(spark):
    random = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in random.standard_normal(6)], 0.0, 1) for i in range(60)]
    rows += [(100 + i, rows[3][1], 0.0, 1) for i in range(30)] + [(200, [0.0] * 6, 0.0, 1), (201, None, 0.0, 1), (202, [], 0.0, 1)]
    found = sorted(tuple(r) for r in nearest(_table(spark, rows), F.col("_id") % 20 == 0, 20).collect())
    valid = [r for r in rows if r[1] and any(r[1])]
    brute = _brute(valid, 20, 20, lambda v: np.array(v, dtype=float))
    assert [f[:3] for f in found] == [b[:3] for b in brute]
    assert np.allclose([f[3] for f in found], [b[3] for b in brute])


def test_recall(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    data = np.array(rows.embedding.tolist(), dtype=float)
    found = QUERIES["op8_nearest"](spark, folder).toPandas()
    hit = total = 0
    for q, part in found.groupby("query_id"):
        at = int(np.flatnonzero(rows.vec_id == q)[0])
        score = data @ data[at]
        score[at] = -9
        best = set(rows.vec_id.iloc[np.argsort(-score)[:20]])
        hit, total = hit + len(best & set(part.vec_id)), total + 20
    assert hit / total >= 0.9


def test_cells_keep_their_size():
    random = np.random.default_rng(0)
    data = random.standard_normal((60_000, 16))
    cells = ann.Cells(16, len(data), float(np.linalg.norm(data, axis=1).max()))
    assert len(cells.axes) >= 2
    codes = cells.of(data[:2000])
    assert (cells.probes(data[:10])[:, :, 0] >= 0).all() and codes.shape == (2000, ann.TABLES)
    turned = ann.hadamard(data[:5])
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(data[:5], axis=1))


def _simulated(data, queries, k=20):
    """Recall of the chosen tables and probes for other queries, and the share of rows they visit."""
    longest = float(np.linalg.norm(data, axis=1).max())
    band = ann._band_of(np.linalg.norm(data, axis=1), longest)
    sizes = {int(b): (int((band == b).sum()), float(np.linalg.norm(data[band == b], axis=1).max())) for b in np.unique(band)}

    def true(asked):
        score = data[asked] @ data.T
        score[np.arange(len(asked)), asked] = -np.inf
        return np.argsort(-score, axis=1)[:, :k]

    tried = np.arange(100)
    bands = ann.chosen(ann.Bands(data.shape[1], longest, sizes), data[tried], np.repeat(tried, k), data[true(tried).ravel()])
    codes, seen = bands.of(data)[1], np.zeros((len(queries), len(data)), bool)
    for b, cells in bands.cells.items():
        looked, mine = cells.probes(data[queries]), np.flatnonzero(band == b)
        for i in range(len(queries)):
            for t in range(bands.tables):
                seen[i, mine] |= np.isin(codes[mine, t], looked[i, t])
    return np.take_along_axis(seen, true(queries), 1).mean(), seen.mean()


@pytest.mark.parametrize(("factor", "cell"), [(1, 20), (20, ann.CELL)])
def test_recall_where_few_rows_are_visited(monkeypatch, factor, cell):
    monkeypatch.setattr(ann, "CELL", cell)  # small cells: as many as a table 16 times as large has
    data = np.random.default_rng(8).standard_normal((40_000, 32))
    data /= np.linalg.norm(data, axis=1)[:, None]
    data[500] *= factor  # one vector many times longer
    recall, visited = _simulated(data, np.arange(1000, 1040))
    assert recall >= 0.95 and visited < 0.75
