"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are scaled to unit length and turned by fast pseudo-rotations (signs,
then a Hadamard transform, three times over); the nearest signed axis is the
cell.  With more data a cell is the combination of several rotations, so cells
stay of similar size.  Each of several tables holds every vector once; a query
probes the cells of the axes that lie nearest to it.  Cells are solved in
blocks, and the scores are exact inner products of the original vectors.

Vectors fall into bands of similar length, each with cells of its own, and a
query probes every band.  In a band, vectors are extended by one component that
makes all of them equally long, which keeps the order of inner products.

Tables and probes are chosen for the table at hand: the true neighbours of
``TRIED`` queries are found by brute force over all rows, and the cheapest of
the choices whose probes reach a share of ``RECALL`` of them is taken.  Probes
grow up to all cells, so there always is one.

Measured recall against brute force is in the README and the tests.  Defined
results: vectors that are null, zero or hold a null, infinite or undefined
component take no part, nor do those without an id; shorter vectors count as
ending in zeros; repeated rows count once; a lone vector has no neighbours;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.vectors import best, distinct_vectors, leading, matrix, query_vectors, usable

TABLES = 8  # at least
PROBES = 12  # at least
MOST_TABLES = 32
TRIED, RECALL = 128, 0.97
BANDS = 40  # lengths of a band differ by the root of two at most; the last band has all shorter ones
CELL = 320  # vectors that a cell should hold
BLOCK = 4096  # data vectors solved together
ASKING = 512  # queries solved together
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast transform of each row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


class Cells:
    """The hash functions: ``axes[j]`` leading axes, with signs, of the j-th rotation of each table."""

    def __init__(self, width: int, rows: int, longest: float, tables: int = TABLES, probes: int = PROBES) -> None:
        self.width, self.longest = width, longest
        self.tables, self.most = tables, probes
        self.full = 1 << max(1, math.ceil(math.log2(width + 1)))  # one component more
        wanted = max(2.0, rows / CELL)
        self.axes: list[int] = []
        while wanted > 1.5 and len(self.axes) < 5:
            m = min(self.full, 1 << max(0, round(math.log2(wanted)) - 1))
            self.axes.append(m)
            wanted /= 2 * m
        random = np.random.default_rng(SEED)
        self.signs = random.choice([-1.0, 1.0], (tables, len(self.axes), 3, self.full))  # fewer tables are the first of more
        self.cells = math.prod(2 * m for m in self.axes)

    def _turned(self, x: np.ndarray, table: int, j: int) -> np.ndarray:
        for s in self.signs[table, j]:
            x = hadamard(x * s)
        part = x[:, : self.axes[j]]
        return np.concatenate([part, -part], axis=1)

    def _unit(self, x: np.ndarray, asking: bool) -> np.ndarray:
        wide = np.zeros((len(x), self.full))
        wide[:, : self.width] = x
        if not asking:
            wide[:, self.width] = np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(1)))
        return wide / np.maximum(np.linalg.norm(wide, axis=1), 1e-300)[:, None]

    def of(self, x: np.ndarray) -> np.ndarray:
        """Cell of each row in each table."""
        x = self._unit(x, False)
        out = np.zeros((len(x), self.tables), np.int64)
        for t in range(self.tables):
            for j, m in enumerate(self.axes):
                out[:, t] = out[:, t] * (2 * m) + self._turned(x, t, j).argmax(1)
        return out

    def probes(self, x: np.ndarray) -> np.ndarray:
        """Cells to look into, rows x tables x probes; -1 where there are fewer."""
        x = self._unit(x, True)
        out = np.full((len(x), self.tables, self.most), -1, np.int64)
        for t in range(self.tables):
            cell, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
            for j, m in enumerate(self.axes):
                turned = self._turned(x, t, j)
                near = np.argsort(-turned, axis=1, kind="stable")[:, :self.most]
                value = np.take_along_axis(turned, near, axis=1)
                loss = (value[:, :1] - value) ** 2
                cell = (cell[:, :, None] * (2 * m) + near[:, None, :]).reshape(len(x), -1)
                cost = (cost[:, :, None] + loss[:, None, :]).reshape(len(x), -1)
                keep = np.argsort(cost, axis=1, kind="stable")[:, :self.most]
                cell, cost = np.take_along_axis(cell, keep, 1), np.take_along_axis(cost, keep, 1)
            out[:, t, : cell.shape[1]] = cell
        return out


class Bands:
    """Cells for each band of lengths; tables are numbered through all bands."""

    def __init__(self, width: int, longest: float, sizes: dict[int, tuple[int, float]], tables: int = TABLES, probes: int = PROBES) -> None:
        """``sizes``: rows and greatest length of each band."""
        self.width, self.longest, self.sizes, self.tables, self.most = width, longest, sizes, tables, probes
        self.cells = {b: Cells(width, rows, top, tables, probes) for b, (rows, top) in sizes.items()}

    def band(self, x: np.ndarray) -> np.ndarray:
        return _band_of(np.sqrt((x * x).sum(1)), self.longest)

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band of each row, and its cell in each table of the band."""
        band, codes = self.band(x), np.zeros((len(x), self.tables), np.int64)
        for b in np.unique(band):
            codes[band == b] = self.cells[int(b)].of(x[band == b])
        return band, codes


def _band_of(length: np.ndarray, longest: float) -> np.ndarray:
    """0 for the longest; bands of numpy and not of Spark, so that all agree."""
    return np.minimum(BANDS - 1, np.floor(2 * np.log2(longest / np.minimum(length, longest)))).astype(np.int64)


def _lengths(width: int, longest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("_vec"), width, float)
            length = np.sqrt((x * x).sum(1))
            band = _band_of(length, longest)
            kinds, counts = np.unique(band, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds.astype(np.int32)), pa.array(counts), pa.array([length[band == k].max() for k in kinds])],
                ["_band", "_n", "_top"])
    return run


def _true(queries: np.ndarray, ids: np.ndarray, k: int):
    """The task's ``k`` best rows for each of a bounded set of queries, the query itself left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, vid = np.zeros((len(queries), 0)), np.zeros(0, np.int64)
        vectors = np.zeros((0, queries.shape[1]))
        for b in batches:
            x = matrix(b.column("_vec"), queries.shape[1], float)
            score = np.concatenate([score, queries @ x.T], axis=1)
            vid, vectors = np.concatenate([vid, b.column("_vid").to_numpy()]), np.concatenate([vectors, x])
            score[ids[:, None] == vid] = -np.inf
            kept = np.unique(np.argsort(-score, axis=1, kind="stable")[:, :k])
            score, vid, vectors = score[:, kept], vid[kept], vectors[kept]
        near = np.argsort(-score, axis=1, kind="stable")[:, :k]
        row, col = np.repeat(np.arange(len(queries)), near.shape[1]), near.ravel()
        real = np.isfinite(score[row, col])
        row, col = row[real], col[real]
        yield pa.RecordBatch.from_arrays(
            [pa.array(row.astype(np.int32)), pa.array(vid[col]), pa.array(score[row, col]), pa.array(list(vectors[col]), pa.list_(pa.float64()))],
            ["_q", "_other", "_score", "_vec"])
    return run


def chosen(bands: Bands, queries: np.ndarray, asked: np.ndarray, near: np.ndarray) -> Bands:
    """The cheapest tables and probes that reach RECALL of the pairs (queries[asked[i]], near[i])."""
    if not len(near):
        return bands
    cells, probes = max(c.cells for c in bands.cells.values()), PROBES
    while True:
        wide = Bands(bands.width, bands.longest, bands.sizes, MOST_TABLES, probes)
        band, codes = wide.of(near)
        hit = np.zeros((len(near), MOST_TABLES), bool)
        for b in np.unique(band):
            for begin in range(0, len(queries), 8):  # few at a time, for memory
                looked = wide.cells[int(b)].probes(queries[begin: begin + 8])
                for i in np.flatnonzero((band == b) & (asked >= begin) & (asked < begin + 8)):
                    hit[i] = (looked[asked[i] - begin] == codes[i][:, None]).any(axis=1)
        for tables in (TABLES, 2 * TABLES, MOST_TABLES):
            if hit[:, :tables].any(axis=1).mean() >= RECALL or (tables == MOST_TABLES and probes >= cells):
                return Bands(bands.width, bands.longest, bands.sizes, tables, probes)
        probes = min(2 * probes, max(cells, PROBES))


def _place(bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            band, codes = bands.of(matrix(b.column("_vec"), bands.width, float))
            for t in range(bands.tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((band * bands.tables + t).astype(np.int32)), pa.array(codes[:, t]),
                     b.column("_vid"), b.column("_first"), b.column("_vec")],
                    ["_table", "_cell", "_other", "_of", "_vec"])
    return run


def _look(bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for begin in range(0, b.num_rows, 100):
                part = b.slice(begin, 100)
                x = matrix(part.column("_vec"), bands.width, float)
                for band, cells in bands.cells.items():
                    probes = cells.probes(x)
                    row, table, at = np.nonzero(probes >= 0)
                    taken = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((band * bands.tables + table).astype(np.int32)), pa.array(probes[row, table, at]),
                         taken.column("_vid"), taken.column("_vec")], ["_table", "_cell", "_vid", "_vec"])
    return run


def fitted(vectors: DataFrame, asking: DataFrame, width: int, longest: float, k: int) -> Bands:
    """Bands with the tables and probes that a bounded set of queries needs."""
    found = vectors.select("_vec").mapInArrow(_lengths(width, longest), "_band int, _n long, _top double").groupBy("_band").agg(
        F.sum("_n").alias("_n"), F.max("_top").alias("_top")).collect()
    bands = Bands(width, longest, {r._band: (r._n, r._top) for r in found})
    tried = asking.select("_vid").distinct().orderBy(F.xxhash64("_vid"), "_vid").limit(TRIED)
    tried = vectors.select("_vid", "_vec").join(F.broadcast(tried), "_vid").toArrow().combine_chunks()
    if not found or not tried.num_rows:
        return bands
    queries, ids = matrix(tried.column("_vec"), width, float), tried.column("_vid").to_numpy()
    best_first = W.partitionBy("_q").orderBy(F.col("_score").desc(), "_other")
    near = vectors.select("_vid", "_vec").mapInArrow(_true(queries, ids, k), "_q int, _other long, _score double, _vec array<double>")
    near = near.withColumn("_n", F.row_number().over(best_first)).where(F.col("_n") <= k).select("_q", "_vec").toArrow()
    return chosen(bands, queries, near.column("_q").to_numpy(), matrix(near.column("_vec"), width, float))


_FOUND = pa.schema([("_vid", pa.int64()), ("_other", pa.int64()), ("_of", pa.int64()), ("_score", pa.float64())])


def _solve(width: int, k: int):
    def run(data: pa.Table, asking: pa.Table) -> pa.Table:
        q, o = (matrix(t.column("_vec"), width, float) for t in (asking, data))
        if not len(q) or not len(o):
            return _FOUND.empty_table()
        first = data.column("_of").to_numpy()
        rough = q @ o.T
        row, col = leading(rough, first, k + 1, 1e-9 * (1 + float(np.abs(rough).max())))
        # summed row by row, so that a pair has one score wherever it is met
        score = (q[row] * o[col]).sum(axis=1)
        return pa.table([asking.column("_vid").to_numpy()[row], data.column("_other").to_numpy()[col],
                         first[col], score], schema=_FOUND)
    return run


def nearest(table: DataFrame, wanted: Column, k: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products found for each row that ``wanted`` picks."""
    exact = F.transform(vector, lambda x: x.cast("double"))
    rows = table.where(usable(F.col(vector)) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("_id"), exact.alias("_vec")).where(F.exists("_vec", lambda x: x != 0))
    vectors = distinct_vectors(rows, k)
    asking = query_vectors(rows, wanted, vectors)
    squares = F.aggregate("_vec", F.lit(0.0), lambda s, x: s + x * x)
    width, longest = vectors.agg(F.max(F.size("_vec")), F.sqrt(F.max(squares))).first()
    cells = fitted(vectors, asking, width or 1, longest or 1.0, k)
    keys = ["_table", "_cell"]
    placed = vectors.select("_vid", "_first", "_vec").mapInArrow(
        _place(cells), "_table int, _cell long, _other long, _of long, _vec array<double>")
    queries = asking.select("_vid").distinct().join(vectors.select("_vid", "_vec"), "_vid")
    looked = queries.select("_vid", "_vec").mapInArrow(_look(cells), "_table int, _cell long, _vid long, _vec array<double>")
    # a cell with many vectors or many queries is solved in blocks
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).join(
        looked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m")), keys).select(
        *keys, F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"), F.ceil(F.col("_m") / ASKING).cast("int").alias("_parts"))
    data = placed.join(sizes, keys).withColumn("_block", F.pmod(F.xxhash64("_other"), "_blocks").cast("int")).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    ask = looked.join(sizes, keys).withColumn("_part", F.pmod(F.xxhash64("_vid"), "_parts").cast("int")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    block = [*keys, "_part", "_block"]
    found = data.select(*block, "_other", "_of", "_vec").groupBy(*block).cogroup(
        ask.select(*block, "_vid", "_vec").groupBy(*block)).applyInArrow(
        _solve(cells.width, k), "_vid long, _other long, _of long, _score double")
    return best(found, asking, vectors, k, cells.tables)
