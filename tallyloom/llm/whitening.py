"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

Entries become whole numbers, so column sums and centred products are added up
exactly, as whole numbers, in the tasks and across them; the driver gets one
sum per pair of dimensions and divides once.  Eigenvectors are found in
float32 and corrected by the matrix-multiplication iteration of Ogita and
Aishima, first in double and then in extended precision.  Where eigenvalues
lie too close for the iteration to part them, a shifted problem of the size of
the cluster is solved inside its subspace.

Defined results: rows whose vector is null or holds a null or non-finite entry
are dropped; shorter vectors count as ending in zeros; entries beyond 2**62
after scaling count as 2**62; repeated rows count as often as they stand; a
component with no variance (below ``LEAST`` of the trace for each dimension)
cannot be scaled and is left out; a deviation that no long can hold is null; an
empty table gives no rows; other columns are not read.  The driver holds
matrices of the size of the covariance, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.vectors import matrix, usable
from tallyloom.workspace import materialise

SCALE, OFFSET = 1024, 100_000
MOST = 2.0**62
LEAST = 2.0**-50
LIMB = 60  # bits; sums travel in three limbs, which Spark adds as decimals
ROUNDS = 40


def _whole(column: pa.Array, width: int) -> np.ndarray:
    scaled = np.floor(SCALE * matrix(column, width, float))
    return np.clip(scaled, -MOST, MOST).astype(np.int64) + OFFSET


def _limbs(pairs: list[tuple[int, int, int]]) -> pa.RecordBatch:
    mask = (1 << LIMB) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.int32()),
         pa.array([p[2] & mask for p in pairs], pa.int64()), pa.array([p[2] >> LIMB & mask for p in pairs], pa.int64()),
         pa.array([p[2] >> 2 * LIMB for p in pairs], pa.int64())], ["i", "j", "a", "b", "c"])


_LIMBS = "i int, j int, a long, b long, c long"


def _added(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Whole sums by (i, j)."""
    sums = parts.groupBy("i", "j").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in "abc"])
    return {(r.i, r.j): int(r.a) + (int(r.b) << LIMB) + (int(r.c) << 2 * LIMB) for r in sums.collect()}


def _column_sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for b in batches:
            x = _whole(b.column("_vec"), width)
            safe = float(np.abs(x).max(initial=0)) * len(x) < MOST
            total += (x if safe else x.astype(object)).sum(0).astype(object)
        yield _limbs([(i, i, int(s)) for i, s in enumerate(total)])
    return run


def exact_gram(z: np.ndarray) -> np.ndarray:
    """z'z of whole numbers, exactly, as Python integers."""
    reach = float(np.abs(z).max(initial=0)) ** 2
    if reach >= 2.0**53:
        z = z.astype(object)
        return z.T @ z
    step = max(1, int(2.0**53 / max(1.0, reach)) - 1)  # so many rows stay exact in double
    total = np.zeros((z.shape[1],) * 2, object)
    for begin in range(0, len(z), step):
        part = z[begin: begin + step].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _products(middle: list[int], width: int):
    centre = np.array(middle, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for b in batches:
            total += exact_gram(_whole(b.column("_vec"), width) - centre)
        yield _limbs([(i, j, int(total[i, j])) for i in range(width) for j in range(i, width)])
    return run


def _correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One iteration: corrected vectors, values, the gap below which values count as one, and how far ``x`` was off."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    rest = s - np.diag(values)
    norm = float(np.linalg.norm(a.astype(float), 2))
    off = float(max(np.abs(r).max(), np.abs(rest).max() / norm))
    # closer pairs would be turned by more than the square root of the error, and the iteration would not converge
    gap = norm * max(2 * float(np.linalg.norm(rest.astype(float), 2) / norm + np.linalg.norm(r.astype(float), 2)), 4 * np.sqrt(off))
    apart = values[None, :] - values[:, None]
    far = np.abs(apart) > gap
    e = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
    return x + x @ e, values, gap, off


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of values that the gap does not part, two at least."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def _part_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, gap: float) -> np.ndarray:
    """Solves a shifted problem in the subspace of each cluster."""
    x = x.copy()
    for places in _clusters(values, gap):
        inside = x[:, places]
        shift = values[places].mean()
        small = inside.T @ (a @ inside - shift * inside)
        size = np.abs(small).max()
        if size > 0:
            _, turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(float))
            turn = turn.astype(a.dtype)
            turn += turn @ (np.eye(len(places), dtype=a.dtype) - turn.T @ turn) / 2  # orthogonal beyond double
            x[:, places] = inside @ turn
    return x


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, falling, and unit vectors of a symmetric matrix given in extended precision, largest entries positive."""
    size = np.abs(a).max(initial=0)
    if size == 0:
        return np.zeros(len(a)), np.eye(len(a))
    scaled = a / size
    _, start = np.linalg.eigh(scaled.astype(np.float32))
    best = start.astype(np.float64)
    for kind in (np.float64, np.longdouble):
        level = scaled.astype(kind)
        x, least, waited = best.astype(kind), np.inf, 0
        for _ in range(ROUNDS):
            following, values, gap, off = _correction(level, x)
            waited = 0 if off < 0.5 * least else waited + 1
            if off < least:
                best, least = x, off
            if off <= np.finfo(kind).eps or waited > 3:
                break
            x = _part_clusters(level, following, values, gap)
    x = best
    values = np.diag(x.T @ (scaled @ x)) / (x * x).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x * x).sum(0))[order]
    x = x * np.sign(x[np.abs(x).argmax(0), np.arange(len(x))])
    return (values[order] * size).astype(float), x.astype(float)


class Whitening(NamedTuple):
    """What the fit list gives: everything is exact but the rounding of values and vectors."""

    n: int
    width: int
    middle: list[int]  # whole numbers next to the means
    rest: list[int]  # n times the distance of the means from them
    values: np.ndarray  # of the components, falling
    vectors: np.ndarray  # one column per component
    trace: float


def fitted(rows: DataFrame, components: int) -> Whitening | None:
    """The whitening of ``rows`` (_vec); None for an empty table."""
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("_vec"))).first()
    if not n or not width:
        return None
    sums = [s for _, s in sorted(_added(rows.select("_vec").mapInArrow(_column_sums(width), _LIMBS)).items())]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    products = _added(rows.select("_vec").mapInArrow(_products(middle, width), _LIMBS))
    covariance, trace = np.zeros((width, width), np.longdouble), Fraction(0)
    for (i, j), total in products.items():
        exact = Fraction(n * total - rest[i] * rest[j], n * n)
        trace += exact if i == j else 0
        high = float(exact)
        covariance[i, j] = covariance[j, i] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    values, vectors = eigenvectors(covariance)
    kept = (values > float(trace) * width * LEAST) & (np.arange(width) < components)
    return Whitening(n, width, middle, rest, values[kept], vectors[:, kept], float(trace))


def _white(fit: Whitening):
    centre, turned = np.array(fit.middle, np.int64), fit.vectors / np.sqrt(fit.values)
    rest = np.array(fit.rest, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = _whole(b.column("_vec"), fit.width) - centre
            most = float(np.abs(z).max(initial=0)) + 1
            d = fit.n * (z if most * fit.n < MOST else z.astype(object)) - (rest.astype(np.int64) if most * fit.n < MOST else rest)
            plain = d.astype(float)
            size = (plain * plain).sum(1)
            known = size < 2.0**62
            deviation: list[int | None] = [None] * len(d)
            for i, v in zip(np.flatnonzero(known).tolist(), (d[known].astype(np.int64) ** 2).sum(1).tolist()):
                deviation[i] = v
            for i in np.flatnonzero(~known & (size < 2.0**64)).tolist():
                v = sum(int(y) ** 2 for y in d[i])
                deviation[i] = v if v < 1 << 63 else None
            white = (plain / fit.n) @ turned
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(deviation, pa.int64()),
                 pa.ListArray.from_arrays(np.arange(0, white.size + 1, max(1, white.shape[1]), dtype=np.int32), white.ravel())],
                ["_id", "deviation", "_white"])
    return run


def whiten(table: DataFrame, components: int = 8, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = table.where(usable(F.col(vector))).select(
        F.col(id_column).cast("long").alias("_id"), F.transform(vector, lambda x: x.cast("double")).alias("_vec"))
    fit = fitted(rows, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None or not len(fit.values):
        return table.sparkSession.createDataFrame([], schema)
    white = materialise(rows.mapInArrow(_white(fit), "_id long, deviation long, _white array<double>"), "whitened")
    places = range(len(fit.values))
    means = white.agg(*[F.avg(F.col("_white")[i]) for i in places]).first()
    centred = [F.col("_white")[i] - F.lit(means[i]) for i in places]
    pairs = [(i, j) for i in places for j in range(i, len(places))]
    found = white.agg(*[F.sum(centred[i] * centred[j]) for i, j in pairs]).first()
    error = max(abs(s / fit.n - (i == j)) for (i, j), s in zip(pairs, found))
    share = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values])
    return white.select("_id", "deviation", F.posexplode("_white").alias("_at", "whitened")).select(
        F.col("_id").alias("vec_id"), (F.col("_at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(share, F.col("_at") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"))
