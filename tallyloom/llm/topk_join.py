"""Exact top-k search by inner product: a Voronoi kNN join.

Query vectors are grouped by their nearest pivot; a pivot p and the largest
distance u of a group's queries from it bound every score of the group:
p.o - u|o| <= q.o <= p.o + u|o|.  The (k+1)-th largest lower bound over all
data is a score that every query of the group is sure to reach, so a vector
whose upper bound lies below it is not sent to that group.  What is left is
solved exactly, in blocks of data against parts of a group.

Components become floor(256 * x); scores are whole numbers of any size, which
are computed with Python's integers where doubles are not exact.  Defined
results: vectors that are null or hold a null, infinite or undefined component
take no part, nor do those without an id or with a component of 1e150 or more
after scaling; a score that no long can hold is left out; shorter vectors
count as ending in zeros; repeated rows count once; a table without other rows
gives queries no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.vectors import (
    NO_SCORE,
    best,
    distinct_vectors,
    leading,
    matrix,
    moderate,
    query_vectors,
    scaled_whole,
    usable,
    whole_products,
)
from tallyloom.workspace import materialise

GROUP = 256  # queries that a pivot stands for on average, and the most that are solved together
BLOCK = 4096  # data vectors solved together
PIVOTS = 1024  # most pivots, a bound on what the driver holds
SCALE = 256


def _nearest(pivots: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = matrix(b.column("_vec"), width, float)
            far = (q * q).sum(1)[:, None] - 2 * q @ pivots.T + (pivots * pivots).sum(1)
            group = far.argmin(1)
            gap = np.linalg.norm(q - pivots[group], axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("_vid"), pa.array(group, pa.int32()), pa.array(gap), b.column("_vec")],
                ["_vid", "_group", "_gap", "_vec"])
    return run


def _bounds(pivots: np.ndarray, reach: np.ndarray, width: int, k: int):
    """Per task and group, the k + 1 largest scores that some data vector is sure to give."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.full((len(pivots), 0), 0.0)
        for b in batches:
            o = matrix(b.column("_vec"), width, float)
            low = pivots @ o.T - reach[:, None] * np.linalg.norm(o, axis=1)
            # a score that may not fit a long is no sure one
            most = (np.linalg.norm(pivots, axis=1) + reach)[:, None] * np.linalg.norm(o, axis=1)
            low = np.where(most < 2.0**62, low, -np.inf)
            held = np.concatenate([held, low], axis=1)
            if held.shape[1] > k + 1:
                held = -np.partition(-held, k, axis=1)[:, : k + 1]
        group = np.repeat(np.arange(len(pivots)), held.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), pa.array(held.ravel())], ["_group", "_low"])
    return run


def _needed(pivots: np.ndarray, reach: np.ndarray, floor: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            o = matrix(b.column("_vec"), width, float)
            size = np.linalg.norm(o, axis=1)
            high = o @ pivots.T + size[:, None] * reach
            slack = 1e-9 * (1 + size[:, None] * (np.linalg.norm(pivots, axis=1) + reach))
            row, group = np.nonzero(high + slack >= floor)
            taken = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(group, pa.int32()), taken.column("_vid"), taken.column("_first"), taken.column("_vec")],
                ["_group", "_other", "_of", "_vec"])
    return run


def _solve(width: int, k: int):
    def run(data: pa.Table, asking: pa.Table) -> pa.Table:
        q, o = (matrix(t.column("_vec"), width, float) for t in (asking, data))
        first = data.column("_of").to_numpy()
        if not len(q) or not len(o):
            return _FOUND.empty_table()
        scores = whole_products(q, o)
        row, col = leading(scores, first, k + 1)
        fits = scores[row, col] > NO_SCORE
        row, col = row[fits], col[fits]
        return pa.table([asking.column("_vid").to_numpy()[row], data.column("_other").to_numpy()[col],
                         first[col], scores[row, col]], schema=_FOUND)
    return run


_FOUND = pa.schema([("_vid", pa.int64()), ("_other", pa.int64()), ("_of", pa.int64()), ("_score", pa.int64())])


def exact_topk(table: DataFrame, wanted: Column, k: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each row that ``wanted`` picks."""
    rows = table.where(usable(F.col(vector)) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("_id"), scaled_whole(F.col(vector), SCALE).alias("_vec")).where(moderate("_vec"))
    vectors = distinct_vectors(rows, k)
    asking = query_vectors(rows, wanted, vectors)
    queries = asking.select("_vid").distinct().join(vectors.select("_vid", "_vec"), "_vid")
    width = vectors.agg(F.max(F.size("_vec"))).first()[0] or 1
    count = queries.count()
    chosen = queries.orderBy(F.xxhash64("_vec"), "_vid").limit(
        min(PIVOTS, max(1, math.ceil(count / GROUP)))).select("_vec").toArrow()
    pivots = matrix(chosen.column(0), width, float) if chosen.num_rows else np.zeros((1, width))

    grouped = materialise(queries.select("_vid", "_vec").mapInArrow(
        _nearest(pivots, width), "_vid long, _group int, _gap double, _vec array<double>"), "groups")
    reach, sizes = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for r in grouped.groupBy("_group").agg(F.max("_gap").alias("u"), F.count(F.lit(1)).alias("n")).collect():
        reach[r["_group"]], sizes[r["_group"]] = r["u"] * (1 + 1e-12), r["n"]
    lows = vectors.select("_vec").mapInArrow(_bounds(pivots, reach, width, k), "_group int, _low double")
    floor = np.full(len(pivots), -np.inf)
    # reduced once more per group; a task sends k + 1 rows per group at most
    for r in lows.groupBy("_group").agg(F.slice(F.sort_array(F.collect_list("_low"), False), k + 1, 1).alias("t")).collect():
        if r["t"]:
            floor[r["_group"]] = r["t"][0] - 1e-9 * (1 + abs(r["t"][0]))
    floor[sizes == 0] = np.inf

    needed = materialise(vectors.select("_vid", "_first", "_vec").mapInArrow(
        _needed(pivots, reach, floor, width), "_group int, _other long, _of long, _vec array<double>"), "needed")
    spark = table.sparkSession
    parts = spark.createDataFrame(
        [(r["_group"], math.ceil(r["n"] / BLOCK), math.ceil(int(sizes[r["_group"]]) / GROUP))
         for r in needed.groupBy("_group").agg(F.count(F.lit(1)).alias("n")).collect()],
        "_group int, _blocks int, _parts int")
    data = needed.join(F.broadcast(parts), "_group").withColumn(
        "_block", F.pmod(F.xxhash64("_other"), "_blocks").cast("int")).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    ask = grouped.join(F.broadcast(parts), "_group").withColumn(
        "_part", F.pmod(F.xxhash64("_vid"), "_parts").cast("int")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    keys = ["_group", "_part", "_block"]
    found = data.select(*keys, "_other", "_of", "_vec").groupBy(*keys).cogroup(
        ask.select(*keys, "_vid", "_vec").groupBy(*keys)).applyInArrow(
        _solve(width, k), "_vid long, _other long, _of long, _score long")
    return best(found, asking, vectors, k)

