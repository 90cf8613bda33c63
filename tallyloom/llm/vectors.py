"""Vector tables for the searches: equal vectors collapsed, results spread back over their rows.

A vector's copies differ only in id, and ties go to smaller ids, so the first
k + 1 ids of each distinct vector are all that a top-k search can return.  A
vector held by a third of all rows is thus searched for and found once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.workspace import materialise


NO_SCORE = 1 - (1 << 63)  # where no long holds a score; its negative is a long too


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, infinite or undefined component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def scaled_whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as doubles, which hold it exactly."""
    # floor gives a long, which holds no larger numbers, and those are whole
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    return F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x) + 0.0)


def moderate(vector: str) -> Column:
    """No component so large that a double cannot hold its square."""
    return F.forall(vector, lambda x: F.abs(x) < 1e150)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (_id, _vec) as a written table: _vid, _first, _ids (the k + 1 smallest), _vec."""
    ranked = rows.select("_vec", "_id").distinct().withColumn(
        "_n", F.row_number().over(W.partitionBy("_vec").orderBy("_id"))).where(F.col("_n") <= k + 1)
    grouped = ranked.groupBy("_vec").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
    return materialise(grouped.select(
        F.monotonically_increasing_id().alias("_vid"), F.col("_ids")[0].alias("_first"), "_ids", "_vec"), "vectors")


def query_vectors(rows: DataFrame, wanted: Column, vectors: DataFrame) -> DataFrame:
    """(_query, _vid) of the rows that ask, as a written table."""
    asking = rows.where(wanted).select(F.col("_id").alias("_query"), "_vec").distinct()
    return materialise(asking.join(vectors.select("_vid", "_vec"), "_vec").select("_query", "_vid"), "queries")


def best(found: DataFrame, asking: DataFrame, vectors: DataFrame, k: int, times: int = 1) -> DataFrame:
    """query_id, rank, vec_id, score from scored vectors ``found`` (_vid of the query, _other, _score, _of).

    ``found`` has some k + 1 rows for each block a query vector met, and a
    vector up to ``times`` times; ``_of`` is the smallest id of the vector
    found.  Each task drops what cannot be among the best before rows move.
    """
    order = W.partitionBy("_vid").orderBy(F.col("_score").desc(), "_of", "_other")
    few = found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= (k + 1) * times)
    top = few.groupBy("_vid").agg(F.slice(F.array_sort(F.collect_set(F.struct(
        (-F.col("_score")).alias("worse"), F.col("_of").alias("of"), F.col("_other").alias("other")))), 1, k + 1).alias("_top"))
    pairs = asking.join(top, "_vid").select("_query", F.explode("_top").alias("_t"))
    spread = pairs.join(vectors.select("_vid", "_ids"), F.col("_t.other") == F.col("_vid")).select(
        "_query", (-F.col("_t.worse")).alias("score"), F.explode("_ids").alias("vec_id")).where("vec_id <> _query")
    # one id may stand for several vectors; each of them is a candidate of its own
    order = W.partitionBy("_query").orderBy(F.col("score").desc(), "vec_id")
    return spread.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("_query").alias("query_id"), "rank", "vec_id", "score")


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    """Lists of numbers as rows; shorter lists end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), width), kind)
    sizes = np.diff(column.offsets.to_numpy())
    row = np.repeat(np.arange(len(column)), sizes)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def leading(scores: np.ndarray, first: np.ndarray, k: int, slack: float = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of at least the k best of each row, ties to smaller ``first``; ``slack`` keeps near ties."""
    n, m = scores.shape
    if m <= k:
        return np.repeat(np.arange(n), m), np.tile(np.arange(m), n)
    edge = np.partition(scores, m - k, axis=1)[:, m - k]
    row, col = np.nonzero(scores >= (edge - slack)[:, None])
    if slack == 0:
        order = np.lexsort((first[col], -scores[row, col], row))
        row, col = row[order], col[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, col = row[place < k], col[place < k]
    return row, col


def whole_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers given as doubles; ``NO_SCORE`` where no long holds them."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    reach = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if reach < 2.0**53:
        return (a @ b.T).astype(np.int64)
    large = [np.abs(x).max(1) * math.sqrt(x.shape[1]) >= 2.0**26 for x in (a, b)]
    out = np.empty((len(a), len(b)), np.int64)
    small = [~x for x in large]
    out[np.ix_(small[0], small[1])] = (a[small[0]] @ b[small[1]].T).astype(np.int64)
    for rows, cols in ((large[0], small[1] | large[1]), (small[0], large[1])):
        if rows.any() and cols.any():
            exact = _integers(a[rows]) @ _integers(b[cols]).T
            out[np.ix_(rows, cols)] = [[v if NO_SCORE < v < 1 << 63 else NO_SCORE for v in row] for row in exact]
    return out


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], object)
