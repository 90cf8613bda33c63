"""Exact positions and quantiles without a single-task sort.

Rows are range-partitioned on (group, order), so a group holding a third of
all rows is spread over many slices, and written out sorted.  A row's number
in the whole order is its place in its slice plus the sizes of the slices
before; there is one size per slice, so those fit on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.workspace import bounded_rows, join_on_keys, materialise, small_side

# How Spark builds its increasing ids, partition number above 33 bits of row number.
ROW_BITS = 33
ROW_MASK = (1 << ROW_BITS) - 1

MAX_WANTED = 10_000


def with_position(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    descending: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """Add the 1-based position of each row inside its group.

    ``order`` together with ``groups`` should identify a row; columns listed
    in ``descending`` sort high to low.  ``total`` names an optional column
    with the number of rows of the group.
    """
    keys = [*[F.col(g).asc() for g in groups],
            *[F.col(c).desc() if c in descending else F.col(c).asc() for c in order]]
    sliced = materialise(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
        .select("*", F.shiftright("_id", ROW_BITS).alias("_slice"),
                F.col("_id").bitwiseAND(F.lit(ROW_MASK)).alias("_row")).drop("_id"),
        "slices")
    placed = sliced.join(F.broadcast(_slice_starts(sliced)), "_slice").withColumn(
        "_place", F.col("_start") + F.col("_row"))
    if not groups:
        numbered = placed.select(*df.columns, (F.col("_place") + 1).alias(name))
        if total is None:
            return numbered
        return numbered.withColumn(total, sliced.select(F.count(F.lit(1))).scalar())
    firsts = placed.groupBy(*groups).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_total"))
    size = [F.col("_total").alias(total)] if total else []
    return join_on_keys(placed, small_side(firsts), groups).select(
        *df.columns, (F.col("_place") - F.col("_first") + 1).alias(name), *size)


def _slice_starts(sliced: DataFrame) -> DataFrame:
    """How many rows lie in the slices before each slice; one row per slice."""
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).orderBy("_slice").collect()
    starts = list(accumulate((r["n"] for r in sizes), initial=0))
    return sliced.sparkSession.createDataFrame(
        pa.table({"_slice": pa.array([r["_slice"] for r in sizes], pa.int64()),
                  "_start": pa.array(starts[:-1], pa.int64())}))


class Slices(NamedTuple):
    """Counted distinct values of a column per key, range-partitioned into slices."""

    values: DataFrame  # keys, _value, _n, _slice
    extents: DataFrame  # keys, _slice, _before, _amount, _total


def value_slices(df: DataFrame, keys: Sequence[str], value: str,
                 weight: str | None = None) -> Slices:
    """Count the distinct values of each key and lay them out in order.

    Counting first means a value held by many rows travels once per task.
    With ``weight`` a row counts that many times.
    """
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    counts = (
        df.withColumn("_value", F.col(value)).filter("_value is not null")
        .groupBy(*keys, "_value").agg(amount.alias("_n")))
    values = materialise(
        counts.repartitionByRange(*keys, "_value").withColumn("_slice", F.spark_partition_id()),
        "values")
    sizes = values.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_amount"))
    # one row per slice and key, so the window of a key is as long as the number of slices
    key = W.partitionBy(*(keys or [F.lit(0)]))
    earlier = key.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    extents = sizes.select(
        "*", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_amount").over(key).alias("_total"))
    return Slices(values, extents)


def values_at(slices: Slices, keys: Sequence[str],
              ranks: Callable[[Column], Column]) -> DataFrame:
    """The values at wanted ranks: (keys, ``_total``, ``_wanted``, ``_value``).

    ``ranks`` turns a key's total into an array of structs with a ``rank``
    field, counted from 1; each comes back as ``_wanted``.  Only the slices
    that hold a wanted rank are read and ordered.
    """
    rank = F.col("_wanted.rank")
    holding = (
        slices.extents.withColumn("_wanted", F.explode(ranks(F.col("_total"))))
        .filter((rank > F.col("_before")) & (rank <= F.col("_before") + F.col("_amount")))
        .groupBy(*keys, "_slice", "_before", "_total")
        .agg(F.collect_list("_wanted").alias("_wanted")))
    values, few = slices.values, bounded_rows(holding, MAX_WANTED)
    if few is not None:
        numbers = sorted(set(few.column("_slice").to_pylist()))
        values = values.filter(F.col("_slice").isin(numbers))
        holding = F.broadcast(values.sparkSession.createDataFrame(few, holding.schema))
    inside = W.partitionBy(*keys, "_slice").orderBy("_value").rowsBetween(W.unboundedPreceding, 0)
    reached = join_on_keys(values, holding, [*keys, "_slice"]).withColumn(
        "_last", F.col("_before") + F.sum("_n").over(inside))
    hit = F.filter("_wanted", lambda w: (w["rank"] <= F.col("_last"))
                   & (w["rank"] > F.col("_last") - F.col("_n")))
    return reached.select(*keys, "_total", "_value", F.explode(hit).alias("_wanted"))


def quantiles_of(slices: Slices, keys: Sequence[str],
                 probabilities: Sequence[float]) -> DataFrame:
    """Interpolated quantiles: (keys, ``p``, ``quantile``)."""
    def ranks(total: Column) -> Column:
        return F.array(*[
            F.struct(F.lit(float(p)).alias("p"), F.lit(side).alias("side"),
                     (side_of(F.lit(float(p)) * (total - 1)) + 1).alias("rank"))
            for p in probabilities for side, side_of in (("low", F.floor), ("high", F.ceil))])

    def side(name: str) -> Column:
        return F.max(F.when(F.col("_wanted.side") == name, F.col("_value").cast("double")))

    at = F.col("p") * (F.col("_total") - 1)
    return (
        values_at(slices, keys, ranks).groupBy(*keys, "_total", F.col("_wanted.p").alias("p"))
        .agg(side("low").alias("_low"), side("high").alias("_high"))
        .select(*keys, "p", (F.col("_low") + (F.col("_high") - F.col("_low")) * (at - F.floor(at)))
                .alias("quantile")))


def quantiles(df: DataFrame, keys: Sequence[str], value: str,
              probabilities: Sequence[float]) -> DataFrame:
    return quantiles_of(value_slices(df, keys, value), keys, probabilities)


def discrete_quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> list[float]:
    """Actual values at the given fractions of the whole column, lowest first."""
    def ranks(total: Column) -> Column:
        return F.array(*[
            F.struct(F.lit(i).alias("i"),
                     F.greatest(F.ceil(F.lit(float(p)) * total), F.lit(1)).alias("rank"))
            for i, p in enumerate(probabilities)])

    rows = values_at(value_slices(df, [], value), [], ranks).select(
        "_wanted.i", F.col("_value").cast("double").alias("value")).orderBy("i").collect()
    return [row["value"] for row in rows]
