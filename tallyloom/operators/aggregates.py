"""Grouped aggregates: pivots, concatenation per key, location summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.sequences import ordered_batches

CELL_AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count,
}


def pivot(df: DataFrame, key: str, series: str, values: Sequence, measure: Column,
          how: str) -> DataFrame:
    """One row per key and one column per listed series value."""
    return df.groupBy(key).pivot(series, list(values)).agg(CELL_AGGREGATES[how](measure))


def pivot_long(df: DataFrame, key: str, series: str, measure: Column, how: str,
               name: str) -> DataFrame:
    return df.groupBy(key, series).agg(CELL_AGGREGATES[how](measure).alias(name))


def summary(df: DataFrame, location: str, measure: Column) -> DataFrame:
    """Every cell aggregate of a measure per location."""
    return df.groupBy(location).agg(
        *[f(measure).alias(f"{how}_value") for how, f in CELL_AGGREGATES.items()])


def partial_cells(df: DataFrame, keys: Sequence[str], measure: Column, added: Column) -> DataFrame:
    """Sum, count, least and greatest per cell, in a form that ``merged_cells`` can put together.

    ``added`` is what goes into the sum, an exact type where the order of
    adding must not matter.
    """
    return df.groupBy(*keys).agg(
        F.sum(added).alias("sum_value"), F.count(measure).alias("count_value"),
        F.min(measure).alias("min_value"), F.max(measure).alias("max_value"))


def merged_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of ``partial_cells`` added up per ``keys``, with ``avg_value``."""
    return cells.groupBy(*keys).agg(
        F.sum("sum_value").alias("sum_value"), F.sum("count_value").alias("count_value"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value")).withColumn(
        "avg_value", F.try_divide(F.col("sum_value").cast("double"), F.col("count_value")))


def pivot_cells(cells: DataFrame, key: str, series: str, values: Sequence, how: str) -> DataFrame:
    """One row per key and one column per listed series value; a value not listed is an error.

    ``how`` is sum, avg, min, max or count.
    """
    known = cells.withColumn(series, F.when(F.col(series).isin(list(values)) | F.col(series).isNull(), F.col(series))
                             .otherwise(F.raise_error(F.concat(F.lit("not in the pivot: "), F.col(series).cast("string")))))
    return merged_cells(known, [key, series]).groupBy(key).pivot(series, list(values)).agg(F.first(f"{how}_value"))


def group_counts(df: DataFrame, *by: str, name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *by)


def concatenated(df: DataFrame, key: Sequence[str], value: str, separator: str,
                 part_size: int = 1000) -> DataFrame:
    """Sorted values of a key joined to text, in numbered parts of ``part_size`` values.

    A key with few values has the single part 0; a very frequent key becomes
    several parts instead of one cell that holds the whole group.
    """
    parts = ordered_batches(df, key, value, part_size)
    return parts.select(
        *key, F.col("batch").alias("part"),
        F.array_join(F.col("items").cast("array<string>"), separator).alias("text"))
