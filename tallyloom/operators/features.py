"""Feature preparation with exact, repeatable results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordering import discrete_quantiles, with_position
from tallyloom.workspace import small_side


def bin_number(value: Column, splits: Sequence[float]) -> Column:
    """How many split points are not above the value; null stays null."""
    bins = F.lit(0.0)
    for s in splits:
        bins = bins + (value >= F.lit(s)).cast("double")
    return F.when(value.isNotNull(), bins)


def quantile_bins(df: DataFrame, value: str, buckets: int, name: str) -> DataFrame:
    """Bins of about equal size; equal cut points collapse, so there may be fewer bins."""
    cuts = discrete_quantiles(df, value, [i / buckets for i in range(1, buckets)])
    return df.withColumn(name, bin_number(F.col(value), sorted(set(cuts))))


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Categories numbered from 0 by falling frequency, ties in alphabetical order."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter(
        F.col(column).isNotNull())
    placed = with_position(counts, [], ["n", column], "place", descending=["n"])
    return placed.select(column, "n", (F.col("place") - 1).cast("double").alias("category_index"))


def with_category_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with the index of their category; an unseen or null one gets the next free index."""
    index = small_side(category_index(df, column).select(
        column, F.col("category_index").alias(name)))
    size = index.select(F.count(F.lit(1)).cast("double")).scalar()
    return df.join(index, column, "left").withColumn(name, F.coalesce(F.col(name), size))


def category_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with the dense code of their category in sorted order, from 0; -1 for a null category."""
    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    codes = with_position(distinct, [], [column], "_place").select(
        column, (F.col("_place") - 1).alias(name))
    return df.join(small_side(codes), column, "left").withColumn(name, F.coalesce(name, F.lit(-1).cast("long")))


def tokens(text: Column | str) -> Column:
    """Lower-case words split at every white-space character."""
    return F.split(F.lower(F.col(text) if isinstance(text, str) else text), "\\s")


def token_counts(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.explode(tokens(text)).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))
