"""Top rows: per group with ties, over the whole table, and share of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.workspace import join_on_keys


def top_per_group(totals: DataFrame, group: Sequence[str], measure: str, n: int) -> DataFrame:
    """Rows ranked ``n`` or better by ``measure`` in their group; ties share a rank.

    Null and zero totals do not take part.  The rank limit is applied by every
    task before the shuffle, so a large group sends at most its best rows.
    """
    best = W.partitionBy(*group).orderBy(F.col(measure).desc())
    return (
        totals.filter(F.col(measure).isNotNull() & (F.col(measure) != 0))
        .withColumn("place", F.rank().over(best))
        .filter(F.col("place") <= n)
    )


def top_known_per_group(totals: DataFrame, group: Sequence[str], measure: str, n: int,
                        labels: Sequence[str], unknown: str = "Unknown") -> DataFrame:
    """``top_per_group`` where unknown labels use up places and are removed afterwards."""
    kept = top_per_group(totals, group, measure, n)
    for label in labels:
        kept = kept.filter(F.col(label) != unknown)
    return kept


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)


def share_of_total(totals: DataFrame, whole: Sequence[str], measure: str,
                   name: str = "share") -> DataFrame:
    """Each row's part of the sum over its ``whole`` (of all rows if there is no such column).

    Sums are joined back rather than taken over a window, so a whole with very
    many rows is not one task.
    """
    share = F.try_divide(F.col(measure), F.col("_sum"))
    if not whole:
        summed = totals.withColumn("_sum", totals.select(F.sum(measure)).scalar())
    else:
        sums = totals.groupBy(*whole).agg(F.sum(measure).alias("_sum"))
        summed = join_on_keys(totals, sums, whole)
    return summed.withColumn(name, share).drop("_sum")
