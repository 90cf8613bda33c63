"""Streaming aggregates, joins and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.joins import salted_join
from tallyloom.workspace import sized

STAMP = "yyyy-MM-dd HH:mm:ss"


def running_count(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def windowed_count(rows: DataFrame, at: str, *keys: str, length: str, slide: str | None = None,
                   start: str | None = None, late: str | None = None) -> DataFrame:
    """Counts per key and time window; ``late`` sets the watermark append mode needs."""
    if late:
        rows = rows.withWatermark(at, late)
    window = F.window(at, length, slide, start).alias("window")
    return rows.groupBy(*keys, window).agg(F.count(F.lit(1)).alias("n"))


def window_bounds(counts: DataFrame) -> DataFrame:
    """Window bounds as text next to the other columns."""
    others = [c for c in counts.columns if c != "window"]
    return counts.select(
        *others, F.date_format("window.start", STAMP).alias("window_start"),
        F.date_format("window.end", STAMP).alias("window_end"))


def with_dimension(rows: DataFrame, dimension: DataFrame, key: str,
                   max_bytes: int | None = None, salts: int = 16, spread_by: Sequence[str] = ()) -> DataFrame:
    """Stream-static inner join; ``spread_by`` as in ``salted_join``.

    The static side is written when the stream is set up, so its size is known
    and cannot grow while the stream runs.  One of at most ``max_bytes``
    (``workspace.SMALL_BYTES``) is broadcast.  A larger one is joined with salted
    keys, because adaptive execution does not split a frequent key of a stream.
    """
    dimension, small = sized(dimension, max_bytes)
    if small:
        return rows.join(F.broadcast(dimension), key)
    return salted_join(rows, dimension, [key], salts, spread_by)


def daily(rows: DataFrame, at: str, day: str = "day") -> DataFrame:
    return rows.withColumn(day, F.date_format(at, "dd.MM.yyyy"))


def key_value_text(counts: DataFrame, key: str, measure: str) -> DataFrame:
    """Rows for a topic: the key and ``key:measure`` text."""
    return counts.select(
        F.col(key).cast("string").alias("key"),
        F.concat_ws(":", F.col(key).cast("string"), F.col(measure).cast("string")).alias("value"))
