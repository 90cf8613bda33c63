"""Series and text cut into training windows.

Every row is given its position in its series.  A series is then cut into
chunks of bounded length, each with the few rows that follow it, and windows
are taken inside the chunks.  So a row travels about once whatever the overlap
is, and no task gathers a whole series, however long one series is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.ordering import with_position
from tallyloom.operators.ranking import share_of_total
from tallyloom.workspace import join_on_keys, small_side

CHUNK = 4096


def ordered_batches(df: DataFrame, keys: Sequence[str], value: str, size: int) -> DataFrame:
    """Values of a key in order, in numbered batches of at most ``size`` items."""
    placed = with_position(df.select(*keys, value), keys, [value])
    return (
        placed.groupBy(*keys, F.floor((F.col("position") - 1) / size).alias("batch"))
        .agg(F.array_sort(F.collect_list(value)).alias("items"))
    )


def window_count(length: Column, size: int, stride: int, legacy_count: bool) -> Column:
    """How many windows a series of ``length`` values has.

    ``legacy_count`` keeps the historic rule, which can leave out the last
    complete window when the stride is above 1.
    """
    if legacy_count:
        return F.floor((length - (size - 1)) / stride)
    return F.floor((length - size) / stride) + 1


def series_windows(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str,
    size: int,
    overlap: int,
    legacy_count: bool = False,
) -> DataFrame:
    """Fixed-size windows of each series: (series, ``window_id``, ``items``).

    ``window_id`` counts from 0 and a window starts every ``size - overlap``
    values.  The incomplete tail is dropped; the historic rule also wants a
    series to be longer than one window.  The values of a chunk are gathered
    once and windows are cut from them, so the work is that of the values plus
    that of the windows, whatever the overlap.
    """
    if not 0 < size or not 0 <= overlap < size:
        raise ValueError("0 <= overlap < size is required")
    stride = size - overlap
    columns = list(dict.fromkeys([*series, *order, value]))
    placed = with_position(df.select(*columns), series, order, total="_length")
    least = size + 1 if legacy_count else size
    length = max(CHUNK, size)
    at = F.col("position") - 1
    chunked = (
        placed.filter(F.col("_length") >= least)
        .select(*series, at.alias("_at"), "_length", F.col(value).alias("_value"),
                F.floor(at / length).alias("_own"))
        .withColumn("_chunk", F.explode(
            F.when((F.col("_own") > 0) & (F.col("_at") % length < size - 1),
                   F.array(F.col("_own"), F.col("_own") - 1))
            .otherwise(F.array("_own")))))
    gathered = chunked.groupBy(*series, "_chunk").agg(
        F.sort_array(F.collect_list(F.struct("_at", "_value"))).alias("_held"), F.max("_length").alias("_length"))
    begin = F.col("_chunk") * length
    first = F.ceil(begin / stride)
    last = F.least(F.ceil((begin + length) / stride), window_count(F.col("_length"), size, stride, legacy_count)) - 1
    return (
        gathered.withColumns({"_first": first.cast("long"), "_last": last.cast("long")}).filter("_first <= _last")
        .withColumn("window_id", F.explode(F.sequence("_first", "_last")))
        .select(*series, "window_id", F.slice(
            "_held", (F.col("window_id") * stride - begin + 1).cast("int"), F.lit(size))["_value"].alias("items"))
    )


def features_and_label(windows: DataFrame, items: str = "items") -> DataFrame:
    """All values but the last as features, the last one as label."""
    features = F.slice(F.col(items), F.lit(1), F.size(items) - 1)
    return windows.withColumns(
        {"features": features, "label": F.element_at(items, -1)}).drop(items)


def last_value_error(samples: DataFrame) -> DataFrame:
    """Predict each label by the value before it."""
    return samples.withColumn("prediction", F.element_at("features", -1)).withColumn(
        "error", F.col("prediction") - F.col("label"))


def chronological_split(df: DataFrame, series: Sequence[str], order: Sequence[str],
                        fraction: float) -> DataFrame:
    """Mark the first ``floor(fraction * length)`` rows of each series as training rows."""
    placed = with_position(df, series, order, total="_length")
    return placed.withColumn(
        "is_train", F.col("position") <= F.floor(F.lit(fraction) * F.col("_length"))
    ).drop("_length")


def chronological_window_split(windows: DataFrame, series: Sequence[str], fraction: float) -> DataFrame:
    """Mark the first ``floor(fraction * windows)`` windows of each series as training windows."""
    counts = windows.groupBy(*series).agg(F.count(F.lit(1)).alias("_windows"))
    return join_on_keys(windows, counts, series).withColumn(
        "is_train", F.col("window_id") < F.floor(F.lit(fraction) * F.col("_windows"))).drop("_windows")


def transitions(df: DataFrame, series: Sequence[str], order: Sequence[str],
                symbol: str) -> DataFrame:
    """How often each symbol follows another, and its share of all that follow."""
    pairs = series_windows(df, series, order, symbol, 2, 1)
    counts = pairs.groupBy(
        F.col("items")[0].alias("previous"), F.col("items")[1].alias("following")
    ).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counts, ["previous"], "n")


def char_windows(df: DataFrame, text: str, length: int, stride: int) -> DataFrame:
    """Prefixes of ``length`` characters and the character after each.

    Windows start at 0, ``stride``, ... while a next character exists; a text
    not longer than the prefix has none.  One pattern walks the text and looks
    ahead at every start, so the cost grows with the length and not with its
    square, as taking substrings by number would.  Very long texts are cut
    first, which bounds the windows held at once.
    """
    piece = 16_384 * stride
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(piece))
    others = [c for c in df.columns if c != text]
    pieces = df.withColumn("_offset", F.explode(starts)).withColumn(
        text, F.substring(F.col(text), F.col("_offset") + 1, F.lit(piece + length)))
    ahead = F.lit(f"(?s)(?=(.{{{length + 1}}})).{{1,{stride}}}")
    windows = pieces.select(
        *others, "_offset",
        F.posexplode(F.regexp_extract_all(text, ahead, F.lit(1))).alias("_n", "_window"))
    return windows.select(
        *others, (F.col("_offset") + F.col("_n") * stride).alias("start"),
        F.substring("_window", 1, length).alias("prefix"),
        F.substring("_window", length + 1, 1).alias("next_char"))


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Distinct characters with dense codes in sorted order and the scaled code."""
    letters = df.select(F.explode(F.split(F.col(text), "")).alias("character"))
    distinct = letters.filter(F.col("character") != "").distinct()
    coded = with_position(distinct, [], ["character"], "_rank", total="_size")
    return coded.select("character", (F.col("_rank") - 1).alias("code"),
                        ((F.col("_rank") - 1) / F.col("_size")).alias("scaled"))


def one_hot_positions(samples: DataFrame, prefix: str, vocabulary_df: DataFrame) -> DataFrame:
    """Sparse one-hot rows: one (sample, place, code) per character."""
    spelled = samples.select(
        "*", F.posexplode(F.split(F.col(prefix), "")).alias("place", "character")
    ).filter(F.col("character") != "").drop(prefix)
    codes = small_side(vocabulary_df.select("character", "code"))
    return spelled.join(codes, "character").drop("character")


def corrupted(samples: DataFrame, prefix: str, length: int, filler: str = "?") -> DataFrame:
    """One variant per place of a prefix, with that place overwritten."""
    return samples.withColumn(
        "place", F.explode(F.sequence(F.lit(1), F.lit(length)))
    ).withColumn(
        "variant", F.overlay(F.col(prefix), F.lit(filler), F.col("place"), F.lit(1)))
