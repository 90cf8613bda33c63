"""Shrunken group effects: how far each group's mean lies from the overall mean.

A group of n rows with mean m gets n * (m - overall) / (n + shrinkage).  Rows
are first summed per combination of groups; every later step works on those
cells, whose number does not grow with the rows per cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyloom.functions.statistics import pearson
from tallyloom.workspace import materialise, sized


def cells(df: DataFrame, factors: Sequence[str], value: Column) -> DataFrame:
    return df.groupBy(*factors).agg(
        F.count(value).alias("n"), F.sum(value).cast("double").alias("total"))


def overall_mean(cell_df: DataFrame) -> float:
    row = cell_df.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    return row["total"] / row["n"]


def one_factor(cell_df: DataFrame, factor: str, centre: Column, shrinkage: float) -> DataFrame:
    """Effects of one factor, given what the rest of the model expects per row of a cell."""
    return (
        cell_df.groupBy(F.col(factor).alias("level"))
        .agg(F.sum("n").alias("n"), F.sum(F.col("total") - F.col("n") * centre).alias("excess"))
        .select(F.lit(factor).alias("factor"), F.col("level").cast("string").alias("level"), "n",
                (F.col("excess") / F.col("n")).alias("raw"),
                (F.col("excess") / (F.col("n") + F.lit(float(shrinkage)))).alias("effect")))


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def effects(cell_df: DataFrame, factors: Sequence[str], shrinkage: float) -> DataFrame:
    """Each factor on its own against the overall mean."""
    kept = materialise(cell_df, "cells")
    centre = F.lit(overall_mean(kept))
    return _stacked([one_factor(kept, f, centre, shrinkage) for f in factors])


def backfitted(cell_df: DataFrame, factors: Sequence[str], shrinkage: float,
               passes: int = 3, max_levels: int = 50_000) -> DataFrame:
    """All factors together: each is refitted in turn against the others' current effects.

    The cells carry the current effects as columns and are written out after
    each pass, which keeps the plan short.  Effects are broadcast to the cells
    when their factor has been counted to have at most ``max_levels`` levels.
    """
    current = materialise(cell_df, "cells")
    few = {f: current.select(f).distinct().limit(max_levels + 1).count() <= max_levels
           for f in factors}
    mean = F.lit(overall_mean(current))
    current = current.withColumns({f"_{f}": F.lit(0.0) for f in factors})
    for step in range(passes):
        for factor in factors:
            others = [F.col(f"_{f}") for f in factors if f != factor]
            update = one_factor(current, factor, sum(others, mean), shrinkage).select(
                "level", F.col("effect").alias(f"_{factor}"))
            current = current.drop(f"_{factor}").join(
                F.broadcast(update) if few[factor] else update,
                F.col(factor).cast("string").eqNullSafe(F.col("level"))).drop("level")
        current = materialise(current, f"backfit_{step}")
    return _stacked([
        current.groupBy(F.col(f).cast("string").alias("level"))
        .agg(F.sum("n").alias("n"), F.max(f"_{f}").alias("effect"))
        .select(F.lit(f).alias("factor"), "level", "n", "effect") for f in factors])


def compared(first: DataFrame, second: DataFrame, keys: Sequence[str], a: str,
             b: str) -> DataFrame:
    """Agreement of two effect tables per factor: correlation and largest difference."""
    joined = first.select(*keys, F.col(a).alias("_a")).join(
        second.select(*keys, F.col(b).alias("_b")), list(keys))
    return joined.groupBy(keys[0]).agg(
        F.count(F.lit(1)).alias("levels"), pearson("_a", "_b").alias("correlation"),
        F.max(F.abs(F.col("_a") - F.col("_b"))).alias("largest_difference"))


class MixedModel(NamedTuple):
    """A fitted model of an overall level, one slope and crossed random effects."""

    levels: DataFrame  # factor, level, n, effect, deviation (of the effect, given the data)
    terms: DataFrame  # term, estimate: intercept, slope, variance of each factor, residual variance
    passes: int


def _model_cells(df: DataFrame, factors: Sequence[str], y: Column, x: Column) -> tuple[DataFrame, float, float]:
    """Sums per combination of levels of y and x about their means, and the means."""
    rows = df.select(*factors, y.cast("double").alias("y"), x.cast("double").alias("x")).where("y is not null and x is not null")
    mean_y, mean_x = rows.agg(F.avg("y"), F.avg("x")).first()
    centred = rows.withColumns({"y": F.col("y") - F.lit(mean_y), "x": F.col("x") - F.lit(mean_x)})
    summed = centred.groupBy(*factors).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.sum("x").alias("x"), F.sum(F.col("y") * F.col("y")).alias("yy"),
        F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("x") * F.col("y")).alias("xy"))
    return summed, mean_y, mean_x


def _solved(sums: Row) -> tuple[float, float]:
    """Level and slope by least squares; no slope where x never changes."""
    spread = sums["n"] * sums["xx"] - sums["x"] * sums["x"]
    slope = (sums["n"] * sums["xy"] - sums["x"] * sums["y"]) / spread if spread > 1e-12 * sums["n"] * sums["xx"] else 0.0
    return (sums["y"] - slope * sums["x"]) / sums["n"], slope


def mixed_model(df: DataFrame, factors: Sequence[str], y: Column, x: Column,
                passes: int = 50, tolerance: float = 1e-4) -> MixedModel | None:
    """Crossed random effects with variances estimated from the data, besides a fixed level and slope.

    y = level + slope * x + one effect per factor + noise; the effects of a
    factor are normal with a variance of their own.  Variational expectation
    and maximisation: each factor's effects get their mean and variance given
    all else, the factor's variance is the mean square of its effects, then
    level and slope are solved and the noise is what is left.  It ends when no
    variance changes by more than ``tolerance`` of the whole in a pass.

    Rows are summed once per combination of levels.  A pass reads these cells,
    whose number does not grow with the rows in each.  Null levels are levels;
    rows with a null y or x take no part; without rows the result is None.
    """
    summed, mean_y, mean_x = _model_cells(df, factors, y, x)
    if mean_y is None:
        return None
    current = materialise(summed, "cells")
    total, square = current.agg(F.sum("n"), F.sum("yy")).first()
    whole = square / total
    level, slope, noise = 0.0, 0.0, whole / (len(factors) + 1)
    variance = dict.fromkeys(factors, noise)
    current = current.withColumns({f"_{f}": F.lit(0.0) for f in factors})
    updates: dict[str, DataFrame] = {}
    step = 0
    for step in range(1, passes + 1):
        before = [*variance.values(), noise]
        widths = 0.0
        for factor in factors:
            rest = sum([F.col(f"_{f}") for f in factors if f != factor], F.lit(level))
            # a factor without variance has no effects
            pull = F.col("n") + (noise / variance[factor] if variance[factor] > 0 else float("inf"))
            update, few = sized(
                current.groupBy(F.col(factor).alias("level")).agg(
                    F.sum("n").alias("n"), F.sum(F.col("y") - F.lit(slope) * F.col("x") - F.col("n") * rest).alias("excess"))
                .select("level", "n", (F.col("excess") / pull).alias("effect"), (F.lit(noise) / pull).alias("width")))
            updates[factor] = update
            variance[factor], width = update.agg(
                F.avg(F.col("effect") * F.col("effect") + F.col("width")), F.sum(F.col("n") * F.col("width"))).first()
            widths += width
            new = update.select("level", F.col("effect").alias(f"_{factor}"))
            current = current.drop(f"_{factor}").join(F.broadcast(new) if few else new, F.col(factor).eqNullSafe(F.col("level"))).drop("level")
        current = materialise(current, f"mixed_{step}")
        offset = sum([F.col(f"_{f}") for f in factors], F.lit(0.0))
        left = current.withColumn("_o", offset).select(
            "n", (F.col("y") - F.col("n") * F.col("_o")).alias("y"), "x", "xx", (F.col("xy") - F.col("x") * F.col("_o")).alias("xy"),
            (F.col("yy") - 2 * F.col("_o") * F.col("y") + F.col("n") * F.col("_o") * F.col("_o")).alias("yy"))
        sums = left.agg(*[F.sum(c).alias(c) for c in ("n", "y", "x", "xx", "xy", "yy")]).first()
        level, slope = _solved(sums)
        squares = (sums["yy"] - 2 * level * sums["y"] - 2 * slope * sums["xy"] + level * level * sums["n"]
                   + 2 * level * slope * sums["x"] + slope * slope * sums["xx"])
        noise = (max(0.0, squares) + widths) / total
        if max(abs(a - b) for a, b in zip(before, [*variance.values(), noise])) <= tolerance * whole:
            break
    terms = [("intercept", mean_y + level - slope * mean_x), ("slope", slope),
             *[(f"variance {f}", variance[f]) for f in factors], ("variance residual", noise)]
    levels = _stacked([updates[f].select(
        F.lit(f).alias("factor"), F.col("level").cast("string").alias("level"), "n", "effect",
        F.sqrt("width").alias("deviation")) for f in factors])
    return MixedModel(levels, df.sparkSession.createDataFrame(terms, "term string, estimate double"), step)
