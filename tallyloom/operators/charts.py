"""The reductions behind charts, computed over all rows."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from itertools import combinations_with_replacement
from math import ceil

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyloom.functions.statistics import gaussian, normal_quantile, pearson, tricube
from tallyloom.operators.ordering import Slices, quantiles, quantiles_of, value_slices, values_at
from tallyloom.workspace import join_on_keys, materialise, small_side

def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in equal-width bins over the whole range; the maximum falls in the last bin."""
    rows = df.select(*keys, F.col(value).alias("_value")).filter("_value is not null")
    low = rows.select(F.min("_value")).scalar()
    high = rows.select(F.max("_value")).scalar()
    width = (high - low) / F.lit(float(bins))
    cell = F.when(high == low, F.lit(0).cast("long")).otherwise(
        F.least(F.floor((F.col("_value") - low) / width), F.lit(bins - 1)))
    return (
        rows.withColumn("bin", cell).groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", low + F.col("bin") * width))


def quantile_table(df: DataFrame, keys: Sequence[str], value: str,
                   probabilities: Sequence[float]) -> DataFrame:
    return quantiles(df, keys, value, probabilities)


def qq_two_sample(df: DataFrame, keys: Sequence[str], first: str, second: str,
                  probabilities: Sequence[float]) -> DataFrame:
    """Quantiles of two columns next to each other."""
    a = quantiles(df, keys, first, probabilities).withColumnRenamed("quantile", "first")
    b = quantiles(df, keys, second, probabilities).withColumnRenamed("quantile", "second")
    return join_on_keys(a, b, [*keys, "p"])


def qq_normal(df: DataFrame, keys: Sequence[str], value: str,
              probabilities: Sequence[float]) -> DataFrame:
    """Quantiles of a column next to those of the standard normal distribution."""
    return quantiles(df, keys, value, probabilities).withColumn("normal", normal_quantile("p"))


def box_fences(slices: Slices, keys: Sequence[str]) -> DataFrame:
    """Quartiles and the fences 1.5 interquartile ranges beyond them."""
    parts = quantiles_of(slices, keys, [0.25, 0.5, 0.75])
    spread = F.col("q3") - F.col("q1")
    return (
        parts.groupBy(*keys).agg(
            F.max(F.when(F.col("p") == 0.25, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("p") == 0.5, F.col("quantile"))).alias("median"),
            F.max(F.when(F.col("p") == 0.75, F.col("quantile"))).alias("q3"))
        .withColumns({"low_fence": F.col("q1") - 1.5 * spread,
                      "high_fence": F.col("q3") + 1.5 * spread}))


def box_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Quartiles, whiskers and the number of outliers per key, from the counted values."""
    slices = value_slices(df, keys, value)
    fences = small_side(box_fences(slices, keys))
    inside = F.col("_value").between(F.col("low_fence"), F.col("high_fence"))
    return (
        join_on_keys(slices.values, fences, keys).groupBy(*keys, "q1", "median", "q3")
        .agg(F.min(F.when(inside, F.col("_value"))).alias("low_whisker"),
             F.max(F.when(inside, F.col("_value"))).alias("high_whisker"),
             F.sum(F.when(~inside, F.col("_n")).otherwise(0)).alias("outliers")))


def box_outliers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The rows beyond their key's fences."""
    fences = box_fences(value_slices(df, keys, value), keys)
    fences = small_side(fences.select(*keys, "low_fence", "high_fence"))
    return join_on_keys(df, fences, keys).filter(
        ~F.col(value).between(F.col("low_fence"), F.col("high_fence"))).select(*df.columns)


def kernel_density(df: DataFrame, value: str, bandwidth: float, cells: int = 50) -> DataFrame:
    """Gaussian kernel density of a column on an even grid over its range.

    Equal values are counted first; then each row adds to one sum per grid
    cell, so nothing but those sums is shuffled.
    """
    if cells < 2:
        raise ValueError("a grid has 2 cells or more")
    counted = df.select(F.col(value).cast("double").alias("value")).filter("value is not null").groupBy(
        "value").agg(F.count(F.lit(1)).alias("n"))
    low, high = counted.agg(F.min("value"), F.max("value")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "cell int, x double, density double")
    step, h = (high - low) / (cells - 1), float(bandwidth)
    places = [low + i * step for i in range(cells)]
    sums = counted.agg(F.sum("n").alias("rows"), *[
        F.sum(F.col("n") * gaussian((F.lit(x) - F.col("value")) / h)).alias(f"s{i}") for i, x in enumerate(places)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("cell"), F.lit(x).alias("x"), (F.col(f"s{i}") / F.col("rows") / h).alias("density"))
        for i, x in enumerate(places)])))


def _reach_bounds(slices: Sequence[Row], x: float, needed: int) -> tuple[float, float]:
    """A radius around ``x`` that surely holds fewer than ``needed`` points, and one that surely holds as many."""
    def count(radius: float, whole: bool) -> int:
        low, high = x - radius, x + radius
        return sum(s["n"] for s in slices if (low <= s["low"] and s["high"] <= high if whole
                                              else low <= s["high"] and s["low"] <= high))

    # a hair wider, so that rounding cannot leave the edge of a slice outside
    radii = sorted({abs(e - x) * (1 + 1e-12) for s in slices for e in (s["low"], s["high"])})
    least = bisect_left(radii, True, key=lambda r: count(r, True) >= needed)
    most = bisect_left(radii, True, key=lambda r: count(r * (1 + 1e-12), False) >= needed)
    return radii[most - 1] if most else -1.0, radii[min(least, len(radii) - 1)]


def loess(df: DataFrame, x: str, y: str, span: float, cells: int = 20) -> DataFrame:
    """Local linear fit on an even grid; ``span`` is the share of points in a neighbourhood.

    Points are first summed per distinct x and laid out in order.  The
    neighbourhood of a grid point reaches to its k-th nearest point, k =
    ceil(span * points).  The ends of the slices bound that reach from both
    sides; only points between the bounds are ranked by distance, and one
    aggregate over the points then gives the sums of all grid points.
    """
    if cells < 2:
        raise ValueError("a grid has 2 cells or more")
    spark = df.sparkSession
    counted = df.select(F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")).filter(
        "px is not null and py is not null").groupBy("px").agg(F.count(F.lit(1)).alias("n"), F.sum("py").alias("sum_y"))
    points = materialise(counted.repartitionByRange("px").withColumn("_slice", F.spark_partition_id()), "loess_points")
    # one row per slice
    slices = points.groupBy("_slice").agg(F.min("px").alias("low"), F.max("px").alias("high"), F.sum("n").alias("n")).collect()
    if not slices:
        return spark.createDataFrame([], "cell int, x double, fitted double")
    low, high, total = min(s["low"] for s in slices), max(s["high"] for s in slices), sum(s["n"] for s in slices)
    step = (high - low) / (cells - 1)
    grid = [low + i * step for i in range(cells)]
    needed = max(ceil(float(span) * total), 1)
    bounds = [_reach_bounds(slices, g, needed) for g in grid]

    def distance(i: int) -> Column:
        return F.abs(F.col("px") - F.lit(grid[i]))

    inner = points.agg(*[F.coalesce(F.sum(F.when(distance(i) <= F.lit(bounds[i][0]), F.col("n"))), F.lit(0)).alias(f"c{i}")
                         for i in range(cells)]).first()
    between = F.array(*[F.struct(F.lit(i).alias("cell"), distance(i).alias("distance"),
                                 ((distance(i) > F.lit(a)) & (distance(i) <= F.lit(b))).alias("in"))
                        for i, (a, b) in enumerate(bounds)])
    open_points = points.select("n", F.filter(between, lambda c: c["in"]).alias("c")).filter("size(c) > 0").select("n", F.inline("c"))
    wanted = F.create_map(*[F.lit(v) for i in range(cells) for v in (i, needed - inner[i])])
    found = values_at(value_slices(open_points, ["cell"], "distance", "n"), ["cell"],
                      lambda _: F.array(F.struct(F.element_at(wanted, F.col("cell")).alias("rank"))))
    reach = {r["cell"]: r["_value"] for r in found.select("cell", "_value").collect()}

    sums = []
    for i in range(cells):
        dx, r = F.col("px") - F.lit(grid[i]), reach[i]
        weight = F.when(distance(i) <= F.lit(r), F.lit(1.0) if r == 0 else tricube(distance(i) / F.lit(r))).otherwise(0.0)
        w = weight * F.col("n")
        t = weight * F.col("sum_y")
        sums += [F.sum(e).alias(f"{name}_{i}") for name, e in (
            ("s0", w), ("s1", w * dx), ("s2", w * dx * dx), ("t0", t), ("t1", t * dx))]
    fits = []
    for i, g in enumerate(grid):
        s0, s1, s2, t0, t1 = (F.col(f"{name}_{i}") for name in ("s0", "s1", "s2", "t0", "t1"))
        spread = s0 * s2 - s1 * s1
        flat = (F.abs(spread) <= F.lit(1e-12) * s0 * s2) | (s2 == 0)
        fits.append(F.struct(F.lit(i).alias("cell"), F.lit(g).alias("x"), F.when(flat, F.try_divide(t0, s0)).otherwise(
            F.try_divide(s2 * t0 - s1 * t1, spread)).alias("fitted")))
    return points.agg(*sums).select(F.inline(F.array(*fits)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations of all column pairs from one pass; undefined ones are null."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[pearson(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"),
                 F.col(f"c{i}").alias("correlation"))
        for i, pair in enumerate(pairs) for a, b in dict.fromkeys([pair, pair[::-1]])]
    return wide.select(F.inline(F.array(*cells)))


def scatter_sample_stats(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Correlation per key; null where a column is constant inside the key."""
    return df.groupBy(*keys).agg(pearson(a, b).alias("correlation"))
