"""Fitted one-step predictors: each series' next value from its last few.

The normal equations of a series are sums over its windows, so one aggregate
gives them for all series at once; rows do not come together again.  The small
systems are then solved in batches, many series at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.sequences import series_windows
from tallyloom.workspace import join_on_keys

# Least determinant of the lags' correlations; below it the lags tell the same.
APART = 1e-9


def _moments(windows: DataFrame, series: Sequence[str], lags: int) -> DataFrame:
    """``_n``, sums and sums of products of the lags and the value after them, about a common centre."""
    centre = windows.agg(F.avg(F.element_at("items", -1))).first()[0] or 0.0
    values = [F.col("items")[i].cast("double") - F.lit(float(centre)) for i in range(lags + 1)]
    products = [values[i] * values[j] for i in range(lags + 1) for j in range(i, lags + 1)]
    return windows.groupBy(*series).agg(
        F.count(F.lit(1)).alias("_n"), F.array(*[F.sum(v) for v in [*values, *products]]).alias("_sums"), F.lit(float(centre)).alias("_centre"))


def _solve(lags: int):
    width = lags + 1
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, centre = (b.column(c).to_numpy().astype(float) for c in ("_n", "_centre"))
            sums = b.column("_sums").flatten().to_numpy().reshape(len(n), -1)
            mean = sums[:, :width] / n[:, None]
            square = np.zeros((len(n), width, width))
            square[:, upper[0], upper[1]] = sums[:, width:] / n[:, None]
            square += np.triu(square, 1).transpose(0, 2, 1)
            spread = square - mean[:, :, None] * mean[:, None, :]
            inner, outer = spread[:, :lags, :lags], spread[:, :lags, lags]
            size = np.sqrt(np.maximum(np.diagonal(inner, axis1=1, axis2=2), 0))
            scale = np.where(size > 0, size, 1)
            related = inner / (scale[:, :, None] * scale[:, None, :])
            fits = (n >= lags + 2) & (size > 0).all(1) & (np.linalg.det(related) > APART)
            safe = np.where(fits[:, None, None], related, np.eye(lags))
            slope = np.linalg.solve(safe, (outer / scale)[:, :, None])[:, :, 0] / scale
            slope = np.where(fits[:, None], slope, 0.0)
            left = spread[:, lags, lags] - (slope * outer).sum(1)
            level = mean[:, lags] + centre - (slope * (mean[:, :lags] + centre[:, None])).sum(1)
            last = square[:, lags - 1, lags - 1] - 2 * square[:, lags - 1, lags] + square[:, lags, lags]
            gone = pa.array(~fits)
            coefficients = pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * lags + 1, lags), pa.int32()), pa.array(slope.ravel()), mask=gone)
            kept = [c for c in b.schema.names if not c.startswith("_")]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in kept], b.column("_n"), pa.array(level, mask=~fits), coefficients,
                 pa.array(np.sqrt(np.maximum(left, 0)), mask=~fits), pa.array(np.sqrt(np.maximum(last, 0)))],
                [*kept, "windows", "intercept", "coefficients", "rmse", "last_value_rmse"])
    return run


def fit_autoregression(df: DataFrame, series: Sequence[str], order: Sequence[str], value: str, lags: int) -> DataFrame:
    """One row per series: windows, intercept, coefficients (oldest lag first), rmse, last_value_rmse.

    Least squares over all windows of ``lags`` values and the one after them.
    Windows with a null take no part.  A series with fewer than ``lags`` + 2
    windows, or whose lags tell the same, has null coefficients; its
    last_value_rmse, the error of taking the last value, stands all the same.
    Series columns may not begin with an underscore.
    """
    windows = series_windows(df, series, order, value, lags + 1, lags).where(F.forall("items", lambda x: x.isNotNull()))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*series).schema)
    return _moments(windows, series, lags).mapInArrow(
        _solve(lags), f"{kinds}, windows long, intercept double, coefficients array<double>, rmse double, last_value_rmse double")


def predicted_next(df: DataFrame, fits: DataFrame, series: Sequence[str], order: Sequence[str], value: str, lags: int) -> DataFrame:
    """``series`` and ``prediction`` of the value after the last one; the last value itself where nothing was fitted."""
    ends = series_windows(df, series, order, value, lags, lags - 1).groupBy(*series).agg(F.max_by("items", "window_id").alias("_items"))
    told = F.aggregate(F.zip_with("_items", "coefficients", lambda x, c: x * c), F.col("intercept"), lambda s, x: s + x)
    return join_on_keys(ends, fits.select(*series, "intercept", "coefficients"), series).select(
        *series, F.coalesce(told, F.element_at("_items", -1).cast("double")).alias("prediction"))
