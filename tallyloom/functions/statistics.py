"""Aggregate and scalar expressions for statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def geometric_mean(c: Column | str, start_count: int = 0, start_product: float = 1.0) -> Column:
    """(start_product * product) ** (1 / (start_count + count)), once per group.

    Logarithms keep long groups from overflowing.  A zero gives 0, an odd
    number of negative factors gives NaN, as the root of the product would.
    """
    c = _column(c).cast("double")
    start = F.lit(float(start_product))
    logs = F.log(F.abs(start)) + F.coalesce(F.sum(F.when(c != 0, F.log(F.abs(c)))), F.lit(0.0))
    size = F.lit(start_count) + F.count(c)
    negatives = F.count_if(c < 0) + F.when(start < 0, 1).otherwise(0)
    return (
        F.when(size == 0, F.lit(float("inf")) if start_product > 1 else F.lit(1.0))
        .when(F.count_if(c == 0) > 0, F.lit(0.0))
        .when(negatives % 2 == 1, F.lit(float("nan")))
        .otherwise(F.exp(logs / size))
    )


def pearson(a: Column | str, b: Column | str) -> Column:
    """Correlation over the rows that have both values; null where one is constant."""
    a, b = _column(a), _column(b)
    spread = (F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b)))
    return F.try_divide(F.covar_pop(a, b), spread)


# Coefficients of the published rational approximation to the
# inverse normal distribution (relative error below 1.2e-9).
_CENTRE_TOP = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
               1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_CENTRE_BOTTOM = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
                  6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_TAIL_TOP = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_TAIL_BOTTOM = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
                3.754408661907416e+00, 1.0)
_TAIL_LIMIT = 0.02425


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def normal_quantile(p: Column | str) -> Column:
    """Inverse of the standard normal distribution for 0 < p < 1, else null."""
    p = _column(p)
    r = p - F.lit(0.5)
    centre = (_polynomial(_CENTRE_TOP, r * r) * r) / _polynomial(_CENTRE_BOTTOM, r * r)

    def tail(share: Column) -> Column:
        q = F.sqrt(F.lit(-2.0) * F.log(share))
        return _polynomial(_TAIL_TOP, q) / _polynomial(_TAIL_BOTTOM, q)

    return (F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
            .when(p < _TAIL_LIMIT, tail(p))
            .when(p > 1 - _TAIL_LIMIT, -tail(F.lit(1.0) - p))
            .otherwise(centre))


def gaussian(u: Column) -> Column:
    return F.exp(F.lit(-0.5) * u * u) / F.lit((2 * 3.141592653589793) ** 0.5)


def tricube(u: Column) -> Column:
    cube = F.lit(1.0) - F.abs(u) * F.abs(u) * F.abs(u)
    return F.when(F.abs(u) < 1, cube * cube * cube).otherwise(0.0)
