"""Null, NaN, infinity and rounding rules as column expressions (ANSI mode is on)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INF = float("inf")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: Column | str) -> Column:
    return col(c).cast("double")


def div_inf(a: Column | str, b: Column | str) -> Column:
    """a / b where x/0 is a signed infinity and 0/0 is NULL."""
    a, b = dbl(a), dbl(b)
    at_zero = F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
    return F.when(b == 0, at_zero).otherwise(F.try_divide(a, b))


def floor_div(x: Column | str, n: int) -> Column:
    """Division rounded toward minus infinity."""
    return F.floor(col(x) / F.lit(n)).cast("int")


def nan_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def sum0(c: Column | str) -> Column:
    """A sum that is 0 when every value is NULL."""
    return F.coalesce(F.sum(c), F.lit(0))


def skew_g1(c: Column | str, constant_as_zero: bool = False) -> Column:
    """Bias-adjusted skewness: NULL below three values.

    A constant group is NULL, or 0 with ``constant_as_zero``.
    """
    c = dbl(c)
    n = F.count(c).cast("double")
    # skewness over a NULL variance would divide by zero, so guard on min = max
    flat = F.min(c) == F.max(c)
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    value = factor * F.skewness(c)
    at_flat = F.lit(0.0) if constant_as_zero else F.lit(None).cast("double")
    return F.when(n > 2, F.when(flat, at_flat).otherwise(value))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation, NULL when either side is constant."""
    x, y = dbl(x), dbl(y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def round_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(dbl(c), digits)


def is_finite(c: Column | str) -> Column:
    c = dbl(c)
    return (c < INF) & (c > -INF)
