"""Statistical column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric(dt: T.DataType) -> bool:
    """Numbers only; booleans are profiled as categories."""
    return isinstance(dt, T.NumericType)


def is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, T.IntegralType)


def nan_to_null(c: Column, dt: T.DataType) -> Column:
    """NaN counts as missing, as in a pandas frame."""
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit(None).cast(dt)).otherwise(c)
    return c


def g1_skew(c: Column) -> Column:
    """Bias-corrected sample skewness (G1), null below three values.

    Spark's ``skewness`` is the population moment ratio g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    Partial aggregation keeps this a map-side combine followed by a one-row merge.
    """
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def rounded(c: Column, digits: int = 2) -> Column:
    return F.round(c.cast("double"), digits)
