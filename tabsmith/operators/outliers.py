"""Outlier capping with IQR bounds (no row is dropped)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith import fixed
from tabsmith.operators.quantiles import _value, counted_quantiles, exact_quantiles, few_valued


def _min_max(df: DataFrame, cols: Sequence[str]) -> dict:
    row = df.agg(*[F.min(_value(c)).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(_value(c)).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}


def _between(c: str, bounds: dict):
    """Values strictly between min and max; none means at most two distinct values."""
    lo, hi = bounds[c]
    if lo is None:
        return F.lit(0)
    x = _value(c)
    return F.count_if((x > F.lit(lo)) & (x < F.lit(hi)))


def binary_columns(df: DataFrame, cols: Sequence[str], bounds: dict | None = None) -> set[str]:
    """Columns with at most two distinct values: nothing strictly between min and max.

    ``bounds`` (column -> (min, max)) saves the min/max pass when already known.
    """
    if not cols:
        return set()
    bounds = bounds or _min_max(df, cols)
    row = df.agg(*[_between(c, bounds).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    return {c for i, c in enumerate(cols) if row[f"b{i}"] == 0}


def fit_iqr(df: DataFrame, cols: Sequence[str], k: float = fixed.IQR_FACTOR,
            bounds: dict | None = None, distinct: dict | None = None) -> dict[str, tuple]:
    """O1 + O3: ``{column: (q1, q3, lo, hi)}`` for non-binary columns with a finite IQR > 0.

    ``distinct`` (column -> upper bound of its number of values) lets one pass over the counts of their
    values serve the columns of few values."""
    if not cols:
        return {}
    few = few_valued(list(cols), distinct)
    counted = counted_quantiles(df, few, [0.25, 0.75])
    many = [c for c in cols if c not in counted]
    binary = binary_columns(df, many, bounds) | {c for c, (n, _) in counted.items() if n <= 2}
    qs = exact_quantiles(df, [c for c in many if c not in binary], [0.25, 0.75]) | {c: q for c, (_, q) in counted.items()}
    out = {}
    for c in cols:
        if c in binary:
            continue
        q1, q3 = qs[c]
        if q1 is None or q3 is None or q1 == q3 or not math.isfinite(q3 - q1):
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, q1 - k * iqr, q3 + k * iqr)
    return out


def clip(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """O2: values outside the bounds move to the nearest bound; nulls stay null."""
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c in bounds:
            lo, hi = bounds[c][-2], bounds[c][-1]
            d = x.cast("double")
            x = F.when(d.isNotNull(), F.greatest(F.least(d, F.lit(hi)), F.lit(lo)))
        out.append(x.alias(c))
    return df.select(*out)


def iqr_table(df: DataFrame, cols: Sequence[str], k: float = fixed.IQR_FACTOR) -> DataFrame:
    """O1 as a table ``(column_name, q1, q3, lo, hi)``."""
    fit = fit_iqr(df, cols, k)
    rows = [(c, *map(float, v)) for c, v in fit.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, q1 double, q3 double, lo double, hi double")
