"""Missing values: skew-aware numeric fill and mode fill for categories.

Fit = one moments aggregate (G1 skew, mean, min, max, null count) + exact medians only
for the columns that need them + one value-count shuffle for the modes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith import fixed
from tabsmith.functions.stats import is_numeric, nan_to_null
from tabsmith.functions.unpivot import unpivot
from tabsmith.operators.profile import SLACK, hashed_counts, leading_hashes, moments, top_values, top_values_long
from tabsmith.operators.quantiles import exact_quantiles, few_valued


@dataclass(frozen=True)
class FillPlan:
    numeric: dict = field(default_factory=dict)      # column -> (fill, "mean"/"median")
    categorical: dict = field(default_factory=dict)  # column -> fill label
    levels: dict = field(default_factory=dict, compare=False)  # text column -> levels or None
    stats: dict = field(default_factory=dict, compare=False)  # column -> moments


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude]


def numeric_moments(df: DataFrame, cols: Sequence[str], distinct: dict | None = None) -> dict[str, dict]:
    """Count, G1 skew, mean, min, max per column from the long-form moments pass; columns that ``distinct``
    (upper bounds of their numbers of values) shows to have few values, from the counts of their values. A
    column with nulls is filled with its mean, so that one is always the sum over the rows, to the last digit."""
    out = {c: st for c, st in counted_moments(df, few_valued(list(cols), distinct)).items() if st["nn"] == st["n"]}
    many = [c for c in cols if c not in out]
    rows = {r["ordinal"]: r for r in moments(df.select(*[F.col(f"`{c}`") for c in many])).collect()} if many else {}
    out |= {c: {"n": rows[i]["n_rows"], "nn": rows[i]["n_nonnull"], "skew": rows[i]["skew"],
                "mean": rows[i]["mean"], "min": rows[i]["min"], "max": rows[i]["max"]} for i, c in enumerate(many)}
    return {c: out[c] for c in cols}


def counted_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """The same figures of columns of few values: one pass counts the values, the rest is over the counts."""
    if not cols:
        return {}
    present = unpivot(df, [(F.lit(i), nan_to_null(F.col(f"`{c}`"), df.schema[c].dataType).cast("double")) for i, c in enumerate(cols)], ("i", "v"))
    counts = present.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    n, there = F.col("n").cast("double"), F.col("v").isNotNull()
    mean = F.sum(F.col("v") * n) / F.sum(F.when(there, n))
    centred = counts.withColumn("d", F.col("v") - (F.sum(F.col("v") * n).over(Window.partitionBy("i")) / F.sum(F.when(there, n)).over(Window.partitionBy("i"))))
    rows = centred.groupBy("i").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).alias("nn"), mean.alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.sum(n * F.col("d") * F.col("d")).alias("m2"), F.sum(n * F.col("d") * F.col("d") * F.col("d")).alias("m3")).collect()
    out = {}
    for r in rows:
        nn, m2, m3, skew = r["nn"], r["m2"], r["m3"], None
        if nn >= 3 and r["min"] != r["max"] and m2:
            skew = math.sqrt(nn) * (m3 / m2) / math.sqrt(m2) * math.sqrt(nn * (nn - 1)) / (nn - 2)
        # the mean of a constant is the constant
        mean_of = r["min"] if nn and r["min"] == r["max"] else r["mean"]
        out[cols[r["i"]]] = {"n": r["n"], "nn": nn, "skew": skew, "mean": mean_of, "min": r["min"], "max": r["max"]}
    return out if len(out) == len(cols) else {}


def fit_numeric_fill(df: DataFrame, cols: Sequence[str],
                     skew_above: float = fixed.MEDIAN_SKEW_ABOVE, distinct: dict | None = None) -> FillPlan:
    """Skew > 1 -> median, else mean (negative skew and undefined skew take the mean)."""
    st = numeric_moments(df, cols, distinct)
    med_cols = [c for c in cols if st[c]["skew"] is not None and st[c]["skew"] > skew_above]
    meds = exact_quantiles(df, med_cols, [0.5])
    plan = {}
    for c in cols:
        if c in meds:
            plan[c] = (meds[c][0], "median")
        else:
            plan[c] = (st[c]["mean"], "mean")
    return FillPlan(numeric=plan, stats=st)


def fit_mode_fill(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent value (ties: smallest), ``'Unknown'`` when there is none."""
    if not cols:
        return {}
    tops = {r["column_name"]: r["value"] for r in top_values_long(df, 1, list(cols)).collect()}
    return {c: tops.get(c, fixed.UNKNOWN_LABEL) for c in cols}


def mode_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """I2 as a table ``(column_name, mode)``, lazily."""
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    tops = top_values_long(df, 1, list(cols)).select("column_name", F.col("value").alias("mode"))
    return names.join(F.broadcast(tops), "column_name", "left").select(
        "column_name", F.coalesce("mode", F.lit(fixed.UNKNOWN_LABEL)).alias("mode"))


def fit_modes_and_levels(df: DataFrame, cols: Sequence[str], max_levels: int = fixed.CLASS_MAX_DISTINCT):
    """I2 modes and, for text columns, the one-hot levels (all values of a column with at most
    ``max_levels``) from one value-count shuffle of hashes. Returns ``(modes, levels)``; levels are
    None for a column with more than ``max_levels`` values.

    Filling a column with its own mode adds no level, so the levels hold for the filled
    column too; a column with no value at all fills to, and has the one level, 'Unknown'.
    """
    if not cols:
        return {}, {}
    # one value more than a column may have shows that it has too many
    kept = max(1, max_levels + 1 - SLACK)
    leading = {r["ordinal"]: r["l"] for r in leading_hashes(hashed_counts(df, list(cols)), kept).collect()}
    fields = {f.name: f.dataType for f in df.schema.fields}
    few = {i: rows for i, rows in leading.items() if len(rows) <= max_levels and isinstance(fields[df.columns[i]], T.StringType)}
    tops = top_values(df, few, max_levels) | top_values(df, {i: rows for i, rows in leading.items() if i not in few}, 1)
    out_modes, out_levels = {}, {}
    for c in cols:
        i = df.columns.index(c)
        out_modes[c] = tops[i][0][0] if i in tops else fixed.UNKNOWN_LABEL
        if isinstance(fields[c], T.StringType):
            out_levels[c] = tuple(sorted(v for v, _ in tops[i])) if i in few else None if i in leading else (fixed.UNKNOWN_LABEL,)
    return out_modes, out_levels


def fit_fill(df: DataFrame, exclude: Sequence[str] = (),
             max_levels: int = fixed.CLASS_MAX_DISTINCT, distinct: dict | None = None) -> FillPlan:
    """Numeric and categorical fill for every feature; targets are never filled.
    The one-hot level probe of phase 8 comes from the same shuffle as the modes."""
    num = fit_numeric_fill(df, numeric_columns(df, exclude), distinct=distinct)
    modes, levels = fit_modes_and_levels(df, categorical_columns(df, exclude), max_levels)
    return FillPlan(numeric=num.numeric, categorical=modes, stats=num.stats, levels=levels)


def apply_fill(df: DataFrame, plan: FillPlan) -> DataFrame:
    """One projection. Numeric columns that had nulls when fitted become double (as a
    pandas column with missing values is float); the others keep their type and take the
    fill cast to it, so a table with nulls the fitted one lacked is still filled."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c in plan.numeric:
            fill, _ = plan.numeric[c]
            st = plan.stats.get(c)
            had_nulls = st is None or st["nn"] < st["n"]
            if fill is not None and had_nulls:
                x = F.coalesce(nan_to_null(x, fields[c]).cast("double"), F.lit(float(fill)))
            elif fill is not None:
                x = F.coalesce(nan_to_null(x, fields[c]), F.lit(float(fill)).cast(fields[c]))
        elif c in plan.categorical:
            fill = plan.categorical[c]
            if isinstance(fields[c], T.BooleanType):
                if fill in ("true", "false"):
                    x = F.coalesce(x, F.lit(fill == "true"))
            else:
                x = F.coalesce(x, F.lit(fill))
        out.append(x.alias(c))
    return df.select(*out)
