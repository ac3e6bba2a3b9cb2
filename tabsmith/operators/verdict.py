"""Sanity verdicts over metric rows and prediction checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith import fixed


def verdict(metrics: DataFrame) -> DataFrame:
    """Q1, Q2, Q4, Q5 per target: ``(target, task, rating, passed, metrics)``.

    Classification passes with accuracy >= 0.55 (two classes) or >= 0.45 (more);
    regression passes with R2 > 0. Rating: accuracy, or max(R2, 0). ``metrics`` is
    a map from metric name to value, names ascending.
    """
    acc = F.max(F.when(F.col("metric") == "accuracy", F.col("value")))
    r2 = F.max(F.when(F.col("metric") == "r2", F.col("value")))
    classes = F.max("n_classes")
    mlist = F.array_sort(F.collect_list(F.struct("metric", "value")))
    per = metrics.groupBy("target", "task").agg(acc.alias("acc"), r2.alias("r2"),
                                                classes.alias("k"), mlist.alias("ml"))
    is_cls = F.col("task") == "Classification"
    need = F.when(F.col("k") <= 2, F.lit(fixed.BINARY_MIN_ACCURACY)).otherwise(F.lit(fixed.MULTICLASS_MIN_ACCURACY))
    passed = F.when(is_cls, F.col("acc") >= need).otherwise(F.col("r2") > fixed.MIN_R2)
    rating = F.when(is_cls, F.col("acc")).otherwise(F.greatest(F.col("r2"), F.lit(0.0)))
    return per.select("target", "task", F.round(rating, 4).alias("rating"),
                      F.coalesce(passed, F.lit(False)).alias("passed"), F.map_from_entries("ml").alias("metrics"))


def metric_text(metrics: Column) -> Column:
    """A verdict's metrics as ``name=value`` pairs at 4 decimals."""
    return F.array_join(F.transform(F.map_entries(metrics), lambda s: F.format_string("%s=%.4f", s["key"], s["value"])), ", ")


def overall(verdicts: DataFrame) -> DataFrame:
    """Q3: sane iff every target passes."""
    return verdicts.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("sane"),
                        F.count(F.lit(1)).alias("n_targets"))


def collapse_check(df: DataFrame, pred: str) -> DataFrame:
    """Q6: predictions vary (min < max needs no shuffle, unlike a distinct count)."""
    p = F.col(f"`{pred}`")
    return df.agg((F.min(p) < F.max(p)).alias("varies"))


def domain_check(df: DataFrame, pred: str, lo: float, hi: float) -> DataFrame:
    """Q7: ``(n_outside, inside)``: predictions within [lo, hi]."""
    p = F.col(f"`{pred}`")
    n = F.count_if((p < F.lit(lo)) | (p > F.lit(hi)))
    return df.agg(n.alias("n_outside"), (n == 0).alias("inside"))


def prediction_checks(df: DataFrame, pred: str, lo: float, hi: float) -> DataFrame:
    """Q6 + Q7 in one aggregate: ``(varies, n_outside, inside)``."""
    p = F.col(f"`{pred}`")
    n = F.count_if((p < F.lit(lo)) | (p > F.lit(hi)))
    return df.agg((F.min(p) < F.max(p)).alias("varies"), n.alias("n_outside"), (n == 0).alias("inside"))
