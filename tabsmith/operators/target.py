"""Target handling, task inference and candidate ranking.

The ranking weights replace a model's opinion with fixed formulas over the profile,
so the same table always yields the same recommendations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith import fixed
from tabsmith.functions.stats import nan_to_null

NUMERIC_TYPES = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def _is_numeric_dtype(dtype: Column) -> Column:
    return dtype.isin(NUMERIC_TYPES) | dtype.startswith("decimal")


def has_targets(df: DataFrame, targets: Sequence[str]) -> Column:
    """No target of the row is null (or NaN)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cond = F.lit(True)
    for t in targets:
        cond = cond & nan_to_null(F.col(f"`{t}`"), types[t]).isNotNull()
    return cond


def drop_null_target(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Rows whose target is null (or NaN) are removed."""
    return df.filter(has_targets(df, targets)) if targets else df


def cast_target(df: DataFrame, target: str) -> DataFrame:
    """Numeric target as double, in place."""
    return df.withColumn(target, F.col(f"`{target}`").cast("double"))


def encode_target(df: DataFrame, target: str):
    """A text target becomes sorted label codes; returns (frame, mapping, class count)."""
    from tabsmith.operators.encode import apply_labels, label_codes_counted
    mapping, counts = label_codes_counted(df, [target])
    return apply_labels(df, mapping, [target], counts), mapping, counts[target]


def infer_problem(profile: DataFrame) -> DataFrame:
    """T4: per column, 'classification' for text or few values, else 'regression'."""
    cls = (~_is_numeric_dtype(F.col("dtype"))) | (F.col("n_distinct") <= fixed.CLASS_MAX_DISTINCT)
    return profile.select("column_name", F.when(cls, "classification")
                          .otherwise("regression").alias("problem_type"))


def task_of_expr(dtype: Column, n_distinct: Column) -> Column:
    """T5 as an expression over a profile row."""
    cls = (~_is_numeric_dtype(dtype)) | (dtype == "boolean") | (n_distinct <= fixed.CLASS_MAX_DISTINCT)
    return F.when(cls, F.lit("Classification")).otherwise(F.lit("Regression"))


def task_of(profile: DataFrame, targets: Sequence[str] | None = None) -> DataFrame:
    """T5: Classification if non-numeric, boolean or at most 15 values, else Regression."""
    p = profile if not targets else profile.filter(F.col("column_name").isin(list(targets)))
    return p.select("column_name", task_of_expr(F.col("dtype"), F.col("n_distinct")).alias("task"))


def task_from_algorithm(name: Column) -> Column:
    """A name mentioning classifier/classification/logistic/svc is Classification."""
    low = F.lower(name)
    cond = F.lit(False)
    for w in fixed.ALGORITHM_CLASSIFICATION_WORDS:
        cond = cond | (F.instr(low, w) > 0)
    return F.when(cond, F.lit("Classification")).otherwise(F.lit("Regression"))


def id_rule() -> Column:
    """D1's rule over a profile row: every value distinct and an ID-like name."""
    from tabsmith.operators.prune import has_id_hint
    return (F.col("n_distinct") == F.col("n_rows")) & has_id_hint(F.col("column_name"))


def rank_targets(profile: DataFrame) -> DataFrame:
    """``(rank, column_name, weight)``.

    weight = 0 for an ID, constant or mostly-empty column, else
    0.5 + 0.3 * (1 - null_pct / 100) + 0.2 * is_numeric; ties by column order.
    """
    bad = id_rule() | F.col("flags").contains("CONSTANT") | F.col("flags").contains("HIGH NULL")
    w = F.when(bad, F.lit(0.0)).otherwise(
        F.lit(0.5) + F.lit(0.3) * (F.lit(1.0) - F.col("null_pct") / 100.0)
        + F.lit(0.2) * _is_numeric_dtype(F.col("dtype")).cast("double"))
    ranked = profile.select("ordinal", "column_name", F.round(w, 4).alias("weight"))
    # the profile has one row per column, so this window holds at most that many rows
    win = Window.orderBy(F.col("weight").desc(), F.col("ordinal").asc())
    return ranked.select(F.row_number().over(win).alias("rank"), "column_name", "weight")


def rank_problem_types(profile: DataFrame, target: str) -> DataFrame:
    """Suitability of each task for one target, highest first."""
    row = profile.filter(F.col("column_name") == target)
    s_cls = (F.when(~_is_numeric_dtype(F.col("dtype")), F.lit(1.0))
             .when(F.col("n_distinct") <= 2, F.lit(0.9))
             .when(F.col("n_distinct") <= fixed.CLASS_MAX_DISTINCT, F.lit(0.8))
             .otherwise(F.lit(0.2)))
    both = row.select(F.explode(F.array(
        F.struct(F.lit("Classification").alias("problem_type"), s_cls.alias("suitability")),
        F.struct(F.lit("Regression").alias("problem_type"),
                 F.round(F.lit(1.0) - s_cls, 4).alias("suitability")))).alias("e")).select("e.*")
    win = Window.orderBy(F.col("suitability").desc(), F.col("problem_type"))
    return both.select(F.row_number().over(win).alias("rank"), "problem_type", "suitability")


# --- fixed values: algorithm candidates and their base suitability ----------
ALGORITHMS = (
    ("GBTRegressor", "Regression", 0.90),
    ("RandomForestRegressor", "Regression", 0.85),
    ("LinearRegression", "Regression", 0.70),
    ("DecisionTreeRegressor", "Regression", 0.60),
    ("GBTClassifier", "Classification", 0.90),
    ("RandomForestClassifier", "Classification", 0.85),
    ("LogisticRegression", "Classification", 0.75),
    ("DecisionTreeClassifier", "Classification", 0.60),
    ("LinearSVC", "Classification", 0.55),
)
SMALL_TABLE_ROWS = 1000
WIDE_TABLE_FEATURES = 50


def algorithm_table(spark) -> DataFrame:
    return spark.createDataFrame(list(ALGORITHMS), "algorithm string, task string, base double")


def rank_algorithms(df: DataFrame, task: str, n_features: int | None = None,
                    n_rows: int | None = None, small_rows: int = SMALL_TABLE_ROWS,
                    wide_features: int = WIDE_TABLE_FEATURES) -> DataFrame:
    """Fixed candidates for the task, adjusted by table size; highest first.

    Tables under ``small_rows`` rows favour linear models (+0.1) over boosting (-0.1); tables
    over ``wide_features`` features favour forests (+0.05). 0 turns the first rule off, a large
    number the second.
    """
    n_features = len(df.columns) - 1 if n_features is None else n_features
    n_rows = df.count() if n_rows is None else n_rows
    cand = algorithm_table(df.sparkSession).filter(F.col("task") == task)
    small = F.lit(n_rows < small_rows)
    linear = F.col("algorithm").isin("LinearRegression", "LogisticRegression", "LinearSVC")
    boost = F.col("algorithm").startswith("GBT")
    forest = F.col("algorithm").startswith("RandomForest")
    adj = (F.when(small & linear, F.lit(0.1)).when(small & boost, F.lit(-0.1)).otherwise(F.lit(0.0))
           + F.when(forest & F.lit(n_features > wide_features), F.lit(0.05)).otherwise(F.lit(0.0)))
    scored = cand.select(
        "algorithm", "task", F.round(F.col("base") + adj, 4).alias("suitability"))
    win = Window.orderBy(F.col("suitability").desc(), F.col("algorithm"))
    return scored.select(F.row_number().over(win).alias("rank"), "algorithm", "task", "suitability")
