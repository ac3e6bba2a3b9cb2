"""Figures of columns with few values come from the counts of their values; columns become rows without arrays."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import impute, outliers, profile, verdict
from tabsmith.operators.quantiles import counted_quantiles, exact_quantiles
from tabsmith.plans import recipe
from tabsmith.plans.run import run_record

NAN, INF = float("nan"), float("inf")


def odd(spark):
    rng = np.random.default_rng(3)
    rows = [(float(rng.integers(9)) ** 2, None if i % 7 == 0 else int(rng.integers(5)), [1.5, NAN, None, -0.0][i % 4], 4.0, None,
             [INF, 1.0, 2.0, -INF][i % 4]) for i in range(501)]
    return spark.createDataFrame(rows, "a double, b int, c double, d double, e double, f double")


def test_quantiles_from_counts_equal_the_exact_ones(spark):
    df = odd(spark)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = counted_quantiles(df, df.columns, probs)
    assert got.keys() == set(df.columns) and got["e"] == (0, [None] * 5) and got["c"][0] == 2
    want = exact_quantiles(df, df.columns, probs)
    for c in df.columns:
        assert str(got[c][1]).replace("-0.0", "0.0") == str(want[c]).replace("-0.0", "0.0")


def test_moments_from_counts_equal_the_long_form(spark):
    df = odd(spark)
    cols = df.columns[:5]
    few, plain = impute.counted_moments(df, cols), impute.numeric_moments(df, cols)
    filled = impute.numeric_moments(df, cols, dict.fromkeys(cols, 50))
    assert list(few) == list(filled) == cols
    assert all(filled[c]["mean"] == plain[c]["mean"] for c in ("b", "c"))  # means that fill nulls are the same numbers
    for c in cols:
        for k, v in plain[c].items():
            assert few[c][k] == (v if v is None else pytest.approx(v, rel=1e-9)), (c, k)


def test_bounds_are_equal_and_only_columns_of_many_values_are_sketched(spark, monkeypatch):
    df = odd(spark).drop("e").withColumn("many", F.rand(1))
    asked = []
    monkeypatch.setattr(outliers, "exact_quantiles", lambda d, cols, probs: asked.append(cols) or exact_quantiles(d, cols, probs))
    want = outliers.fit_iqr(df, df.columns)
    got = outliers.fit_iqr(df, df.columns, distinct={c: 60 for c in df.columns if c != "many"})
    assert got == want and {"a", "b", "many"} <= set(got) and asked[1] == ["many"]


def test_a_fit_sketches_no_column_of_few_values(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 50).alias("few"), F.expr("date_add(date'2020-01-01', int(id % 700))").alias("day"), (F.col("id") * 1.5).alias("y"))
    asked = []
    monkeypatch.setattr(outliers, "exact_quantiles", lambda d, cols, probs: asked.extend(cols) or exact_quantiles(d, cols, probs))
    fitted = recipe.fit(df, recipe.Config(targets=("y",)))
    assert not asked and set(fitted.bounds) == {"few", "day_month", "day_day", "day_dayofweek"}


def test_value_hashes_are_projections(spark, capsys):
    profile.hashed_counts(odd(spark)).explain()
    plan = capsys.readouterr().out
    assert "Expand" in plan and "Generate" not in plan


def test_a_record_scores_the_test_table_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    rows = [("y", "Regression", None, m, v) for m, v in (("mse", 2.0), ("mae", 1.0), ("r2", 0.25))]
    mets = spark.createDataFrame(rows, "target string, task string, n_classes bigint, metric string, value double")
    mets = mets.mapInArrow(counted, mets.schema)
    rec = run_record(SimpleNamespace(record={}, metrics=mets, verdicts=verdict.verdict(mets), clean=mets))
    assert reads.value == 3 and rec["sane"] and rec["verdicts"][0]["metrics"] == {"mse": 2.0, "mae": 1.0, "r2": 0.25}
