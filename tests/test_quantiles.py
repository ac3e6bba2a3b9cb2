import math
import random

import numpy as np
import pytest

from tabsmith.operators.outliers import fit_iqr
from tabsmith.operators.quantiles import exact_quantiles


def test_selection_equals_numpy(spark):
    rnd = random.Random(7)
    rows = [(rnd.random() * 100, float(rnd.randint(0, 30)), 5.0 if i % 3 else rnd.random(), rnd.expovariate(0.01)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, `d.e` double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for small, accuracy in ((50_000, 10_000), (5, 20)):
        got = exact_quantiles(df, ["a", "b", "c", "d.e"], probs, small=small, accuracy=accuracy)
        for i, c in enumerate(("a", "b", "c", "d.e")):
            assert got[c] == pytest.approx(np.quantile([r[i] for r in rows], probs).tolist(), rel=1e-12, abs=1e-12)


def test_nan_and_infinity(spark):
    vals = [math.nan] * 40 + [None] * 7 + [float(i) for i in range(60)] + [math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    clean = sorted(v for v in vals if v is not None and not math.isnan(v))
    for small in (50_000, 3):
        assert exact_quantiles(df, ["a"], [0.25, 0.5, 0.75, 1.0], small=small, accuracy=10)["a"] == pytest.approx(
            [*np.quantile(clean[1:-1] + [1e9, -1e9], [0.25, 0.5, 0.75]), math.inf])
    assert set(fit_iqr(df, ["a"])) == {"a"}


def test_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}
