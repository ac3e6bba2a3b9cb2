import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

from tabsmith.operators import metrics, verdict


def test_classification_matches_mllib(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 0.0), (2.0, 2.0), (1.0, 0.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    m = metrics.classification_metrics(df, "y", "p").first()
    ev = lambda name: MulticlassClassificationEvaluator(labelCol="y", predictionCol="p",
                                                        metricName=name).evaluate(df)
    assert m.accuracy == pytest.approx(ev("accuracy"))
    assert m.precision == pytest.approx(ev("weightedPrecision"))
    assert m.recall == pytest.approx(ev("weightedRecall"))
    assert m.f1 == pytest.approx(ev("weightedFMeasure"))


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0), (0, 0)], "y int, p int")
    m = metrics.classification_metrics(df, "y", "p").first()
    assert m.precision == pytest.approx(0.25) and m.recall == pytest.approx(0.5)


def test_regression_matches_mllib_and_negative_r2(spark):
    rows = [(1.0, 1.5), (2.0, 1.0), (3.0, 3.5), (4.0, 2.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    m = metrics.regression_metrics(df, "y", "p").first()
    for name, v in (("mse", m.mse), ("mae", m.mae), ("r2", m.r2)):
        assert v == pytest.approx(RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df))
    bad = spark.createDataFrame([(1.0, 10.0), (2.0, -5.0)], "y double, p double")
    assert metrics.regression_metrics(bad, "y", "p").first().r2 < 0


def test_verdict_thresholds(spark):
    rows = [("a", "Classification", 2, "accuracy", 0.55), ("b", "Classification", 2, "accuracy", 0.54),
            ("c", "Classification", 3, "accuracy", 0.45), ("d", "Regression", None, "r2", 0.0),
            ("e", "Regression", None, "r2", 0.3)]
    m = spark.createDataFrame(rows, "target string, task string, n_classes bigint, metric string, value double")
    v = {r.target: r.passed for r in verdict.verdict(m).collect()}
    assert v == {"a": True, "b": False, "c": True, "d": False, "e": True}
    assert verdict.overall(verdict.verdict(m)).first().sane is False
