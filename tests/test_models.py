"""Models of several targets and of many classes; the nested mapping document."""

import glob
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import encode, models
from tabsmith.plans.run import run
from tabsmith.sources import mappings_document, scratch_path, write_mappings_document


def numbers(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3)) * [1, 100, 0.01] + [1e6, 0, 3]
    y = x @ [[2.0, -1], [0.5, 0], [30, 7]] + [4, -9] + rng.normal(size=(n, 2))
    rows = [(*map(float, a), *map(float, b)) for a, b in zip(x, y, strict=True)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, `y.1` double, y2 double")


def closed_form(x, y, alpha=0.0):
    xc, yc = x - x.mean(0), y - y.mean(0)
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return x @ w + (y.mean(0) - x.mean(0) @ w)


@pytest.mark.parametrize("name,alpha", [("LinearRegression", 0.0), ("Ridge", 1.0)])
def test_linear_targets_together(spark, name, alpha):
    x, y, df = numbers(spark)
    tm = models.train(df, ["y.1", "y2"], name, {"y.1": "Regression", "y2": "Regression"})
    assert all(isinstance(m, models.LinearModel) for m in tm.models.values())
    path = scratch_path(spark, "together")
    models.save_models(tm, path)
    for t in (tm, models.load_models(spark, path)):
        got = models.predict(t, df, clip=False).select("`Pred_y.1`", "Pred_y2").collect()
        assert np.allclose(np.array(got), closed_form(x, y, alpha), atol=1e-5)


def test_together_equals_one_by_one_where_features_depend(spark):
    _, _, df = numbers(spark)
    wide = df.select("a", "b", (F.col("b") * 2 + 1).alias("twice"), F.lit(7.0).alias("same"), F.col("`y.1`").alias("y1"), "y2")
    both = models.predict(models.train(wide, ["y1", "y2"], "Linear", dict.fromkeys(["y1", "y2"], "Regression")), wide, clip=False)
    one = models.predict(models.train(wide.drop("y2"), ["y1"], "Linear", {"y1": "Regression"}), wide.drop("y2"), clip=False)
    assert np.allclose(sorted(r.Pred_y1 for r in both.collect()), sorted(r.Pred_y1 for r in one.collect()), atol=1e-2)


def test_a_target_with_nulls_keeps_its_own_rows(spark):
    _, _, df = numbers(spark, 60)
    df = df.withColumn("y2", F.when(F.col("b") > 0, F.col("y2"))).withColumnRenamed("y.1", "y1")
    tm = models.train(df, ["y1", "y2"], "LinearRegression", dict.fromkeys(["y1", "y2"], "Regression"))
    assert not any(isinstance(m, models.LinearModel) for m in tm.models.values())


def test_missing_feature_values_go_one_by_one(spark):
    _, _, df = numbers(spark, 60)
    rows = df.select("a", F.when(F.col("b") > 0, F.col("b")).alias("b"), F.array(F.col("y2")).getItem(0).alias("y2"), F.col("`y.1`").alias("y1"))
    made = models.assemble(rows, ["a", "b"]).select(models.FEATURES, "y1", "y2")
    assert models.fit_linear_together(made, ["y1", "y2"]) is None
    assert models.fit_linear_together(made.limit(0), ["y1", "y2"]) is None


@pytest.mark.parametrize("n,want", [(2, (1, 2)), (256, (1, 256)), (257, (2, 17)), (65536, (2, 256)), (65537, (3, 41))])
def test_digit_base(n, want):
    assert models.digit_base(n) == want


def test_class_codes_are_ranks(spark):
    df = spark.range(5000).select((F.col("id") % 1234 - 600).cast("double").alias("y")).union(spark.createDataFrame([(None,)], "y double"))
    codes, n = models.class_codes(df.repartition(7), "y")
    assert n == 1234 and sorted((r.value, r.code) for r in codes.collect()) == [(float(v - 600), v) for v in range(1234)]


@pytest.mark.parametrize("algorithm", ["DecisionTreeClassifier", "LogisticRegression"])
def test_many_classes_are_learned_in_digits(spark, algorithm):
    """The features mark the digits: logistic regression finds every class; only known values are predicted."""
    code = F.col("id") % 300
    marks = [(F.floor(code / 18) == i).cast("double").alias(f"a{i}") for i in range(17)] + [(code % 18 == i).cast("double").alias(f"b{i}") for i in range(18)]
    df = spark.range(1200).select(*marks, (code * 10 - 5).cast("double").alias("y"))
    tm = models.train(df, ["y"], algorithm, {"y": "Classification"}, max_classes=40)
    chain = tm.models["y"]
    assert (chain.n, chain.digits, chain.base, len(chain.models)) == (300, 2, 18, 2) and not tm.classes
    path = scratch_path(spark, "chain")
    models.save_models(tm, path)
    first = sorted(models.predict(tm, df).collect())
    assert sorted(models.predict(models.load_models(spark, path), df).collect()) == first
    assert len(first) == 1200 and {r.Pred_y for r in first} <= {r.y for r in first}
    if algorithm.startswith("Logistic"):
        assert all(r.y == r.Pred_y for r in first)


def test_over_a_hundred_classes_without_digits(spark):
    df = spark.range(600).select((F.col("id") % 150).cast("double").alias("a"), (F.col("id") % 150).cast("double").alias("y"))
    tm = models.train(df, ["y"], "RandomForestClassifier", {"y": "Classification"})
    assert len(tm.classes["y"]) == 150 and models.predict(tm, df).count() == 600


def test_run_with_two_linear_targets(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5 + 0.5).alias("b"))
    df = df.withColumn("y", F.col("a") * 2 + F.col("b")).withColumn("z", F.col("a") - 3 * F.col("b"))
    res = run(df, ["y", "z"], "k", allow_flaws=True)
    assert all(isinstance(m, models.LinearModel) for m in res.trained.models.values())
    assert all(r.value > 0.99 for r in res.metrics.collect() if r.metric == "r2")


def written(path):
    return "".join(open(f).read() for f in sorted(glob.glob(f"{path.removeprefix('file:')}/part-*")))


def test_mapping_document_is_one_json_text(spark):
    labels = ["plain", 'quo"te', "back\\slash", "line\nbreak", "é中", "", "}}", '"a":1']
    df = spark.createDataFrame([(x, f"v{i % 3}") for i, x in enumerate(labels)], "`co\"l` string, `z.z` string")
    m = encode.label_codes(df, df.columns)
    doc = json.loads(written(write_mappings_document(m, scratch_path(spark, "doc"))))
    assert doc == {'co"l': {x: i for i, x in enumerate(sorted(labels, key=str.encode))}, "z.z": {"v0": 0, "v1": 1, "v2": 2}}
    empty = m.limit(0)
    assert mappings_document(empty).count() == 0


def test_a_column_of_many_labels_is_split(spark):
    m = spark.range(200_000).select(F.lit("c").alias("column_name"), F.format_string("l%07d", "id").alias("label"), F.col("id").alias("code"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in mappings_document(m).groupBy(F.spark_partition_id()).count().collect()]
        doc = json.loads(written(write_mappings_document(m, scratch_path(spark, "long"))))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(sizes) < 60_000
    assert len(doc["c"]) == 200_000 and doc["c"]["l0199999"] == 199_999


def test_rows_of_a_chain_are_dealt_by_their_widened_size(spark, monkeypatch):
    """The written table is a file or two; the rows with the marks of earlier digits are many times as large."""
    n, seen = 3000, []
    df = spark.createDataFrame([(float(i % 7), i) for i in range(n)], "x double, label long")

    def noted(*args, **kw):
        est = estimator_for(*args, **kw)
        fit = est.fit
        est.fit = lambda rows: (seen.append([sum(1 for _ in p) for p in rows.select(rows.columns[-1]).rdd.glom().collect()]), fit(rows))[1]
        return est

    estimator_for = models.estimator_for
    monkeypatch.setattr(models, "estimator_for", noted)
    monkeypatch.setattr(models, "CHAIN_TASK_BYTES", 400_000)
    tm = models.train(df.coalesce(1), ["label"], "DecisionTreeClassifier", {"label": "Classification"}, max_classes=100)
    chain = tm.models["label"]
    assert (chain.digits, chain.base) == (2, 55) and len(seen) == 2
    for parts in seen:
        assert sum(parts) == n and len(parts) == 4 and max(parts) * 8 * (1 + 55) <= 400_000
