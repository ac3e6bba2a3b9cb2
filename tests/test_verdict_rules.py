"""Rules that ordinary tables break: odd names, odd classes, repeated keys, wide duplicates, submitted settings."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import encode, models, prune, split, target, verdict
from tabsmith.operators.profile import profile
from tabsmith.plans.recipe import Config, fit
from tabsmith.plans.run import run


def table(spark, n=60):
    return spark.createDataFrame([(i, f"u{i}", ["U.S.", "U_S_", "x"][i % 3], float(i % 7), float(i) * 1.5 + (i % 5), [-1, 1][i % 2], 2000 + i % 4, (i % 11) / 100)
                                  for i in range(n)], "k long, user_id string, `land.` string, a double, `price.usd` double, sign int, year_class int, rate double")


def test_names_with_dots_run_end_to_end(spark):
    res = run(table(spark), "price.usd", "k", allow_flaws=True)
    assert "Pred_price.usd" in res.scored.columns and res.metrics.count() == 3
    assert res.recipe.drops.get("user_id") == "id"


def test_dummy_names_are_unique():
    got = encode.dummy_names(["a", "a_b", "Z"], {"a": ("b_c", "U.S."), "a_b": ("c", "C")})
    assert [n for _, _, n in got] == ["a_b_c", "a_U_S_", "a_b_c_2", "a_b_C_3"]


@pytest.mark.parametrize("name,k", [("sign", 2), ("year_class", 4), ("rate", 11)])
def test_numeric_classes(spark, name, k):
    df = table(spark, 120).select("a", F.col("`price.usd`").alias("p"), F.col(name).cast("double").alias("y"))
    tm = models.train(df, ["y"], "DecisionTreeClassifier", {"y": "Classification"})
    assert len(tm.classes["y"]) == k
    values = {r.Pred_y for r in models.predict(tm, df).collect()}
    assert values <= set(tm.classes["y"])


def test_algorithm_names(spark):
    for name in ("SVR", "KNeighborsRegressor", "LSTM"):
        with pytest.raises(ValueError):
            models.estimator_for(name, "Regression", "y")
    ridge = models.estimator_for("Ridge", "Regression", "y", n_rows=10)
    lasso = models.estimator_for("Lasso", "Regression", "y")
    assert (ridge.getRegParam(), ridge.getElasticNetParam(), lasso.getRegParam(), lasso.getElasticNetParam()) == (0.1, 0.0, 1.0, 1.0)


def test_unique_price_is_a_target(spark):
    df = spark.createDataFrame([(i, i + 0.5, i % 2) for i in range(40)], "order_id int, price double, flag int")
    got = {r.column_name: r.weight for r in target.rank_targets(profile(df)).collect()}
    assert got == {"order_id": 0.0, "price": 1.0, "flag": 1.0}


def test_repeated_key_is_cut_exactly(spark):
    df = spark.range(90).select((F.col("id") / 30).cast("int").alias("k"), "id")
    train, test = (sorted(r.id for r in part.collect()) for part in split.split(df, "k"))
    assert len(test) == 18 and sorted(train + test) == list(range(90))


def test_fit_on_train_of_a_tiny_table(spark):
    res = run(spark.createDataFrame([(i, float(i), i * 2.0 + i % 2) for i in range(4)], "k int, a double, y double"), "y", "k",
              allow_flaws=True, fit_on="train", algorithm="LinearRegression")
    assert res.train.count() == res.test.count() == 4


def test_many_equal_columns(spark):
    df = spark.range(30).select(*[(F.col("id") % 7).alias(f"c{i}") for i in range(60)], F.col("id").alias("z"))
    got = {r.column_name: r.duplicate_of for r in prune.find_duplicate_columns(df).collect()}
    assert got == {f"c{i}": "c0" for i in range(1, 60)}


def test_verdict_metrics_are_a_map(spark):
    m = spark.createDataFrame([("y", "Regression", "r2", 0.5, None), ("y", "Regression", "mae", 1.0, None)], "target string, task string, metric string, value double, n_classes int")
    row = verdict.verdict(m).select("metrics", verdict.metric_text(F.col("metrics")).alias("t")).first()
    assert row.metrics == {"mae": 1.0, "r2": 0.5} and row.t == "mae=1.0000, r2=0.5000"


def test_artifacts(spark):
    from tabsmith.sources.records import read_run_record
    from tabsmith.sources.tables import scratch_path
    path = scratch_path(spark, "run")
    res = run(table(spark), "rate", "k", algorithm="DecisionTreeRegressor", allow_flaws=True, out_path=path)
    assert spark.read.parquet(f"{path}/train").count() + spark.read.parquet(f"{path}/test").count() == 60
    again = models.predict(models.load_models(spark, f"{path}/models"), res.test).collect()
    assert sorted(again) == sorted(res.scored.collect())
    assert read_run_record(spark, f"{path}/record")["paths"]["models"] == f"{path}/models"


def test_submitted_settings_win():
    code = ("from tabsmith.session import get_spark; s = get_spark(); "
            "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.enabled'))")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[1] --conf spark.sql.shuffle.partitions=1234 --conf spark.sql.session.timeZone=America/New_York pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "GOT 1234 America/New_York true" in out.stdout, out.stderr[-800:]


def test_recipe_drops_text_ids_by_default(spark):
    assert "user_id" in fit(table(spark), Config(targets=["rate"], validate=False)).drops
    assert "user_id" not in fit(table(spark), Config(targets=["rate"], validate=False, protect_text=True)).drops
