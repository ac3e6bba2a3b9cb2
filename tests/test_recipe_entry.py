from pyspark.sql import functions as F

from tabsmith.operators import audit
from tabsmith.plans.recipe import Config, fit
from conftest import SF


def test_recipe_contract_holds(spark):
    rows = [(i, f"ID{i}", "Yes" if i % 3 else "No", f"${i * 10:,}", "red" if i % 2 else "blue",
             None if i % 5 == 0 else float(i % 7), f"2024-02-{i % 28 + 1:02d}", "cheap" if i < 20 else "dear")
            for i in range(40)]
    df = spark.createDataFrame(rows, "row_id int, code string, warranty string, price string, color string, "
                                     "size double, sale_date string, label string")
    r = fit(df, Config(targets=("label",)))
    out = r.transform(df)
    audit.assert_clean(out, ["label"])
    assert "row_id" in r.drops and r.tasks == {"label": "Classification"}
    assert "price" in r.text.formatted and "warranty" in r.text.boolean
    assert r.date_columns == ("sale_date",)
    assert {"color_red", "color_blue", "sale_date_year"} <= set(out.columns)
    assert out.count() == 40


def test_unsupported_type_is_named(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    try:
        fit(df, Config(targets=("label",)))
    except TypeError as e:
        assert "embedding" in str(e)
    else:
        raise AssertionError("array column accepted")


def test_entry_and_registry(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["target", "task", "n_classes", "metric", "value"]
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 80
    from checks import registry
    assert not any(k.startswith("op") or k == "pipeline" for k in registry.QUERIES)


def test_profile_query_runs_on_driver_tables(spark):
    import __spark_entry__ as entry
    out = entry.queries()["profile_orders"](spark, SF)
    assert out.filter(F.col("column_name") == "o_orderkey").first().flags == "POTENTIAL ID"


def test_recipe_save_load_roundtrip(spark):
    from tabsmith.plans.recipe import load_recipe, save_recipe
    from tabsmith.sources import scratch_path
    d = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    r = fit(d, Config(targets=("quality",)))
    path = save_recipe(r, scratch_path(spark, "recipe"))
    r2 = load_recipe(spark, path)
    a, b = r.transform(d), r2.transform(d)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_parity_switch_for_many_class_text_target(spark):
    rows = [(i, float(i % 7), f"class{i % 20:02d}") for i in range(100)]
    df = spark.createDataFrame(rows, "row_id int, x double, label string")
    assert fit(df, Config(targets=("label",))).tasks == {"label": "Classification"}
    assert fit(df, Config(targets=("label",), parity=True)).tasks == {"label": "Regression"}


def test_loaded_recipe_keeps_mapping_sizes(spark):
    from tabsmith.plans.recipe import Config, fit, load_recipe, save_recipe
    from tabsmith.sources import scratch_path
    part = spark.read.parquet(f"{SF}/part.parquet")
    recipe = fit(part, Config(targets=("p_brand",)))
    back = load_recipe(spark, save_recipe(recipe, scratch_path(spark, "recipe")))
    assert back.label_counts().nbytes == recipe.label_counts().nbytes and back.label_counts().nbytes
    assert dict(back.label_counts()) == dict(recipe.label_counts())
    hints = lambda r: r.transform(part)._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")
    assert hints(back) > 0
