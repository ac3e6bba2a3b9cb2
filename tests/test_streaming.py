from conftest import SF
from tabsmith.plans.run import run
from tabsmith.sources import scratch_path
from tabsmith.streaming import score_stream


def test_recipe_and_models_score_a_stream(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    res = run(o, "o_totalprice", "o_orderkey")
    src_dir = scratch_path(spark, "stream-in")
    o.write.parquet(src_dir)
    stream = spark.readStream.schema(o.schema).parquet(src_dir)
    out = scratch_path(spark, "stream-out")
    q = (score_stream(res.recipe, res.trained, stream).writeStream.format("parquet")
         .option("checkpointLocation", out + "-ckpt").trigger(availableNow=True).start(out))
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == o.count() and "Pred_o_totalprice" in got.columns


def test_fit_on_train_uses_training_rows_only(spark):
    import math
    o = spark.read.parquet(f"{SF}/orders.parquet")
    n = o.count()
    res = run(o, "o_totalprice", "o_orderkey", fit_on="train")
    assert res.test.count() == math.ceil(0.2 * n)
    assert res.train.count() == n - math.ceil(0.2 * n)
    assert res.recipe.profile_rows[0].n_rows == n - math.ceil(0.2 * n)
    assert res.record["fit_on"] == "train"
