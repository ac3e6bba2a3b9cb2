"""Plan-shape checks: shared shuffles stay shared, no keyless joins, scans stay pruned."""

from pyspark.sql import functions as F

from conftest import SF
from tabsmith.operators import encode, profile
from tabsmith.plans import recipe


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_profile_reuses_value_count_shuffle(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = _final_plan(profile.counted(li))
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_profile_shuffles_no_texts(spark):
    """What the value counts shuffle is hashes and a prefix of 16 bytes, whatever the texts."""
    d = spark.read.parquet(f"{SF}/documents.parquet")
    counts = profile.hashed_counts(d)
    keys = dict(counts.dtypes)
    assert keys == {"ordinal": "int", "h1": "bigint", "h2": "bigint", "prefix": "binary", "cnt": "bigint"}
    assert counts.agg(F.max(F.octet_length("prefix"))).first()[0] == profile.PREFIX
    plan = _final_plan(profile.counted(d))
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert shuffled and not any("text#" in line or "v_str#" in line for line in shuffled)


def test_apply_labels_broadcasts_only_small_counted_mappings(spark):
    p = spark.read.parquet(f"{SF}/part.parquet")
    m, counts = encode.label_codes_counted(p, ["p_name"])
    hints = lambda df: df._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")
    # the mapping itself joins two tiny offset tables by broadcast; the label join adds one
    # more hint only when the label count is known and small
    small = encode.apply_labels(p, m, ["p_name"], counts)
    unknown = encode.apply_labels(p, m, ["p_name"], {})
    assert hints(small) == hints(unknown) + 1


def test_scan_prunes_columns(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    from tabsmith.operators import metrics
    df = metrics.regression_metrics(li.select(F.col("l_extendedprice").alias("y"),
                                              (F.col("l_quantity") * 950.0).alias("p")), "y", "p")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_returnflag" not in plan


def test_recipe_fit_reads_the_source_four_times(spark):
    """Every row that a scan of the source hands on is counted: four times the rows at most."""
    for name, target in (("lineitem", "l_extendedprice"), ("orders", "o_orderstatus"), ("customer", "c_acctbal")):
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        read = spark.sparkContext.accumulator(0)

        def passed(batches, read=read):
            for b in batches:
                read.add(b.num_rows)
                yield b

        fitted = recipe.fit(table.mapInArrow(passed, table.schema), recipe.Config(targets=(target,)))
        assert 0 < read.value <= 4 * table.count(), (name, read.value / table.count())
        assert fitted.profile_rows and fitted.tasks[target]
