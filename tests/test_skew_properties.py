import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsmith.operators import encode, logs
from tabsmith.operators.profile import collect_profile, top_values_long
from tabsmith.operators.quantiles import exact_quantiles


def _hot_table(spark, n=3000):
    # one value holds a third of all rows
    rows = [(i, "hot" if i % 3 == 0 else f"v{i % 997:04d}") for i in range(n)]
    return spark.createDataFrame(rows, "id int, c string").repartition(6)


def test_hot_value_profile_and_top_values(spark):
    df = _hot_table(spark)
    tops = top_values_long(df, 3, ["c"]).orderBy("rank").collect()
    assert tops[0].value == "hot" and tops[0].cnt == 1000
    p = {r.name: r for r in collect_profile(df)}
    assert p["c"].n_distinct == 998 and p["id"].flags == "POTENTIAL ID"


def test_hot_value_label_codes(spark):
    df = _hot_table(spark)
    m = {r.label: r.code for r in encode.label_codes(df, ["c"], partitions=5).collect()}
    labels = sorted({r.c for r in df.select("c").distinct().collect()})
    assert m == {x: i for i, x in enumerate(labels)}
    coded = encode.apply_labels(df, encode.label_codes(df, ["c"]), ["c"], {"c": len(labels)})
    assert coded.filter(F.col("c") == labels.index("hot")).count() == 1000


def test_hot_run_in_log_table(spark):
    rows = [(1, i, f"line {i}") for i in range(3000)] + [(2, 0, "only line")]
    df = spark.createDataFrame(rows, "run_id int, line_no int, line string").repartition(4)
    snip = {r.run_id: r.snippet for r in logs.snippet(df).collect()}
    assert snip[1].split("\n") == [f"line {i}" for i in range(2985, 3000)]
    assert snip[2] == "only line"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.integers(-50, 50).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                min_size=1, max_size=300))
def test_selection_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = exact_quantiles(df, ["a"], [0.25, 0.5, 0.75], small=7, accuracy=10)["a"]
    want = np.quantile(np.array(values), [0.25, 0.5, 0.75], method="linear")
    assert np.allclose(got, want, rtol=1e-12, atol=1e-9)
