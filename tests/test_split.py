import math
from collections import Counter

from pyspark.sql import functions as F

from tabsmith.operators import split as spl


def test_exact_split_properties(spark):
    df = spark.range(0, 1003).withColumnRenamed("id", "k")
    train, test = spl.split(df, "k")
    n_train, n_test = train.count(), test.count()
    assert n_test == math.ceil(0.2 * 1003) and n_train + n_test == 1003
    assert train.join(test, "k").count() == 0
    again = spl.split(df.repartition(7), "k")[1]
    assert sorted(r.k for r in again.collect()) == sorted(r.k for r in test.collect())


def test_cut_refines_with_small_buckets(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    hashed = df.select(spl.split_hash("k").alias("h"))
    want = sorted(r.h for r in hashed.collect())[999]
    assert spl._cut(hashed, 1000, small=3) == want


def test_tiny_table_is_both(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(4)], "id int, y double")
    train, test = spl.split(df, "id")
    assert train.count() == 4 and test.count() == 4


def test_bernoulli_mode_is_stable(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = spl.split_flags(df, "k", mode="bernoulli").filter("is_test").count()
    b = spl.split_flags(df.repartition(5), "k", mode="bernoulli").filter("is_test").count()
    assert a == b and 250 < a < 550


def test_display_columns():
    assert spl.display_columns(["Open", "x", "Close", "Volume"], ["Close"]) == ["Open", "Volume"]
    assert spl.display_columns(["a", "b", "y", "c", "d"], ["y"]) == ["a", "b", "c"]


def test_repeated_keys_are_cut_exactly(spark):
    rows = [(i % 7, i, "x") for i in range(100)] + [(3, None, "same")] * 400
    df = spark.createDataFrame(rows, "k int, v int, s string").repartition(6)
    for share in (0.05, 0.2, 0.33, 0.5, 0.9, 1.0):
        flagged = spl.split_flags(df, "k", share)
        got = [tuple(r) for r in flagged.collect()]
        assert Counter(r[:3] for r in got) == Counter(rows)
        assert sum(r[3] for r in got) == math.ceil(share * 500)
        again = spl.split_flags(df.repartition(2), "k", share)
        assert Counter(got) == Counter(tuple(r) for r in again.collect())
    # a key is only divided where the cut falls
    taken = {k: (n, t) for k, n, t in spl.split_flags(df, "k", 0.2).groupBy("k").agg(F.count("*"), F.count_if("is_test")).collect()}
    assert sum(0 < t < n for n, t in taken.values()) <= 1


def test_wholly_equal_rows(spark):
    df = spark.createDataFrame([("a", None)] * 50, "k string, v int")
    assert spl.split_flags(df, "k", 0.3).where("is_test").count() == 15
