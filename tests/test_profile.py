import pandas as pd
import pytest

from tabsmith.operators import impute, prune
from tabsmith.operators.profile import collect_profile, profile, top_values_long


def test_g1_skew_matches_pandas(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    row = profile(df, digits=None).first()
    assert row.skew == pytest.approx(pd.Series(vals).skew(), rel=1e-9)
    assert row.std == pytest.approx(pd.Series(vals).std(), rel=1e-9)


def test_ties_value_ascending(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate("bbaaccd")], "id int, c string")
    tops = [(r.rank, r.value, r.cnt) for r in top_values_long(df, 3, ["c"]).orderBy("rank").collect()]
    assert tops == [(1, "a", 2), (2, "b", 2), (3, "c", 2)]


def test_all_null_and_constant_flags(spark):
    df = spark.createDataFrame([(i, None, None, 7) for i in range(10)], "id int, a double, b string, k int")
    p = {r.name: r for r in collect_profile(df)}
    assert p["a"].flags == "CONSTANT, HIGH NULL" and p["a"].null_pct == 100.0
    assert p["b"].flags == "CONSTANT, HIGH NULL"
    assert p["k"].flags == "CONSTANT" and p["k"].skew is None
    assert p["id"].flags == "POTENTIAL ID"


def test_high_null_boundary(spark):
    rows = [(i, None if i < 6000 else float(i)) for i in range(10000)]
    rows2 = [(i, None if i < 6001 else float(i)) for i in range(10000)]
    kept = spark.createDataFrame(rows, "id int, a double")
    dropped = spark.createDataFrame(rows2, "id int, a double")
    assert prune.find_high_null(profile(kept)).count() == 0
    assert [r.column_name for r in prune.find_high_null(profile(dropped)).collect()] == ["a"]


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "a double")
    r = profile(df).first()
    assert r.null_pct == 50.0 and r.n_distinct == 2


def test_duplicate_columns(spark):
    rows = [(i, float(i % 3) if i != 5 else None, float(i % 3) if i != 5 else None,
             float(i % 3) if i != 7 else 9.0) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    dup = {r.column_name: r.duplicate_of for r in prune.find_duplicate_columns(df).collect()}
    assert dup == {"b": "a"}


def test_id_rule_and_text_protection(spark):
    rows = [(i, f"name{i}", i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "order_id int, c_name string, flag int")
    plan = {r.column_name: r.reasons for r in prune.plan_drops(df, ["flag"]).collect()}
    assert plan == {"order_id": "id"}


def test_top_values_of_long_texts(spark):
    """Ties at the last place among texts that share their first 16 bytes, few and more than are kept."""
    stem = "http://www.example.com/"
    for n in (10, 200):
        values = [f"{stem}{i:04d}" for i in range(n)] * 2 + [stem + "many"] * 5 + ["short"] * 2 + [f"{stem}once{i}" for i in range(30)]
        df = spark.createDataFrame([(v, "x" * 15, "y" * 16, "z" * 17, None) for v in values], "a string, b string, c string, d string, e string").repartition(5)
        got = {(r.column_name, r["rank"]): (r.value, r.cnt) for r in top_values_long(df, 4).collect()}
        assert [got["a", i] for i in range(1, 5)] == [(stem + "many", 5), *[(f"{stem}{i:04d}", 2) for i in range(3)]]
        assert got["b", 1][0] == "x" * 15 and got["c", 1][0] == "y" * 16 and got["d", 1] == ("z" * 17, len(values))
        assert {c for c, _ in got} == set("abcd")
    unique = spark.createDataFrame([(f"{stem}{i}",) for i in range(500, 0, -1)], "a string").repartition(7)
    assert [r.value for r in top_values_long(unique, 3).orderBy("rank").collect()] == sorted(f"{stem}{i}" for i in range(1, 501))[:3]


def test_modes_and_levels_of_long_texts(spark):
    rows = [("a long value beyond sixteen bytes" if i % 3 else "b" * 40, f"level {i % 15:02d} of fifteen, all long", f"l{i % 16}", None, i % 2 == 0) for i in range(96)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e boolean")
    modes, levels = impute.fit_modes_and_levels(df, list("abcde"))
    assert modes == {"a": "a long value beyond sixteen bytes", "b": "level 00 of fifteen, all long", "c": "l0", "d": "Unknown", "e": "false"}
    assert levels["a"] == ("a long value beyond sixteen bytes", "b" * 40) and len(levels["b"]) == 15 and levels["c"] is None and levels["d"] == ("Unknown",)
    assert "e" not in levels


def test_zeros_and_nan_are_one_value(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3), (1.5, 4)], "a double, b int")
    got = {r.column_name: r.n_distinct for r in profile(df).collect()}
    assert got == {"a": 2, "b": 4}
