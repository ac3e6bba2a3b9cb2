from pyspark.sql import functions as F

from tabsmith.operators import dates, encode, impute, outliers, text
from tabsmith.sources.tables import infer_types


def test_formatted_examples_and_guard(spark):
    rows = [("45,000 kms", "$1,200", "15%", "Brand#17"), ("1,000 kms", "$30", "7%", "Brand#2"),
            ("12 kms", "$5.50", "0%", "Brand#3")]
    df = spark.createDataFrame(rows, "distance string, price string, discount string, brand string")
    plan = text.fit_text(df)
    assert set(plan.formatted) == {"distance", "price", "discount"} and "brand" not in plan.formatted
    out = text.apply_text(df, plan).first()
    assert (out.distance, out.price, out.discount, out.brand) == (45000.0, 1200.0, 15.0, "Brand#17")


def test_half_failing_reverts(spark):
    rows = [("$1",), ("$2",), ("abc",), ("xyz",), ("qq",)]
    df = spark.createDataFrame(rows, "price string")
    assert text.fit_text(df).formatted == ()


def test_long_text_and_boolean_words(spark):
    rows = [("Honda Civic 2019 LX", "Yes"), ("Toyota Corolla 2018 SE", "n"), ("Ford Focus 2017 ST", None)]
    df = spark.createDataFrame(rows, "model string, warranty string")
    plan = text.fit_text(df)
    out = text.apply_text(df, plan).orderBy("model").collect()
    assert [r.model for r in out] == ["Ford Focus", "Honda Civic", "Toyota Corolla"]
    assert [r.warranty for r in out] == [None, 1, 0]


def test_dates_parse_drop_and_share(spark):
    rows = [(i, f"2024-01-{i + 1:02d}" if i < 9 else "oops") for i in range(10)]
    df = spark.createDataFrame(rows, "id int, order_date string")
    assert dates.find_dates(df) == ["order_date"]
    out = dates.date_parts(df, ["order_date"])
    assert out.count() == 9
    r = out.filter("id = 0").first()
    assert (r.order_date_year, r.order_date_month, r.order_date_day, r.order_date_dayofweek) == (2024, 1, 1, 0)
    bad = spark.createDataFrame([(i, "2024-01-01" if i < 7 else "x") for i in range(10)], "id int, order_date string")
    assert dates.find_dates(bad) == []


def test_fill_rules(spark):
    pos = [(None if v is None else float(v),) for v in [1, 1, 1, 2, 2, 3, 50, None]]
    neg = [(None if v is None else float(v),) for v in [-50, 1, 2, 2, 3, 3, 3, None]]
    p = impute.fit_numeric_fill(spark.createDataFrame(pos, "a double"), ["a"])
    n = impute.fit_numeric_fill(spark.createDataFrame(neg, "a double"), ["a"])
    assert p.numeric["a"] == (2.0, "median")
    assert n.numeric["a"][1] == "mean"
    modes = impute.fit_mode_fill(spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string"), ["c"])
    assert modes == {"c": "a"}
    empty = impute.fit_mode_fill(spark.createDataFrame([(None,)], "c string"), ["c"])
    assert empty == {"c": "Unknown"}


def test_clip_bounds_binary_and_idempotent(spark):
    rows = [(float(v), float(v % 2)) for v in list(range(20)) + [1000]]
    df = spark.createDataFrame(rows, "a double, b double")
    b = outliers.fit_iqr(df, ["a", "b"])
    assert "b" not in b
    once = outliers.clip(df, b)
    twice = outliers.clip(once, b)
    assert once.agg(F.max("a")).first()[0] == b["a"][3]
    assert sorted(r.a for r in once.collect()) == sorted(r.a for r in twice.collect())


def test_levels_15_vs_16(spark):
    rows = [(i, f"v{i % 15:02d}", f"w{i % 16:02d}") for i in range(64)]
    df = spark.createDataFrame(rows, "id int, c15 string, c16 string")
    plan = encode.fit_encoding(df)
    assert list(plan.one_hot) == ["c15"] and plan.label == ("c16",)
    out = encode.apply_encoding(df, plan)
    assert "c15_v00" in out.columns and dict(out.dtypes)["c16"] == "bigint"
    assert out.filter("id = 17").first().c16 == 1


def test_label_codes_many_partitions_and_decode_identity(spark):
    labels = [f"l{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(x,) for x in labels], "c string").repartition(13)
    m = encode.label_codes(df, ["c"], partitions=11)
    got = {r.label: r.code for r in m.collect()}
    assert got == {x: i for i, x in enumerate(sorted(labels))}
    coded = encode.apply_labels(df, m, ["c"], {"c": 500})
    back = encode.decode(coded.withColumn("c", F.col("c").cast("double") + 0.5), m, {"c": "c"})
    assert sorted(r.c for r in back.collect()) == sorted(labels)
    unk = encode.decode(spark.createDataFrame([(9999.0,), (None,)], "c double"), m, {"c": "c"})
    assert [r.c for r in unk.collect()] == ["Unknown", "Unknown"]


def test_csv_typing(spark):
    df = spark.createDataFrame([("1", "1.5", "True", "NA", "x"), ("2", "NA", "False", "3", "y"),
                                ("3", "2", "True", "4", None)], "i string, f string, b string, n string, s string")
    nulls = df.select(*[F.when(F.col(c).isin("NA"), None).otherwise(F.col(c)).alias(c) for c in df.columns])
    t = dict(infer_types(nulls).dtypes)
    assert t == {"i": "bigint", "f": "double", "b": "boolean", "n": "double", "s": "string"}


def test_fill_covers_nulls_unseen_at_fit(spark):
    fitted = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.0)], "k int, a double")
    plan = impute.fit_fill(fitted)
    new = spark.createDataFrame([(None, None), (5, 1.0)], "k int, a double")
    out = impute.apply_fill(new, plan)
    assert dict(out.dtypes) == {"k": "int", "a": "double"}
    assert sorted((r.k, r.a) for r in out.collect()) == [(2, 4.0), (5, 1.0)]


def test_unseen_label_code(spark):
    fitted = spark.createDataFrame([(f"l{i:02d}",) for i in range(20)], "c string")
    m = encode.label_codes(fitted, ["c"])
    new = spark.createDataFrame([("l03",), ("zzz",), (None,)], "c string")
    got = sorted(((r.c if r.c is not None else -9)) for r in encode.apply_labels(new, m, ["c"], {"c": 20}).collect())
    assert got == [-9, -1, 3]
    back = encode.decode(encode.apply_labels(new, m, ["c"], {"c": 20}), m, {"c": "c"})
    assert sorted(r.c for r in back.collect()) == ["Unknown", "Unknown", "l03"]
