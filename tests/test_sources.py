import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF
from tabsmith import sources as src
from tabsmith.sources import csv_split
from tabsmith.sources.tables import wider
from tabsmith.operators import sample


def test_discover_file_dir_and_empty(spark):
    names = [r.name for r in src.discover(spark, SF).collect()]
    assert "orders.parquet" in names and len(names) == 14
    one = src.discover(spark, f"{SF}/orders.parquet").collect()
    assert [r.name for r in one] == ["orders.parquet"]
    empty = src.scratch_path(spark, "empty")
    spark.createDataFrame([("x",)], "a string").write.text(empty)
    with pytest.raises(ValueError):
        src.discover(spark, empty)


def test_write_refuses_its_own_input(spark):
    path = src.scratch_path(spark, "t")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    with pytest.raises(ValueError):
        src.write_table(df, path)


def test_csv_roundtrip_and_peek(spark):
    path = src.scratch_path(spark, "csv")
    df = spark.createDataFrame([("1", "NA", "True"), ("2", "2.5", "False")], "i string, f string, b string")
    src.write_table(df, path, "csv")
    assert src.peek_columns(spark, path) == ["i", "f", "b"]
    back = src.read_table(spark, path)
    assert dict(back.dtypes) == {"i": "bigint", "f": "double", "b": "boolean"}
    assert back.filter(F.col("f").isNull()).count() == 1


def test_pool_and_mappings(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2, 3.0)], "k int, v double")
    p = src.pool([a, b], ["a", "b"]).orderBy("k").collect()
    assert [(r.k, r.s, r.v, r.source) for r in p] == [(1, "x", None, "a"), (2, None, 3.0, "b")]
    assert src.read_mappings(spark, src.scratch_path(spark, "missing")) is None


def test_window_sample_and_head(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    s1 = sorted(r.o_orderkey for r in sample.window_sample(o, "o_orderkey").collect())
    s2 = sorted(r.o_orderkey for r in sample.window_sample(o.repartition(3), "o_orderkey").collect())
    assert s1 == s2 and len(s1) == 10 and max(s1) < 1000
    lines = [r.line for r in sample.head_rows(o, 2, "o_orderkey", "|").orderBy("line_no").collect()]
    assert lines[0] == "|".join(o.columns) and len(lines) == 3


def test_csv_quotes_newlines_and_blanks(spark):
    path = src.scratch_path(spark, "csv")
    rows = [(1, 'he said "hi, you"'), (2, "two\nlines\r\nthree"), (3, "  kept  "), (4, '"'), (5, "a,b")]
    src.write_table(spark.createDataFrame(rows, "i long, s string"), path, "csv")
    assert sorted(map(tuple, src.read_table(spark, path).collect())) == rows
    with pytest.raises(Exception):
        src.read_table(spark, path, multiline=False, infer=False).collect()


def test_pool_widens_types(spark):
    wide = lambda a, b: wider(*(T._parse_datatype_string(x) if x != 'void' else T.NullType() for x in (a, b))).simpleString()
    cases = {("int", "bigint"): "bigint", ("smallint", "int"): "int", ("int", "double"): "double", ("float", "float"): "float", ("float", "int"): "double",
             ("decimal(10,2)", "decimal(8,4)"): "decimal(12,4)", ("decimal(38,0)", "decimal(38,10)"): "double", ("decimal(10,2)", "int"): "double",
             ("int", "string"): "string", ("boolean", "int"): "string", ("date", "timestamp"): "timestamp", ("date", "timestamp_ntz"): "timestamp_ntz",
             ("timestamp", "timestamp_ntz"): "timestamp_ntz", ("date", "int"): "string", ("void", "date"): "date", ("boolean", "void"): "boolean"}
    for (a, b), want in cases.items():
        assert wide(a, b) == wide(b, a) == want, (a, b)
    frames = [spark.createDataFrame(rows, schema) for rows, schema in (
        ([(1, True, 5)], "a int, b boolean, only long"), ([(2 ** 40, "text")], "a long, b string"), ([("x", 1.5)], "a string, b double"), ([], "a double, b date"))]
    got = src.pool(frames, list("pqrs")).orderBy("source")
    assert dict(got.dtypes) == {"a": "string", "b": "string", "only": "bigint", "source": "string"}
    assert [tuple(r) for r in got.collect()] == [("1", "true", 5, "p"), (str(2 ** 40), "text", None, "q"), ("x", "1.5", None, "r")]
    # nothing is cast where the types agree
    assert "cast(" not in src.pool(frames[:1] * 2, ["p", "q"])._jdf.queryExecution().analyzed().toString()


def test_split_csv_equals_the_whole_file_reader(spark):
    rows = [(i, ["plain", 'he said "hi, you"', "two\nlines\r\nthree", "\n\n" * 40, "a,b", '"', "", None, "  kept  ", "é漢\n,"][i % 10], "x" * (i % 50)) for i in range(3000)]
    path = src.scratch_path(spark, "csv")
    src.write_table(spark.createDataFrame(rows, "i long, s string, `t,u` string").repartition(2), path, "csv")
    whole = src.read_table(spark, path, split=False)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000b", "7777b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            parts = src.read_table(spark, path)  # larger than a partition: split
            assert parts.dtypes == whole.dtypes
            assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
            assert csv_split.read_records(spark, path).where("block > 0").count() > 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quoted_state():
    from tabsmith.sources.csv_split import inside_after
    assert not inside_after('a,5" disk,b', False) and inside_after('a,"open', False) and not inside_after('end",b', True)
    assert inside_after('still ""quoted"" here', True) and inside_after('x","new', True) and not inside_after('"a ""b"" c",d', False)
