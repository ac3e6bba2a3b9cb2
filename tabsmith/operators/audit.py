"""Clean-table contract (V1-V6) and the two-gate audit (A1-A5).

Every check is one aggregate over the table or a look at its schema; the flaws are a
small table ``(column_name, flaw, n)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.dates import parse_datetime
from tabsmith.functions.stats import nan_to_null

DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
NUMERIC_OK = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType,
              T.DecimalType)


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, n_null)`` for every column plus ``n_rows``, one pass."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.count_if(nan_to_null(F.col(f"`{f.name}`"), f.dataType).isNull()).alias(f"z{i}")
        for i, f in enumerate(fields)]
    entries = [F.struct(F.lit(f.name).alias("column_name"), F.col(f"z{i}").alias("n_null"))
               for i, f in enumerate(fields)]
    if not entries:
        return df.sparkSession.createDataFrame([], "n_rows bigint, column_name string, n_null bigint")
    return (df.agg(*aggs).select(F.col("__n").alias("n_rows"), F.explode(F.array(*entries)).alias("e"))
              .select("n_rows", "e.*"))


def contract(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """V1-V5 as ``(check, passed, detail)`` rows."""
    spark = df.sparkSession
    fields = {f.name: f.dataType for f in df.schema.fields}
    non_num = [c for c, t in fields.items() if not isinstance(t, NUMERIC_OK)]
    missing = [t for t in targets if t not in fields]
    non_num_t = [t for t in targets if t in fields and not isinstance(fields[t], NUMERIC_OK)]
    nc = null_counts(df)
    agg = nc.agg(F.coalesce(F.sum("n_null"), F.lit(0)).alias("nulls"),
                 F.coalesce(F.max("n_rows"), F.lit(0)).alias("rows"))
    static = spark.createDataFrame([
        ("all_numeric", not non_num, ",".join(non_num)),
        ("target_present", not missing, ",".join(missing)),
        ("target_numeric", not non_num_t, ",".join(non_num_t)),
    ], "check string, passed boolean, detail string")
    dyn = agg.select(F.explode(F.array(
        F.struct(F.lit("no_nulls").alias("check"), (F.col("nulls") == 0).alias("passed"),
                 F.col("nulls").cast("string").alias("detail")),
        F.struct(F.lit("not_empty").alias("check"), (F.col("rows") > 0).alias("passed"),
                 F.col("rows").cast("string").alias("detail")))).alias("e")
    ).select("e.*")
    return dyn.unionByName(static)


def assert_clean(df: DataFrame, targets: Sequence[str]) -> None:
    """Raise ValueError naming every failed check (one aggregate pass)."""
    bad = [r for r in contract(df, targets).collect() if not r.passed]
    if bad:
        raise ValueError("; ".join(f"{r.check} failed ({r.detail})" for r in bad))


def gate_one(df: DataFrame) -> DataFrame:
    """A1 + A2: text columns, and columns holding nulls with their count."""
    spark = df.sparkSession
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    a1 = spark.createDataFrame([(c, "text", None) for c in text],
                               "column_name string, flaw string, n bigint")
    a2 = (null_counts(df).filter(F.col("n_null") > 0)
          .select("column_name", F.lit("nulls").alias("flaw"), F.col("n_null").alias("n")))
    return a1.unionByName(a2)


def gate_two(raw: DataFrame, clean: DataFrame, sample_dates: bool = True) -> DataFrame:
    """A3: the clean table must hold numbers only: no text, no dates, no date-like text."""
    spark = clean.sparkSession
    rows = []
    for f in clean.schema.fields:
        if isinstance(f.dataType, DATE_TYPES):
            rows.append((f.name, "date", None))
        elif not isinstance(f.dataType, (*NUMERIC_OK, T.StringType)):
            rows.append((f.name, "type:" + f.dataType.simpleString(), None))
    flaws = spark.createDataFrame(rows, "column_name string, flaw string, n bigint")
    text = [f.name for f in clean.schema.fields if isinstance(f.dataType, T.StringType)]
    if sample_dates and text:
        agg = clean.agg(*[F.count(parse_datetime(F.col(f"`{c}`"))).alias(f"d{i}") for i, c in enumerate(text)])
        entries = [F.struct(F.lit(c).alias("column_name"), F.lit("date_text").alias("flaw"),
                            F.col(f"d{i}").alias("n")) for i, c in enumerate(text)]
        flaws = flaws.unionByName(agg.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
                                  .filter(F.col("n") > 0))
    return flaws


def audit(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """A4: both gates, de-duplicated."""
    return gate_one(clean).unionByName(gate_two(raw, clean)).distinct()


def audit_passed(flaws: DataFrame) -> DataFrame:
    """A5: one row, ``passed`` iff there is no flaw."""
    return flaws.agg((F.count(F.lit(1)) == 0).alias("passed"), F.count(F.lit(1)).alias("n_flaws"))


def clean_report(raw: DataFrame, clean: DataFrame, targets: Sequence[str], tasks: dict,
                 dropped: dict, encodings: dict) -> DataFrame:
    """V6: ``(item, value)`` rows: shapes before/after, targets and tasks, drops, encodings."""
    spark = clean.sparkSession
    raw_rows = raw.count()
    clean_rows = clean.count()
    items = [("original_shape", f"{raw_rows} x {len(raw.columns)}"),
             ("cleaned_shape", f"{clean_rows} x {len(clean.columns)}")]
    items += [(f"target:{t}", tasks.get(t, "")) for t in targets]
    items += [(f"dropped:{c}", r) for c, r in sorted(dropped.items())]
    items += [(f"encoding:{c}", e) for c, e in sorted(encodings.items())]
    return spark.createDataFrame(items, "item string, value string")
