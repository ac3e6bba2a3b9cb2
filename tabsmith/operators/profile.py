"""Column profiling (shape, types, nulls, distinct counts, moments, top values, flags).

Two scans feed the whole profile and Spark runs them as one job:

* a long-form aggregate by column ordinal (counts, moments, and an order-free fingerprint -- xor and
  bounded sum of value hashes -- used by the duplicate finder) that combines map-side;
* one value-count shuffle of fixed-size keys: every value goes as two 64-bit hashes and the first
  ``PREFIX`` bytes of its text, counted with partial aggregation. Distinct counts and top values both
  read it (the exchange is reused), so neither the width of the table nor the length of its texts
  shows in the number or size of the shuffled rows.

Top values are ranked by count and prefix. Values shorter than the prefix are already known; the few
longer ones that can be shown are looked up in one pass that keeps only rows with their hashes. Only a
few rows per column reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tabsmith import fixed
from tabsmith.functions.stats import g1_skew, is_integral, is_numeric, nan_to_null
from tabsmith.functions.unpivot import unpivot
from tabsmith.operators.text import TextProbe, stat_aggregates
from tabsmith.operators.topk import top_k_per_group

VALUE_COLS = ("v_long", "v_dbl", "v_str")
#: Bytes of a text that the value-count shuffle carries, and values kept beyond the ones shown to find ties at the last place.
PREFIX, SLACK = 16, 64
HASH_COLS = ("h1", "h2", "prefix")


def _typed_value(c, dt):
    """Put a value into exactly one typed slot so counting never formats numbers."""
    long_v = F.lit(None).cast("bigint")
    dbl_v = F.lit(None).cast("double")
    str_v = F.lit(None).cast("string")
    if is_integral(dt):
        long_v = c.cast("bigint")
    elif is_numeric(dt):
        dbl_v = nan_to_null(c, dt).cast("double")
    else:
        str_v = c.cast("string")
    return long_v, dbl_v, str_v


def long_values(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Unpivot to ``(ordinal, v_long, v_dbl, v_str)``, nulls removed. No shuffle."""
    cols = cols or df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    entries = []
    for name in cols:
        i = df.columns.index(name)
        lv, dv, sv = _typed_value(F.col(f"`{name}`"), fields[name])
        entries.append(F.struct(F.lit(i).alias("ordinal"), lv.alias("v_long"),
                                dv.alias("v_dbl"), sv.alias("v_str")))
    kv = F.explode(F.array(*entries)).alias("kv")
    return (df.select(kv).select("kv.*")
              .filter(F.col("v_long").isNotNull() | F.col("v_dbl").isNotNull()
                      | F.col("v_str").isNotNull()))


def value_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(ordinal, v_long, v_dbl, v_str, cnt)``: one row per distinct value of every column."""
    return (long_values(df, cols)
            .groupBy("ordinal", *VALUE_COLS)
            .agg(F.count(F.lit(1)).alias("cnt")))


def _text_hashes(c) -> tuple:
    """128 bits that stand for a value: two hashes with different seeds."""
    return F.xxhash64(c), F.xxhash64(F.lit(1), c)


def hashed_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Unpivot to ``(ordinal, h1, h2, prefix)``, nulls removed; numbers have no prefix. No shuffle."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    entries = []
    for name in cols:
        c, dt = F.col(f"`{name}`"), fields[name]
        prefix = F.lit(None).cast("binary")
        if is_integral(dt):
            v, (h1, h2) = c, (c.cast("bigint"), F.lit(0).cast("bigint"))
        elif is_numeric(dt):
            v = nan_to_null(c, dt).cast("double") + F.lit(0.0)  # one zero
            h1, h2 = _text_hashes(v)
        else:
            v = c.cast("string")
            h1, h2 = _text_hashes(v)
            prefix = F.substring(v.cast("binary"), 1, PREFIX)
        entries.append((F.lit(df.columns.index(name)), F.when(v.isNotNull(), h1), h2, prefix))
    return unpivot(df, entries, ("ordinal", *HASH_COLS)).where(F.col("h1").isNotNull())


def hashed_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(ordinal, h1, h2, prefix, cnt)``: one row per distinct value of every column, no text over ``PREFIX`` bytes."""
    return hashed_values(df, cols or df.columns).groupBy("ordinal", *HASH_COLS).agg(F.count(F.lit(1)).alias("cnt"))


def leading_hashes(counts: DataFrame, k: int) -> DataFrame:
    """``(ordinal, l)``: the first ``k + SLACK`` values of every column by count, then prefix, as an array."""
    order = [F.col("cnt").desc(), F.col("prefix").asc(), F.col("h1").asc(), F.col("h2").asc()]
    ranked = top_k_per_group(counts, ["ordinal"], order, k + SLACK, F.col("h1"))
    return ranked.groupBy("ordinal").agg(F.array_sort(F.collect_list(F.struct("rank", "cnt", *HASH_COLS))).alias("l"))


def top_values(df: DataFrame, leading: dict[int, list], k: int) -> dict[int, list[tuple[str, int]]]:
    """``{ordinal: [(value, count), ...]}``: the ``k`` most frequent values, ties by value ascending.

    ``leading`` has the rows of ``leading_hashes`` (``l``) of the columns wanted. What ties with the
    last place shown by count and prefix is compared by its whole text. If more values tie there than
    were kept, the texts with that prefix are ranked themselves (bounded top-k, salted).
    """
    exact: dict[int, list[tuple[str, int]]] = {}
    wanted: dict[int, dict] = {}
    crowded: dict[int, tuple] = {}
    for i, rows in leading.items():
        rows = sorted(rows, key=lambda r: r["rank"])
        place = lambda r: (-r["cnt"], bytes(r["prefix"]))
        last = place(rows[min(k, len(rows)) - 1])
        kept = [r for r in rows if place(r) <= last]
        if len(rows) >= k + SLACK and place(rows[-1]) == last and len(last[1]) == PREFIX:
            crowded[i] = last
            kept = [r for r in kept if place(r) < last]
        exact[i] = [(bytes(r["prefix"]).decode(), r["cnt"]) for r in kept if len(r["prefix"]) < PREFIX]
        wanted[i] = {(r["h1"], r["h2"]): r["cnt"] for r in kept if len(r["prefix"]) == PREFIX}
    looked_up = {i: w for i, w in wanted.items() if w}
    if looked_up:
        entries, shown = [], []
        for i, w in looked_up.items():
            v = F.col(f"`{df.columns[i]}`").cast("string")
            h1, h2 = _text_hashes(v)
            shown.append(h1.isin([h for h, _ in w]))
            entries.append(F.when(shown[-1], F.struct(F.lit(i).alias("ordinal"), h1.alias("h1"), h2.alias("h2"), v.alias("v"))))
        found = df.where(reduce(or_, shown))  # rows without any of them need no array
        rows = found.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*").distinct().collect()
        for r in rows:
            cnt = looked_up[r["ordinal"]].get((r["h1"], r["h2"]))
            if cnt is not None:
                exact[r["ordinal"]].append((r["v"], cnt))
    for i, last in crowded.items():
        exact[i] += [(r["v"], -last[0]) for r in _crowded_place(df, i, last, k - len(exact[i])).collect()]
    return {i: sorted(v, key=lambda x: (-x[1], x[0].encode()))[:k] for i, v in exact.items()}


def _crowded_place(df: DataFrame, i: int, last: tuple, need: int) -> DataFrame:
    """The ``need`` smallest values of column ``i`` with the count and prefix of ``last``.

    Values that occur once need no count: any text with the prefix that is not repeated is one. A
    repeated value shares its task with its copies (hash shuffle of the texts with that prefix only).
    """
    v = F.col(f"`{df.columns[i]}`").cast("string")
    texts = df.select(v.alias("v")).where(F.substring(F.col("v").cast("binary"), 1, PREFIX) == F.lit(bytearray(last[1])))
    tied = texts.groupBy("v").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") == -last[0]).withColumn("g", F.lit(0))
    return top_k_per_group(tied, ["g"], [F.col("v").asc()], need, F.xxhash64("v")).select("v")


def top_values_long(df: DataFrame, k: int = 3, cols: list[str] | None = None) -> DataFrame:
    """The k most frequent values of each non-numeric column, ties by value ascending.

    Output ``(ordinal, column_name, rank, value, cnt)``, k rows per column, computed when called.
    """
    cols = cols or [f.name for f in df.schema.fields if not is_numeric(f.dataType)]
    leading = {r["ordinal"]: r["l"] for r in leading_hashes(hashed_counts(df, cols), k).collect()} if cols else {}
    rows = [(i, df.columns[i], rank, v, cnt) for i, top in sorted(top_values(df, leading, k).items()) for rank, (v, cnt) in enumerate(top, 1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, rank int, value string, cnt bigint")


def _names_frame(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "ordinal int, column_name string, dtype string")


def moments(df: DataFrame, probe: TextProbe | None = None) -> DataFrame:
    """Per-column counts, moments and fingerprint, one row per column.

    The table is unpivoted to ``(ordinal, value as double, value hash)`` and grouped by
    ordinal: a handful of aggregate functions whatever the width (so the aggregate stays
    in generated code), partial aggregation leaves one row per column per task, and the
    final shuffle moves only those rows. With a ``probe`` the same pass also takes the text
    statistics of its columns, as a struct ``texts``.
    """
    entries = []
    for i, f in enumerate(df.schema.fields):
        c = nan_to_null(F.col(f"`{f.name}`"), f.dataType)
        v = c.cast("double") if is_numeric(f.dataType) else F.lit(None).cast("double")
        own = [F.lit(i).alias("ordinal"), v.alias("v"), c.isNotNull().alias("nn"), F.xxhash64(c).alias("h")]
        if probe:
            x = F.lit(None).cast("string")
            if f.name in probe.columns:
                x = c if probe.rows is None else F.when(probe.rows, c)
            own += [x.alias("x"), F.lit(f.name in probe.date_columns).alias("hinted")]
        entries.append(F.struct(*own))
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    h = F.when(F.col("nn"), F.col("h"))
    texts = [F.struct(*stat_aggregates(F.col("x"), F.col("hinted"), probe.keep_sign)).alias("texts")] if probe else []
    return long.groupBy("ordinal").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("nn").alias("n_nonnull"),
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"),
        F.max("v").alias("max"), g1_skew(F.col("v")).alias("skew"),
        F.concat_ws(":", F.bit_xor(h).cast("string"),
                    F.try_sum(F.pmod(h, F.lit(1_000_003))).cast("string")).alias("fingerprint"), *texts)


def counted(df: DataFrame, k: int = 3, probe: TextProbe | None = None) -> DataFrame:
    """Moments, distinct counts and leading hashes, one row per column, in one job."""
    counts = hashed_counts(df)
    # the non-null count is taken from the value counts too: both branches then read the
    # same (ordinal, hashes, cnt) aggregate and Spark reuses its shuffle
    distinct = counts.groupBy("ordinal").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("cnt").alias("n_counted"))
    return (moments(df, probe).join(F.broadcast(_names_frame(df)), "ordinal")
            .join(F.broadcast(distinct), "ordinal", "left")
            .join(F.broadcast(leading_hashes(counts, k)), "ordinal", "left"))


def profile(df: DataFrame, k: int = 3, digits: int | None = 2) -> DataFrame:
    """One row per column.

    ``ordinal, column_name, dtype, n_rows, null_pct, n_distinct, skew, mean, std, min, max,
    top_values, flags, fingerprint``. Numbers are rounded to ``digits`` (None keeps them raw).
    One job, and a look-up pass if a value to show is longer than ``PREFIX`` bytes.
    """
    return _profile(df, k, digits)[0]


def profile_with_texts(df: DataFrame, probe: TextProbe, k: int = 3, digits: int | None = 2) -> tuple[DataFrame, list[Row]]:
    """``profile`` and the ``text_stats`` rows of the probe's columns, from the same passes."""
    return _profile(df, k, digits, probe)


def _profile(df: DataFrame, k: int, digits: int | None, probe: TextProbe | None = None) -> tuple[DataFrame, list[Row]]:
    numbered = counted(df, k, probe)
    rows = numbered.collect()
    texts = [Row(column_name=r["column_name"], **r["texts"].asDict()) for r in rows if probe and r["column_name"] in probe.columns]
    text_ords = [i for i, f in enumerate(df.schema.fields) if not is_numeric(f.dataType)]
    tops = top_values(df, {r["ordinal"]: r["l"] for r in rows if r["ordinal"] in text_ords and r["l"]}, k)
    shown = {i: "{" + ", ".join(f"'{v}': {n}" for v, n in top) + "}" for i, top in tops.items()}
    kept = [c for c in numbered.columns if c not in ("l", "texts")]
    # one row per column: the rest is arithmetic on a local table
    out = df.sparkSession.createDataFrame([(*(r[c] for c in kept), shown.get(r["ordinal"])) for r in rows],
                                          numbered.select(*kept).schema.add("top_values", "string"))
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    n_rows = F.col("n_rows")
    nonnull = F.coalesce(F.col("n_counted"), F.lit(0))
    null_pct = F.round(F.lit(100.0) * (n_rows - nonnull) / n_rows, 2)
    nd = F.coalesce(F.col("n_distinct"), F.lit(0)).cast("bigint")
    flags = F.concat_ws(", ", F.when((nd == n_rows) & (nd > 1), F.lit("POTENTIAL ID")),
                        F.when(nd <= fixed.CONSTANT_MAX_DISTINCT, F.lit("CONSTANT")),
                        F.when(null_pct > fixed.HIGH_NULL_PCT, F.lit("HIGH NULL")))
    out = out.select(
        F.col("ordinal").cast("int").alias("ordinal"), "column_name", "dtype",
        n_rows.cast("bigint").alias("n_rows"), null_pct.alias("null_pct"),
        nd.alias("n_distinct"), rnd(F.col("skew")).alias("skew"),
        rnd(F.col("mean")).alias("mean"), rnd(F.col("std")).alias("std"),
        rnd(F.col("min")).alias("min"), rnd(F.col("max")).alias("max"),
        "top_values", flags.alias("flags"), "fingerprint")
    return out, texts


@dataclass(frozen=True)
class ColumnProfile:
    ordinal: int
    name: str
    dtype: str
    n_rows: int
    null_pct: float | None
    n_distinct: int
    skew: float | None
    mean: float | None
    std: float | None
    min: float | None
    max: float | None
    top_values: str | None
    flags: str
    fingerprint: str | None

    @property
    def numeric(self) -> bool:
        return self.dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") \
            or self.dtype.startswith("decimal")


def collect_profile(df: DataFrame, digits: int | None = None) -> list[ColumnProfile]:
    """The profile as driver objects: bounded by the number of columns."""
    rows = profile(df, digits=digits).orderBy("ordinal").collect()
    return [ColumnProfile(r.ordinal, r.column_name, r.dtype, r.n_rows, r.null_pct, r.n_distinct,
                          r.skew, r.mean, r.std, r.min, r.max, r.top_values, r.flags,
                          r.fingerprint) for r in rows]


def shape(df: DataFrame) -> DataFrame:
    """Rows x columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("int").alias("n_cols"))


def column_types(df: DataFrame) -> DataFrame:
    """One row per column with Spark's type name."""
    return _names_frame(df)


def column_summary(df: DataFrame) -> DataFrame:
    """Name, type and distinct count."""
    names = _names_frame(df)
    distinct = hashed_counts(df).groupBy("ordinal").agg(F.count(F.lit(1)).alias("n_distinct"))
    return (names.join(F.broadcast(distinct), "ordinal", "left")
                 .select("ordinal", "column_name", "dtype",
                         F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct")))


def audit_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """P10: shape, null percent and distinct count before and after cleaning, by column name."""
    cols = ["column_name", "dtype", "n_rows", "null_pct", "n_distinct"]
    b = profile(before).select(*[F.col(c).alias(f"{c}_before") if c != "column_name" else c
                                 for c in cols])
    a = profile(after).select(*[F.col(c).alias(f"{c}_after") if c != "column_name" else c
                                for c in cols])
    return b.join(a, "column_name", "full")


def target_stats(df: DataFrame, target: str, digits: int = 4) -> DataFrame:
    """Count, mean, std, min, max of the target after target handling."""
    t = F.col(f"`{target}`").cast("double")
    return df.agg(F.lit(target).alias("target"), F.count(t).alias("n"),
                  F.round(F.avg(t), digits).alias("mean"),
                  F.round(F.stddev_samp(t), digits).alias("std"),
                  F.round(F.min(t), digits).alias("min"), F.round(F.max(t), digits).alias("max"))
