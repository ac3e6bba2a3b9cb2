"""Text cleaning decisions (formatted numbers, long text, boolean words) and their apply.

All three decisions for all string columns come from one aggregate pass; applying them
is one ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith import fixed
from tabsmith.functions import text as tx
from tabsmith.functions.dates import parse_datetime


@dataclass(frozen=True)
class TextPlan:
    formatted: tuple[str, ...] = ()           # parse to double
    truncated: tuple[str, ...] = ()           # keep the first words
    boolean: tuple[str, ...] = ()             # yes/no words to 1/0
    keep_words: int = fixed.LONG_TEXT_KEEP_WORDS
    keep_sign: bool = False
    stats: dict = field(default_factory=dict, compare=False)


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def text_stats(df: DataFrame, cols: Sequence[str], keep_sign: bool = False,
               date_cols: Sequence[str] = ()) -> DataFrame:
    """``(column_name, n_nonnull, n_match, n_fail, mean_words, n_boolean, n_parsed)`` in one
    pass: the string columns are unpivoted and grouped by column, so the aggregate keeps a
    few functions however many columns there are. ``n_parsed`` (date parse count) is taken
    only for ``date_cols``."""
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame(
            [], "column_name string, n_nonnull bigint, n_match bigint, n_fail bigint, "
                "mean_words double, n_boolean bigint, n_parsed bigint")
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("x"),
                        F.lit(c in date_cols).alias("hinted")) for c in cols]
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return long.groupBy("column_name").agg(*stat_aggregates(F.col("x"), F.col("hinted"), keep_sign))


def stat_aggregates(x: Column, hinted: Column, keep_sign: bool = False) -> list[Column]:
    """The aggregates of ``text_stats`` over a text ``x`` (null for what is not counted)."""
    nn = x.isNotNull()
    match = tx.looks_formatted(x, keep_sign)
    # an unsigned value of the formatted shape always parses, so only the others are parsed
    fail = tx.parse_formatted(x, keep_sign).isNull()
    fail = fail if keep_sign else (~match & fail)
    return [F.count(x).alias("n_nonnull"),
            F.count_if(nn & match).alias("n_match"),
            F.count_if(nn & fail).alias("n_fail"),
            F.avg(tx.word_count(x)).alias("mean_words"),
            F.count_if(tx.is_boolean_word(x)).alias("n_boolean"),
            F.count(F.when(hinted, parse_datetime(x))).alias("n_parsed")]


@dataclass(frozen=True)
class TextProbe:
    """What a profile pass counts beside its own figures: text statistics of ``columns`` in the rows ``rows``."""

    columns: tuple[str, ...]
    date_columns: tuple[str, ...] = ()
    rows: Column | None = None
    keep_sign: bool = False


def decide(stats_rows, keep_sign: bool = False) -> TextPlan:
    """X2 / X3 / X4 decisions from the stats rows (one per string column)."""
    fmt, trunc, boo, stats = [], [], [], {}
    for r in stats_rows:
        stats[r.column_name] = r.asDict()
        nn = r.n_nonnull
        if nn == 0:
            continue
        if nn and r.n_boolean == nn:
            boo.append(r.column_name)
        elif (r.n_match / nn >= fixed.FORMATTED_MATCH_SHARE
              and r.n_fail / nn <= fixed.FORMATTED_FAIL_SHARE):
            fmt.append(r.column_name)
        elif r.mean_words is not None and r.mean_words > fixed.LONG_TEXT_MEAN_WORDS:
            trunc.append(r.column_name)
    return TextPlan(tuple(fmt), tuple(trunc), tuple(boo), keep_sign=keep_sign, stats=stats)


def fit_text(df: DataFrame, exclude: Sequence[str] = (), keep_sign: bool = False,
             date_cols: Sequence[str] = ()) -> TextPlan:
    """X2-X4 decisions; ``stats`` also carries date parse counts for ``date_cols``."""
    cols = string_columns(df, exclude)
    if not cols:
        return TextPlan()
    return decide(text_stats(df, cols, keep_sign, date_cols).collect(), keep_sign)


def apply_text(df: DataFrame, plan: TextPlan) -> DataFrame:
    """One projection: parse, truncate and map boolean words in place."""
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c in plan.formatted:
            x = tx.parse_formatted(x, plan.keep_sign)
        elif c in plan.truncated:
            x = tx.first_words(x, plan.keep_words)
        elif c in plan.boolean:
            x = tx.boolean_word_code(x)
        out.append(x.alias(c))
    return df.select(*out)


def fit_formatted(df: DataFrame, cols: Sequence[str], keep_sign: bool = False) -> DataFrame:
    """X2 as a table: ``(column_name, n_nonnull, n_match, n_fail, converted)``."""
    s = text_stats(df, cols, keep_sign)
    nn = F.col("n_nonnull")
    ok = ((F.col("n_match") / nn >= fixed.FORMATTED_MATCH_SHARE)
          & (F.col("n_fail") / nn <= fixed.FORMATTED_FAIL_SHARE) & (nn > 0))
    return s.select("column_name", "n_nonnull", "n_match", "n_fail", ok.alias("converted"))


def truncate_words(df: DataFrame, cols: Sequence[str],
                   above: float = fixed.LONG_TEXT_MEAN_WORDS,
                   keep: int = fixed.LONG_TEXT_KEEP_WORDS) -> DataFrame:
    """Columns whose mean word count is above ``above`` keep their first ``keep`` words."""
    means = df.agg(*[F.avg(tx.word_count(F.col(f"`{c}`"))).alias(c) for c in cols]).first()
    long_cols = {c for c in cols if means[c] is not None and means[c] > above}
    return df.select(*[tx.first_words(F.col(f"`{c}`"), keep).alias(c) if c in long_cols
                       else F.col(f"`{c}`") for c in df.columns])


def map_boolean_words(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A column whose every non-null value is a yes/no word becomes 1/0."""
    row = df.agg(*[F.bool_and(F.coalesce(tx.is_boolean_word(F.col(f"`{c}`")), F.lit(True)))
                   .alias(c) for c in cols]).first()
    conv = {c for c in cols if row[c]}
    return df.select(*[tx.boolean_word_code(F.col(f"`{c}`")).alias(c) if c in conv
                       else F.col(f"`{c}`") for c in df.columns])
