"""Date columns: detection, parsing, parts, and dropping rows that did not parse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith import fixed
from tabsmith.functions.dates import parse_datetime, weekday_monday0

DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
PARTS = ("year", "month", "day", "dayofweek")


def _hinted(name: str) -> bool:
    low = name.lower()
    return any(h in low for h in fixed.DATE_NAME_HINTS)


def date_candidates(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(typed date columns, hinted string columns to test)."""
    typed, hinted = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, DATE_TYPES):
            typed.append(f.name)
        elif isinstance(f.dataType, T.StringType) and _hinted(f.name):
            hinted.append(f.name)
    return typed, hinted


def parse_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, n_nonnull, n_parsed)`` for hinted string columns, one pass."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_nonnull bigint, n_parsed bigint")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"), F.count(parse_datetime(x)).alias(f"p{i}")]
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_nonnull"),
                        F.col(f"p{i}").alias("n_parsed")) for i, c in enumerate(cols)]
    return df.agg(*aggs).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def find_dates(df: DataFrame, exclude: Sequence[str] = (),
               min_share: float = fixed.DATE_MIN_PARSED_SHARE) -> list[str]:
    """Typed dates always; hinted text when at least ``min_share`` of values parse.

    Numeric columns (a numeric ``year``) are never dates.
    """
    typed, hinted = date_candidates(df, exclude)
    found = set(typed)
    for r in parse_share(df, hinted).collect():
        if r.n_nonnull and r.n_parsed / r.n_nonnull >= min_share:
            found.add(r.column_name)
    return [c for c in df.columns if c in found]


def all_parsed(cols: Sequence[str]) -> Column:
    """Over the output of ``date_parts``: every date of the row parsed."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"`{c}_year`").isNotNull()
    return cond


def date_parts(df: DataFrame, cols: Sequence[str], drop_unparsed: bool = True) -> DataFrame:
    """Parse, add ``<col>_year/_month/_day/_dayofweek`` (Monday = 0) in place of
    the original, and drop rows whose date is missing or did not parse."""
    if not cols:
        return df
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(f"`{c}`"))
            continue
        x = F.col(f"`{c}`")
        ts = x if isinstance(fields[c], DATE_TYPES) else parse_datetime(x)
        out += [F.year(ts).alias(f"{c}_year"), F.month(ts).alias(f"{c}_month"),
                F.dayofmonth(ts).alias(f"{c}_day"), weekday_monday0(ts).alias(f"{c}_dayofweek")]
    res = df.select(*out)
    return res.filter(all_parsed(cols)) if drop_unparsed else res
