"""Column pruning decisions: IDs, mostly-empty columns, constants, exact duplicates.

Each ``find_*`` reads the per-column profile (one row per column) and returns
``(column_name, reason)`` rows; ``plan_drops`` unions them and removes protected
columns. The duplicate finder pairs candidates by an order-free fingerprint from the
profile pass and confirms them with one exact null-safe comparison pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith import fixed
from tabsmith.operators.profile import profile as build_profile



def has_id_hint(name_col):
    low = F.lower(name_col)
    cond = F.lit(False)
    for h in fixed.ID_NAME_HINTS:
        cond = cond | F.instr(low, h).__gt__(0)
    return cond


def find_ids(profile: DataFrame, protect_text: bool = False) -> DataFrame:
    """Every value distinct and an ID-like name; ``protect_text`` exempts text columns."""
    cond = (F.col("n_distinct") == F.col("n_rows")) & has_id_hint(F.col("column_name"))
    if protect_text:
        cond = cond & (F.col("dtype") != "string")
    return profile.filter(cond).select("column_name", F.lit("id").alias("reason"))


def find_high_null(profile: DataFrame, limit: float = fixed.HIGH_NULL_PCT) -> DataFrame:
    """Rounded null percent above the limit."""
    return profile.filter(F.col("null_pct") > limit).select(
        "column_name", F.lit("high_null").alias("reason"))


def find_constants(profile: DataFrame) -> DataFrame:
    """D3: at most one distinct non-null value."""
    return profile.filter(F.col("n_distinct") <= fixed.CONSTANT_MAX_DISTINCT).select(
        "column_name", F.lit("constant").alias("reason"))


def collected_profile(df: DataFrame) -> DataFrame:
    """The profile computed once and held as a small local frame (one row per column), so
    the several rules that read it do not each recompute it."""
    prof = build_profile(df, digits=None)
    return df.sparkSession.createDataFrame(prof.collect(), prof.schema)


def find_duplicate_columns(df: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """``(column_name, duplicate_of)`` for each column equal, row by row and null for
    null, to an earlier column of the same type; the earliest copy is kept.

    Candidates must agree on type, null count, distinct count and the summed value hash. Equality is
    transitive, so each is compared with the first of its group only; those that differ from it
    form a group of their own in a next pass (only after a hash collision).
    """
    spark = df.sparkSession
    profile = profile if profile is not None else build_profile(df, digits=None)
    rows = profile.select("ordinal", "column_name", "dtype", "null_pct", "n_distinct",
                          "fingerprint").orderBy("ordinal").collect()
    by_sign: dict[tuple, list[str]] = {}
    for r in rows:
        by_sign.setdefault((r.dtype, r.null_pct, r.n_distinct, r.fingerprint), []).append(r.column_name)
    groups = [g for g in by_sign.values() if len(g) > 1]
    found: list[tuple[str, str]] = []
    while groups:
        pairs = [(g[0], c) for g in groups for c in g[1:]]
        same = df.agg(F.array(*[F.coalesce(F.bool_and(F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))), F.lit(True)) for a, b in pairs])).first()[0]
        found += [(b, a) for (a, b), eq in zip(pairs, same, strict=True) if eq]
        differ = {b for (_, b), eq in zip(pairs, same, strict=True) if not eq}
        groups = [g for g in ([c for c in g if c in differ] for g in groups) if len(g) > 1]
    return spark.createDataFrame(found, "column_name string, duplicate_of string")


def plan_drops(df: DataFrame, targets: Sequence[str] = (), profile: DataFrame | None = None,
               protect_text: bool = False) -> DataFrame:
    """D5 + D6: ``(column_name, reasons)``, reasons sorted and comma-joined; targets are kept."""
    profile = profile if profile is not None else collected_profile(df)
    dup = find_duplicate_columns(df, profile).select(
        "column_name", F.lit("duplicate").alias("reason"))
    allr = (find_ids(profile, protect_text).unionByName(find_high_null(profile))
            .unionByName(find_constants(profile)).unionByName(dup))
    if targets:
        allr = allr.filter(~F.col("column_name").isin(list(targets)))
    return (allr.groupBy("column_name")
                .agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons")))
