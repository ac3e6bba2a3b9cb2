"""Exact, repeatable train/test split and feature lists.

Rows are ordered by ``md5('<seed>|<key>')``; the test set is the ceil(share * n) rows
with the smallest hashes. The cut hash is found by counting hash prefixes (65,536
buckets per level, collected as counts only) and refining inside the one bucket that
holds the cut, so no global sort and no single-task window over the table. The result
depends only on the key and the seed: repartitioning or re-running gives the same split.

A key may repeat. Rows below the cut hash are test rows; of the rows on it only as many as are
missing, by a second rank: a hash of the whole row, cut in the same way. Rows that are equal in every
column too are taken by count (which of them does not show).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith import fixed

PREFIX_HEX = 4          # 16 bits of hash per refinement level
SMALL = 1_000_000       # a bucket this small is ranked directly


def key_column(key: str | Sequence[str]) -> Column:
    cols = [key] if isinstance(key, str) else list(key)
    return F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in cols])


def split_hash(key: str | Sequence[str], seed: int = fixed.SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key_column(key)))


def _prefix_counts(scope: DataFrame, start: int) -> list[tuple[str, int]]:
    b = F.substring("h", start, PREFIX_HEX)
    return sorted((r["b"], r["n"]) for r in
                  scope.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())


def _cut(hashed: DataFrame, k: int, small: int = SMALL, first: list | None = None) -> str:
    """The k-th smallest value (1-based) of column ``h``; ``first`` reuses the level-one
    prefix counts when the caller already has them."""
    prefix, rank = "", k
    scope = hashed
    while True:
        counts = first if (first is not None and not prefix) else _prefix_counts(scope, len(prefix) + 1)
        before = 0
        for bucket, n in counts:
            if before + n >= rank:
                break
            before += n
        prefix += bucket
        rank -= before
        scope = hashed.filter(F.col("h").startswith(prefix))
        if len(prefix) >= 32:
            return prefix
        if n <= small:
            w = Window.partitionBy(F.substring("h", 1, len(prefix))).orderBy("h")
            return (scope.withColumn("rn", F.row_number().over(w))
                    .filter(F.col("rn") == rank).select("h").first()["h"])


def exact_flags(df: DataFrame, key, test_share: float, seed: int) -> tuple[DataFrame, int]:
    """``(df with is_test, n)``. The row count is the sum of the first prefix counts, so
    counting and cutting share a pass."""
    h = split_hash(key, seed)
    hashed = df.select(h.alias("h"))
    first = _prefix_counts(hashed, 1)
    n = sum(c for _, c in first)
    if n < fixed.TINY_TABLE_ROWS:
        return df.withColumn("is_test", F.lit(True)), n
    k = math.ceil(test_share * n)
    cut_h = _cut(hashed, k, first=first)
    below = hashed.agg(F.count_if(F.col("h") < F.lit(cut_h)).alias("less"), F.count_if(F.col("h") == F.lit(cut_h)).alias("on")).first()
    if below["less"] + below["on"] == k:
        return df.withColumn("is_test", h <= F.lit(cut_h)), n
    return _cut_inside(df, h, cut_h, k - below["less"]), n


def _row_hash(df: DataFrame, seed: int = 1) -> Column:
    """A hash of all columns; a null differs from every value, and two columns do not run together."""
    parts = [F.coalesce(F.concat(F.lit("+"), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in df.columns]
    return F.md5(F.to_json(F.array(F.lit(str(seed)), *parts)))


def _cut_inside(df: DataFrame, h: Column, cut_h: str, need: int) -> DataFrame:
    """``is_test`` where the cut falls among the rows of one key hash: ``need`` of them are test rows."""
    row = _row_hash(df)
    tied = df.where(h == F.lit(cut_h)).select(row.alias("h"))
    cut_row = _cut(tied, need)
    less = tied.filter(F.col("h") < F.lit(cut_row)).count()
    on = (h == F.lit(cut_h)) & (row == F.lit(cut_row))
    sure = (h < F.lit(cut_h)) | ((h == F.lit(cut_h)) & (row < F.lit(cut_row)))
    equal = tied.filter(F.col("h") == F.lit(cut_row)).count()
    if less + equal == need:
        return df.withColumn("is_test", sure | on)
    # equal rows: one of them stands for all, made again as often as each side takes, in many tasks
    one = df.where(on).limit(1).withColumn("__g", F.lit(0))
    copies = df.sparkSession.range(equal).select(F.lit(0).alias("__g"), (F.col("id") < need - less).alias("is_test"))
    copies = copies.join(F.broadcast(one), "__g").select(*[F.col(f"`{c}`") for c in df.columns], "is_test")
    return df.where(~on).withColumn("is_test", sure).unionByName(copies)


def split_flags(df: DataFrame, key: str | Sequence[str], test_share: float = fixed.TEST_SHARE,
                seed: int = fixed.SEED, mode: str = "exact") -> DataFrame:
    """``df`` plus ``is_test``. ``mode='exact'``: exactly ceil(share*n) test rows, also if
    the key repeats; below five rows every row is a test row. ``mode='bernoulli'``: each row
    independently by hash, no extra pass."""
    if mode == "bernoulli":
        cut = F.pmod(F.xxhash64(key_column(key), F.lit(seed)), F.lit(10_000)) < round(test_share * 10_000)
        return df.withColumn("is_test", cut)
    return exact_flags(df, key, test_share, seed)[0]


def split(df: DataFrame, key: str | Sequence[str], test_share: float = fixed.TEST_SHARE,
          seed: int = fixed.SEED, mode: str = "exact") -> tuple[DataFrame, DataFrame]:
    """F1 + F2: (train, test). Below five rows both are the whole table."""
    if mode == "exact":
        flagged, n = exact_flags(df, key, test_share, seed)
        if n < fixed.TINY_TABLE_ROWS:
            return df, df
    else:
        flagged = split_flags(df, key, test_share, seed, mode)
    return (flagged.filter(~F.col("is_test")).drop("is_test"),
            flagged.filter(F.col("is_test")).drop("is_test"))


def features(df: DataFrame, targets: Sequence[str]) -> list[str]:
    """every column but the targets."""
    return [c for c in df.columns if c not in set(targets)]


def display_columns(columns: Sequence[str], targets: Sequence[str],
                    preferred: Sequence[str] = fixed.PREFERRED_DISPLAY_COLUMNS,
                    fallback: int = fixed.DISPLAY_FALLBACK_COUNT) -> list[str]:
    """the preferred columns present among the features, else the first three features."""
    feats = [c for c in columns if c not in set(targets)]
    shown = [c for c in preferred if c in feats]
    return shown or feats[:fallback]
