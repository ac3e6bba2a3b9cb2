"""Bounded top-k per group that stays safe when one group holds most rows.

A plain ``row_number() over (partition by g order by ...)`` sends a whole group to
one task. Here each group is first cut into ``salts`` sub-groups by a hash, the top
k of every sub-group is kept, and only those (at most ``salts * k`` rows per group)
meet in the final window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.session import shuffle_partitions


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                    k: int, salt_of: Column, salts: int | None = None,
                    rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k inside each group by ``order`` (a total order), rank in ``rank_col``."""
    salts = salts or shuffle_partitions(df.sparkSession)
    salt = "__salt"
    inner = Window.partitionBy(*group_cols, salt).orderBy(*order)
    outer = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.withColumn(salt, F.pmod(salt_of, F.lit(salts)))
              .withColumn(rank_col, F.row_number().over(inner))
              .filter(F.col(rank_col) <= k)
              .drop(salt)
              .withColumn(rank_col, F.row_number().over(outer))
              .filter(F.col(rank_col) <= k))
