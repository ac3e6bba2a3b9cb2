"""Row samples for display: a seeded sample from a leading window, and head rows as text.

Both are limits by design (a sampling operator and a head); ``orderBy(...).limit(n)``
plans as a distributed top-n, never a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith import fixed
from tabsmith.operators.split import key_column


def window_sample(df: DataFrame, order_by: str | Sequence[str], sample_size: int = fixed.SAMPLE_SIZE,
                  window_size: int = fixed.SAMPLE_WINDOW, seed: int = fixed.SEED) -> DataFrame:
    """The first ``window_size`` rows by ``order_by``, then ``min(sample_size, n)`` of
    them chosen by a seeded hash order."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    window = df.orderBy(*keys).limit(window_size)
    h = F.md5(F.concat(F.lit(f"{seed}|"), key_column(keys)))
    return window.orderBy(h).limit(sample_size)


def head_rows(df: DataFrame, n: int, order_by: str | Sequence[str], sep: str = ",") -> DataFrame:
    """A header line and the first ``n`` rows, fields joined by ``sep``:
    ``(line_no, line)`` with the header as line 0."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    head = df.sparkSession.createDataFrame([(0, sep.join(df.columns))], "line_no int, line string")
    first = df.orderBy(*keys).limit(n)
    from pyspark.sql import Window
    w = Window.orderBy(*keys)                 # over the n rows of the limit only
    rows = first.select(F.row_number().over(w).alias("line_no"),
                        F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
                                           for c in df.columns]).alias("line"))
    return head.unionByName(rows)
