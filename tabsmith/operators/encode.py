"""Category encoding: one-hot for few levels, sorted label codes for many, decoding.

Label codes equal each label's rank in sorted order without sorting on one task:
the distinct ``(column, label)`` pairs are range-partitioned, sorted inside each
partition and checkpointed (so every later read sees the same partitions); the
per-partition counts (partitions x columns rows) give each partition its offset,
and a label's code is its position in the partition plus that offset.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith import fixed
from tabsmith.operators.profile import value_counts
from tabsmith.operators.topk import top_k_per_group
from tabsmith.session import ensure_checkpoint_dir, shuffle_partitions

BROADCAST_MAX_BYTES = 64 << 20      # mappings of one table are broadcast while their counted bytes stay under this
UNSEEN_CODE = -1                   # code of a label the mapping does not hold (decodes to 'Unknown')


class LabelCounts(dict):
    """``{column: number of labels}`` with the exact size of each mapping in ``nbytes``."""

    def __init__(self, counts=(), nbytes: dict | None = None):
        super().__init__(counts)
        self.nbytes = dict(nbytes or {})


def _small(cols: Sequence[str], counts: dict | None) -> set[str]:
    """Columns whose mappings may be broadcast: sizes known, and under the limit all together."""
    sizes = getattr(counts, "nbytes", {})
    out, used = set(), 0
    for c in sorted({c for c in cols if c in sizes}, key=sizes.get):
        used += sizes[c]
        if used <= BROADCAST_MAX_BYTES:
            out.add(c)
    return out


@dataclass(frozen=True)
class EncodePlan:
    one_hot: dict = field(default_factory=dict)     # column -> tuple of levels (ascending)
    label: tuple = ()                               # label-encoded columns
    boolean: tuple = ()                             # boolean columns cast to int
    mappings: DataFrame | None = field(default=None, compare=False)  # (column_name, label, code)
    label_counts: dict = field(default_factory=dict, compare=False)


def text_features(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def fit_levels(df: DataFrame, cols: Sequence[str], max_levels: int = fixed.CLASS_MAX_DISTINCT):
    """``{column: levels}`` for columns with at most ``max_levels`` values; others map to None.

    Only ``max_levels + 1`` values per column are ever kept (salted top-k), so a column
    with a billion labels costs no more on the driver than one with sixteen.
    """
    if not cols:
        return {}
    vc = value_counts(df, list(cols)).filter(F.col("v_str").isNotNull())
    probe = top_k_per_group(vc, ["ordinal"], [F.col("v_str").asc()], max_levels + 1,
                            F.xxhash64("v_str"))
    got: dict[int, list] = {}
    for r in probe.select("ordinal", "v_str").collect():
        got.setdefault(r["ordinal"], []).append(r["v_str"])
    out = {}
    for c in cols:
        vals = sorted(got.get(df.columns.index(c), []))
        out[c] = tuple(vals) if len(vals) <= max_levels else None
    return out


def dummy_names(columns: Sequence[str], levels: dict[str, Sequence[str]]) -> list[tuple[str, str, str]]:
    """``(column, level, name)`` of the dummy columns: ``<col>_<value>`` with dots and backticks as
    underscores, and a number after a name that is taken (case ignored)."""
    taken = {c.lower() for c in columns if c not in levels}
    out = []
    for c in columns:
        for v in levels.get(c, ()):
            base = f"{c}_{v}".replace(".", "_").replace("`", "_")
            name, n = base, 1
            while name.lower() in taken:
                n += 1
                name = f"{base}_{n}"
            taken.add(name.lower())
            out.append((c, v, name))
    return out


def one_hot(df: DataFrame, levels: dict[str, Sequence[str]]) -> DataFrame:
    """0/1 ints for every level, named by ``dummy_names``; the source column is removed.

    Dummy columns follow the other columns, grouped by source column, levels ascending.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in levels]
    dummies = [F.col(f"`{c}`").eqNullSafe(F.lit(v)).cast("int").alias(name) for c, v, name in dummy_names(df.columns, levels)]
    return df.select(*keep, *dummies)


LABELS_PER_PARTITION = 200_000


def label_codes(df: DataFrame, cols: Sequence[str], partitions: int | None = None,
                expected: int | None = None) -> DataFrame:
    """E2 + E4: mapping ``(column_name, label, code)`` with codes 0.. in sorted label order."""
    return label_codes_counted(df, cols, partitions, expected)[0]


def label_codes_counted(df: DataFrame, cols: Sequence[str], partitions: int | None = None,
                        expected: int | None = None):
    """``(mapping, {column: number of labels})``; the counts come from the offset pass.

    Range partitions: ``partitions`` if given; else sized from ``expected`` (an upper
    bound on the number of labels, e.g. profile distinct counts) at about 200k labels
    each; else left to AQE, which coalesces adjacent ranges of a small label set.
    """
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column_name string, label string, code long"), LabelCounts()
    ensure_checkpoint_dir(spark)
    if partitions is None and expected is not None:
        partitions = max(1, min(shuffle_partitions(spark), -(-expected // LABELS_PER_PARTITION)))
    pairs = (value_counts(df, list(cols)).filter(F.col("v_str").isNotNull())
             .select("ordinal", F.col("v_str").alias("label")))
    ranged = (pairs.repartitionByRange(partitions, "ordinal", "label") if partitions
              else pairs.repartitionByRange("ordinal", "label"))
    ranged = ranged.sortWithinPartitions("ordinal", "label").checkpoint(eager=True)
    pos = ranged.select("ordinal", "label", F.spark_partition_id().alias("pid"),
                        F.monotonically_increasing_id().alias("mid"))
    found = pos.groupBy("ordinal", "pid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("label") + 16).alias("b")).collect()
    counts = sorted((r["ordinal"], r["pid"], r["n"]) for r in found)
    # inside a partition rows are sorted by (ordinal, label): an ordinal's rows start
    # after the rows of the smaller ordinals held by the same partition
    start, seen = {}, {}
    for o, pid, n in sorted(counts, key=lambda t: (t[1], t[0])):
        start[(o, pid)] = seen.get(pid, 0)
        seen[pid] = seen.get(pid, 0) + n
    base_rows, totals = [], {}
    for o, pid, n in counts:                      # sorted by ordinal, then partition
        run = totals.get(o, 0)
        base_rows.append((o, pid, run - start[(o, pid)] - (pid << 33)))
        totals[o] = run + n
    base = spark.createDataFrame(base_rows, "ordinal int, pid int, base long")
    names = spark.createDataFrame([(df.columns.index(c), c) for c in cols], "ordinal int, column_name string")
    mapping = (pos.join(F.broadcast(base), ["ordinal", "pid"])
                  .join(F.broadcast(names), "ordinal")
                  .select("column_name", "label", (F.col("mid") + F.col("base")).alias("code")))
    size = {c: sum(r["b"] for r in found if r["ordinal"] == df.columns.index(c)) for c in cols}
    return mapping, LabelCounts({c: totals.get(df.columns.index(c), 0) for c in cols}, size)


def apply_labels(df: DataFrame, mappings: DataFrame, cols: Sequence[str],
                 counts: dict[str, int] | None = None) -> DataFrame:
    """Replace each label column by its code (left join). A label absent from the mapping
    (a table the recipe was not fitted on) gets ``UNSEEN_CODE``; a null stays null.

    Mappings are broadcast only while their exact bytes are known and small all together;
    otherwise each it is a shuffle join, where AQE splits a hot label's partition.
    """
    out = df
    small = _small(cols, counts)
    for c in cols:
        m = (mappings.filter(F.col("column_name") == c)
             .select(F.col("label").alias("__label"), F.col("code").alias("__code")))
        if c in small:
            m = F.broadcast(m)
        code = F.when(F.col(f"`{c}`").isNotNull(), F.coalesce(F.col("__code"), F.lit(UNSEEN_CODE)))
        out = (out.join(m, out[f"`{c}`"] == m["__label"], "left")
                  .select(*[code.alias(x) if x == c else F.col(f"`{x}`") for x in df.columns]))
    return out


def bool_to_int(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Boolean columns as 0/1 ints."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.select(*[F.col(f"`{c}`").cast("int").alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def fit_encoding(df: DataFrame, exclude: Sequence[str] = (),
                 max_levels: int = fixed.CLASS_MAX_DISTINCT, levels: dict | None = None,
                 distinct: dict | None = None) -> EncodePlan:
    """E5 plan: booleans cast, few-level text one-hot, many-level text label-encoded.
    ``levels`` (column -> levels or None) skips the probe for columns already probed."""
    booleans = tuple(f.name for f in df.schema.fields
                     if isinstance(f.dataType, T.BooleanType) and f.name not in exclude)
    texts = text_features(df, exclude)
    known = {c: v for c, v in (levels or {}).items() if c in texts}
    levels = {**fit_levels(df, [c for c in texts if c not in known], max_levels), **known}
    oh = {c: v for c, v in levels.items() if v is not None}
    lab = tuple(c for c in texts if levels[c] is None)
    bound = sum(distinct[c] for c in lab) if distinct and all(c in distinct for c in lab) else None
    maps, counts = label_codes_counted(df, lab, expected=bound) if lab else (None, {})
    return EncodePlan(one_hot=oh, label=lab, boolean=booleans, mappings=maps, label_counts=counts)


def apply_encoding(df: DataFrame, plan: EncodePlan) -> DataFrame:
    out = bool_to_int(df, plan.boolean) if plan.boolean else df
    if plan.label:
        out = apply_labels(out, plan.mappings, plan.label, plan.label_counts)
    if plan.one_hot:
        out = one_hot(out, plan.one_hot)
    return out


def decode(df: DataFrame, mappings: DataFrame, columns: dict[str, str],
           unknown: str = fixed.UNKNOWN_LABEL, counts: dict[str, int] | None = None) -> DataFrame:
    """For each ``output column -> mapping column``, the code (``int(float(x))``,
    truncating toward zero) becomes its label; unmapped or null values become 'Unknown'.

    Mappings are broadcast when their counted bytes are small (``counts``), else joined by shuffle.
    """
    out = df
    small = _small(list(columns.values()), counts)
    for col, key in columns.items():
        m = (mappings.filter(F.col("column_name") == key)
             .select(F.col("code").alias("__code"), F.col("label").alias("__label")))
        if key in small:
            m = F.broadcast(m)
        code = F.col(f"`{col}`").try_cast("double").try_cast("bigint")
        out = (out.join(m, code == m["__code"], "left")
                  .select(*[F.coalesce(F.col("__label"), F.lit(unknown)).alias(x) if x == col
                            else F.col(f"`{x}`") for x in out.columns]))
    return out
