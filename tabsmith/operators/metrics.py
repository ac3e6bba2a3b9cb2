"""Evaluation metrics as aggregates, the scorecard, and the prediction table.

Classification metrics come from one grouped count (the confusion table, bounded by
classes squared); regression metrics are one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith import fixed


def classification_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """K1-K4: accuracy and support-weighted precision, recall, F1 (a class never
    predicted has precision 0)."""
    conf = df.groupBy(F.col(f"`{y}`").alias("y"), F.col(f"`{p}`").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    support = conf.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("support"))
    predicted = conf.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("predicted"))
    tp = conf.filter(F.col("y").eqNullSafe(F.col("p"))).select(F.col("y").alias("c"), F.col("n").alias("tp"))
    per = (support.join(predicted, "c", "left").join(tp, "c", "left")
           .select("c", "support", F.coalesce("predicted", F.lit(0)).alias("predicted"),
                   F.coalesce("tp", F.lit(0)).alias("tp")))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.col("tp") / F.col("support")
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    total = F.sum("support")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(prec * F.col("support")) / total).alias("precision"),
        (F.sum(rec * F.col("support")) / total).alias("recall"),
        (F.sum(f1 * F.col("support")) / total).alias("f1"),
        F.count(F.lit(1)).alias("n_classes"))


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """K5-K7: MSE, MAE and R2 = 1 - SSE/SST (negative allowed; constant truth gives 1 or 0)."""
    yy, pp = F.col(f"`{y}`").cast("double"), F.col(f"`{p}`").cast("double")
    a = df.agg(F.avg((yy - pp) ** 2).alias("mse"), F.avg(F.abs(yy - pp)).alias("mae"),
               F.sum((yy - pp) ** 2).alias("sse"), (F.var_pop(yy) * F.count(yy)).alias("sst"))
    r2 = (F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst"))
          .when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return a.select("mse", "mae", r2.alias("r2"))


def metrics_long(df: DataFrame, target: str, task: str, pred: str | None = None,
                 digits: int = 4) -> DataFrame:
    """``(target, task, metric, value)`` rows for one target, values at 4 decimals."""
    pred = pred or fixed.PRED_PREFIX + target
    if task == "Classification":
        m = classification_metrics(df, target, pred)
        names = ["accuracy", "precision", "recall", "f1"]
    else:
        m = regression_metrics(df, target, pred)
        names = ["mse", "mae", "r2"]
    entries = [F.struct(F.lit(n).alias("metric"), F.round(F.col(n), digits).alias("value")) for n in names]
    extra = [F.col("n_classes")] if task == "Classification" else [F.lit(None).cast("bigint").alias("n_classes")]
    return m.select(F.lit(target).alias("target"), F.lit(task).alias("task"), *extra,
                    F.explode(F.array(*entries)).alias("e")).select("target", "task", "n_classes", "e.*")


def target_limits(train: DataFrame, targets: Sequence[str]) -> DataFrame:
    """M3: ``(target, min, max)`` of each training target, one pass."""
    aggs = []
    for i, t in enumerate(targets):
        x = F.col(f"`{t}`").cast("double")
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    entries = [F.struct(F.lit(t).alias("target"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
               for i, t in enumerate(targets)]
    return train.agg(*aggs).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def clip_predictions(df: DataFrame, limits: dict[str, tuple], tasks: dict[str, str]) -> DataFrame:
    """M5: regression predictions are held inside the training range; classes are untouched."""
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c.startswith(fixed.PRED_PREFIX):
            t = c[len(fixed.PRED_PREFIX):]
            if tasks.get(t) == "Regression" and t in limits:
                lo, hi = limits[t]
                x = F.when(x.isNotNull(), F.greatest(F.least(x.cast("double"), F.lit(hi)), F.lit(lo)))
        out.append(x.alias(c))
    return df.select(*out)


def scorecard_lines(metrics: DataFrame, task_strategy: str, framework: str,
                    targets: Sequence[str]) -> DataFrame:
    """K8: the scorecard as ``(line_no, line)`` rows, metrics at 4 decimals."""
    spark = metrics.sparkSession
    label = F.create_map(*[x for k, v in fixed.METRIC_LABELS.items() for x in (F.lit(k), F.lit(v))])
    order = F.create_map(*[x for i, k in enumerate(fixed.METRIC_LABELS) for x in (F.lit(k), F.lit(i))])
    tpos = F.create_map(*[x for i, t in enumerate(targets) for x in (F.lit(t), F.lit(i))])
    targets_json = "[" + ", ".join(f'"{t}"' for t in targets) + "]"
    head = spark.createDataFrame([
        (0, 0, fixed.SCORECARD_START), (0, 1, fixed.SCORECARD_HEADER),
        (0, 2, f"Task Strategy: {task_strategy}"), (0, 3, f"Selected Framework: {framework}"),
        (0, 4, f"Target Variables: {targets_json}"), (0, 5, "")], "grp int, pos int, line string")
    body_t = metrics.select("target", "task").distinct().select(
        (tpos[F.col("target")] + 1).alias("grp"), F.lit(0).alias("pos"),
        F.format_string("Target: %s (%s)", "target", "task").alias("line"))
    body_m = metrics.select(
        (tpos[F.col("target")] + 1).alias("grp"), (order[F.col("metric")] + 1).alias("pos"),
        F.format_string("%s: %.4f", label[F.col("metric")], F.col("value")).alias("line"))
    n = len(targets) + 1
    tail = spark.createDataFrame([(n, 0, fixed.SCORECARD_RULE), (n, 1, fixed.SCORECARD_END)],
                                 "grp int, pos int, line string")
    allr = head.unionByName(body_t).unionByName(body_m).unionByName(tail)
    # a scorecard has a handful of lines per target: the ordering window is bounded by that
    from pyspark.sql import Window
    return allr.select(F.row_number().over(Window.orderBy("grp", "pos")).alias("line_no"), "line")


def prediction_table(scored: DataFrame, shown: Sequence[str], targets: Sequence[str],
                     mappings: DataFrame | None = None, decoded: Sequence[str] = (),
                     counts: dict | None = None, coded: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """K9: display columns + truth + ``Pred_*`` for all rows; label-coded targets (``decoded``) and
    display columns (``coded``) decoded, numbers at 4 decimals. Returned lazily, never collected."""
    from tabsmith.operators.encode import decode
    cols = list(shown) + list(targets) + [fixed.PRED_PREFIX + t for t in targets]
    out = scored.select(*[F.col(f"`{c}`") for c in cols])
    if mappings is not None and (decoded or coded):
        m = {c: c for c in coded}
        for t in decoded:
            m[t] = t
            m[fixed.PRED_PREFIX + t] = t
        out = decode(out, mappings, m, counts=counts)
    return out.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if t in ("double", "float")
                        else F.col(f"`{c}`") for c, t in out.dtypes])
