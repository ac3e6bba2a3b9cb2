"""One model per target on shared features; prediction, clipping, save and load.

Features are assembled once into a table in the shared folder for all targets; training is MLlib's, so it
is distributed and nothing passes through the driver but model coefficients / trees. Several linear
targets are solved from one pass of sums of products (``fit_linear_together``), and a target with very many
classes is coded in digits, one classifier a digit (``ClassChain``).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith import fixed
from tabsmith.operators.encode import BROADCAST_MAX_BYTES
from tabsmith.operators.metrics import clip_predictions
from tabsmith.session import ensure_checkpoint_dir
from tabsmith.sources.tables import scratch_path

FEATURES = "__features"

# --- fixed values: algorithm families by name fragment (first match wins) -------
FAMILIES = (
    (("xgb", "xgboost", "lightgbm", "lgbm", "gbt", "gradient", "boost"), "gbt"),
    (("randomforest", "random_forest", "forest"), "forest"),
    (("decisiontree", "decision_tree", "tree"), "tree"),
    (("svc", "svm"), "svm"),
    (("logistic",), "linear"),
    (("ridge",), "ridge"),
    (("lasso",), "lasso"),
    (("elastic",), "elastic"),
    (("linear",), "linear"),
)
#: Penalty weight of ridge, lasso and elastic net, and the share of the absolute-value part.
ALPHA, L1_SHARE = 1.0, {"ridge": 0.0, "lasso": 1.0, "elastic": 0.5}
#: A classification target with more values than this is coded in digits of at most ``DIGIT_CLASSES`` values.
MAX_CLASSES, DIGIT_CLASSES = 10_000, 256
#: Linear targets are solved together up to this many features (the sums of products are a square matrix).
TOGETHER_WIDTH = 4096
#: Bytes of widened rows (8 a feature) that one task of a digit's fit takes.
CHAIN_TASK_BYTES = 128 << 20


def family_of(name: str) -> str:
    low = name.lower().replace(" ", "")
    for words, fam in FAMILIES:
        if any(w in low for w in words):
            return fam
    raise ValueError(f"no MLlib model for algorithm {name!r}")


def estimator_for(name: str, task: str, label: str, n_classes: int = 2, seed: int = fixed.SEED, n_rows: int = 1):
    """M2: the classifier or regressor of the named family; an unknown name, or one that
    does not fit the task, raises. GBT and linear SVM are binary in MLlib, so more classes
    use one-vs-rest. Ridge, lasso and elastic net minimise the usual penalised sums with
    weight ``ALPHA`` on features as they are (ridge's weight is on the sum, so it is divided by the rows)."""
    fam = family_of(name)
    common = dict(featuresCol=FEATURES, labelCol=label, predictionCol=fixed.PRED_PREFIX + label)
    if task == "Regression":
        if fam in L1_SHARE:
            reg = ALPHA / max(n_rows, 1) if fam == "ridge" else ALPHA
            return R.LinearRegression(regParam=reg, elasticNetParam=L1_SHARE[fam], standardization=False, **common)
        if fam == "svm":
            raise ValueError(f"{name!r} is no regressor in MLlib")
        if fam == "gbt":
            return R.GBTRegressor(seed=seed, **common)
        if fam == "forest":
            return R.RandomForestRegressor(seed=seed, **common)
        if fam == "tree":
            return R.DecisionTreeRegressor(seed=seed, **common)
        return R.LinearRegression(**common)
    if fam in L1_SHARE:
        raise ValueError(f"{name!r} is a regressor, the task is classification")
    if fam in ("gbt", "svm"):
        base = (C.GBTClassifier(seed=seed, featuresCol=FEATURES, labelCol=label) if fam == "gbt"
                else C.LinearSVC(featuresCol=FEATURES, labelCol=label))
        if n_classes > 2:
            return C.OneVsRest(classifier=base, **common)
        return base.setPredictionCol(fixed.PRED_PREFIX + label)
    if fam == "forest":
        return C.RandomForestClassifier(seed=seed, probabilityCol=f"__prob_{label}",
                                        rawPredictionCol=f"__raw_{label}", **common)
    if fam == "tree":
        return C.DecisionTreeClassifier(seed=seed, probabilityCol=f"__prob_{label}",
                                        rawPredictionCol=f"__raw_{label}", **common)
    return C.LogisticRegression(probabilityCol=f"__prob_{label}", rawPredictionCol=f"__raw_{label}",
                                **common)


@dataclass
class TrainedModels:
    algorithm: str
    features: tuple[str, ...]
    tasks: dict                         # target -> task (M6: the task travels with the model)
    models: dict                        # target -> fitted model
    limits: dict = field(default_factory=dict)   # target -> (min, max) of the training target
    classes: dict = field(default_factory=dict)  # classification target -> its values, ascending (code = place)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` plus the feature vector; feature names may hold dots."""
    plain = [f"__f{i}" for i in range(len(features))]
    out = df.select("*", *[F.col(f"`{c}`").cast("double").alias(p) for c, p in zip(features, plain, strict=True)])
    return VectorAssembler(inputCols=plain, outputCol=FEATURES, handleInvalid="keep").transform(out).drop(*plain)


def class_values(df: DataFrame, target: str, most: int = MAX_CLASSES) -> list[float] | None:
    """The values of a classification target, ascending; None if there are more than ``most``."""
    rows = df.select(target).where(F.col(target).isNotNull()).distinct().limit(most + 1).collect()
    return None if len(rows) > most else sorted(r[0] for r in rows)


def class_codes(df: DataFrame, target: str) -> tuple[DataFrame, int]:
    """``(value, code)`` with codes 0.. in ascending order of the values, and their number.

    Distinct values are range-partitioned, sorted and checkpointed; a code is the place inside the
    partition plus the partition's offset, so the driver sees one count a partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    values = df.select(F.col(f"`{target}`").alias("value")).where(F.col("value").isNotNull()).distinct()
    ranged = values.repartitionByRange("value").sortWithinPartitions("value").checkpoint(eager=True)
    placed = ranged.select("value", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid"))
    starts, n = [], 0
    for r in sorted(placed.groupBy("pid").count().collect()):
        starts.append((r["pid"], n - (r["pid"] << 33)))
        n += r["count"]
    offsets = spark.createDataFrame(starts, "pid int, base long")
    return placed.join(F.broadcast(offsets), "pid").select("value", (F.col("mid") + F.col("base")).alias("code")), n


def digit_base(n: int) -> tuple[int, int]:
    """``(digits, base)``: the fewest digits of at most ``DIGIT_CLASSES`` values that tell ``n`` codes
    apart, and the smallest base that does it with so many."""
    digits = 1
    while DIGIT_CLASSES ** digits < n:
        digits += 1
    base = max(2, int(n ** (1 / digits)) - 1)
    while base ** digits < n:
        base += 1
    return digits, base


def code_digits(code, digits: int, base: int) -> list:
    """The digits of a code column, highest first."""
    return [F.floor(code / F.lit(base ** (digits - 1 - j))).cast("long") % base for j in range(digits)]


def with_classes(label, name: str, n_classes: int):
    """The label column; over 100 classes, which trees refuse to infer, with their number in its metadata."""
    if n_classes <= 100:
        return label.cast("double").alias(name)
    return label.cast("double").alias(name, metadata={"ml_attr": {"type": "nominal", "num_vals": n_classes}})


@dataclass
class ClassChain:
    """Classifiers of the digits of a class code, highest first; each also sees the digits before its own.

    A combination of digits beyond the last code means the last code. ``values`` maps codes to the
    target's values; it is broadcast only while its rows (16 bytes each, counted) are few.
    """

    values: DataFrame
    n: int
    digits: int
    base: int
    models: list = field(default_factory=list)

    def _map(self) -> DataFrame:
        return F.broadcast(self.values) if 16 * self.n <= BROADCAST_MAX_BYTES else self.values

    def _features(self, before: Sequence):
        marks = [F.transform(F.sequence(F.lit(0), F.lit(self.base - 1)), lambda i, d=d: (i == d).cast("double")) for d in before]
        return array_to_vector(F.concat(vector_to_array(F.col(FEATURES)), *marks)) if marks else F.col(FEATURES)

    def tasks(self, n_rows: int, width: int) -> int:
        """Tasks among which ``n_rows`` rows of ``width`` features are dealt: the written table is compact, but
        MLlib keeps each row with the marks of all digits before, ``base`` numbers a digit."""
        return max(1, -(-8 * n_rows * (width + self.base * (self.digits - 1)) // CHAIN_TASK_BYTES))

    def fit(self, rows: DataFrame, label: str, algorithm: str, n_rows: int, width: int) -> ClassChain:
        coded = rows.join(self._map(), F.col(label) == F.col("value"))
        names = [f"__d{j}" for j in range(self.digits)]
        coded = coded.select(FEATURES, *[with_classes(d, c, self.base) for d, c in zip(code_digits(F.col("code"), self.digits, self.base), names, strict=True)])
        if (n_tasks := self.tasks(n_rows, width)) > 1:
            coded = coded.repartition(n_tasks)
        for j, c in enumerate(names):
            seen = coded.select(self._features([F.col(x) for x in names[:j]]).alias(FEATURES), F.col(c))
            self.models.append(estimator_for(algorithm, "Classification", c, self.base).fit(seen))
        return self

    def predict(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the predicted value in ``name``."""
        out, found = df, []
        for m in self.models:
            wide = out.select("*", F.col(FEATURES).alias("__plain")).withColumn(FEATURES, self._features([F.col(c) for c in found]))
            found.append(f"__digit{len(found)}")
            scored = m.transform(wide)
            out = scored.select(*[F.col(f"`{c}`") for c in out.columns if c != FEATURES], F.col("__plain").alias(FEATURES),
                                F.col(f"`{m.getPredictionCol()}`").cast("long").alias(found[-1]))
        code = sum(F.col(c) * self.base ** (self.digits - 1 - j) for j, c in enumerate(found))
        out = out.withColumn("__code", F.least(code, F.lit(self.n - 1)))
        values = self._map().select(F.col("value").alias(name), F.col("code").alias("__code"))
        return out.join(values, "__code", "left").drop("__code", *found)


@dataclass
class LinearModel:
    """Coefficients of one linear target over the assembled features."""

    label: str
    intercept: float
    coefficients: list

    def getPredictionCol(self) -> str:  # noqa: N802 - as MLlib's models
        return fixed.PRED_PREFIX + self.label

    def transform(self, df: DataFrame) -> DataFrame:
        products = F.zip_with(vector_to_array(F.col(FEATURES)), F.lit(self.coefficients), lambda x, b: x * b)
        return df.withColumn(self.getPredictionCol(), F.aggregate(products, F.lit(self.intercept), lambda s, x: s + x))


def fit_linear_together(rows: DataFrame, labels: Sequence[str], alpha: float = 0.0) -> dict[str, LinearModel] | None:
    """Least squares (``alpha`` > 0: ridge, weight on the sum) of several targets from one pass.

    One distributed tree sum gives all products of (1, features, targets), taken about the first row so
    that large means cost no digits; the driver solves systems whose size is the table's width. Features
    that others explain share the weight (smallest norm of the scaled coefficients), a constant one has
    none. None where a value is missing, infinite or not a number: the caller then fits them one by one.
    """
    every = F.concat(vector_to_array(F.col(FEATURES)), F.array(*[F.col(n) for n in labels]))
    first = rows.select(every.alias("v")).first()
    if first is None or any(v is None or not np.isfinite(v) for v in first["v"]):
        return None
    shift = [float(v) for v in first["v"]]
    moved = F.concat(F.array(F.lit(1.0)), F.zip_with(every, F.lit(shift), lambda x, s: x - s))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(moved).alias("v")), "v")
    sums = RowMatrix(vectors, numCols=len(shift) + 1).computeGramianMatrix().toArray()
    if not np.isfinite(sums).all():
        return None
    n, mean, p = sums[0, 0], sums[0, 1:] / sums[0, 0], len(shift) - len(labels)
    about = sums[1:, 1:] - n * np.outer(mean, mean)
    varies = np.diag(about)[:p] > 1e-12 * np.diag(sums)[1:p + 1]
    scale = np.where(varies, np.sqrt(np.abs(np.diag(about)[:p])), 1.0)
    xx, xy = about[:p, :p] / np.outer(scale, scale), about[:p, p:] / scale[:, None]
    xx[~varies], xx[:, ~varies], xy[~varies] = 0.0, 0.0, 0.0
    root, vec = np.linalg.eigh(xx if not alpha else xx + np.diag(alpha / scale**2))
    inverse = np.where(root > 1e-10 * max(root.max(initial=0.0), 1e-300), 1 / np.where(root > 0, root, 1.0), 0.0)
    weights = (vec * inverse) @ (vec.T @ xy) / scale[:, None]
    centre = mean + np.array(shift)
    return {c: LinearModel(c, float(centre[p + i] - centre[:p] @ weights[:, i]), weights[:, i].tolist()) for i, c in enumerate(labels)}


def train(train_df: DataFrame, targets: Sequence[str], algorithm: str, tasks: dict, max_classes: int = MAX_CLASSES) -> TrainedModels:
    """M1 + M3: one model per target on the same features.

    The assembled table is written once to the shared folder, so fitting passes read compact rows
    and a lost executor costs no more than its part. The values of a classification target are
    coded 0..k-1 for the fit and kept, whatever they are (ratings, -1 / 1, years); beyond ``max_classes``
    values the code is learned digit by digit. Linear and ridge targets without nulls are solved from
    one pass when there are several; a target with nulls is fitted on its own rows.
    """
    feats = [c for c in train_df.columns if c not in set(targets)]
    labels = {t: f"__t{i}" for i, t in enumerate(targets)}
    path = scratch_path(train_df.sparkSession, "assembled")
    assemble(train_df, feats).select(FEATURES, *[F.col(f"`{t}`").cast("double").alias(n) for t, n in labels.items()]).write.parquet(path)
    assembled = train_df.sparkSession.read.parquet(path)
    stats = assembled.agg(F.count(F.lit(1)).alias("rows"), *[f(n).alias(f"{k}{n}") for n in labels.values() for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    limits = {t: (stats[f"lo{n}"], stats[f"hi{n}"]) for t, n in labels.items()}
    family = family_of(algorithm)
    whole = [n for t, n in labels.items() if tasks[t] == "Regression" and stats[f"n{n}"] == stats["rows"]]
    together = None
    if family in ("linear", "ridge") and len(whole) > 1 and len(feats) <= TOGETHER_WIDTH:
        together = fit_linear_together(assembled, whole, ALPHA if family == "ridge" else 0.0)
    models, classes = {}, {}
    for t, n in labels.items():
        if together and n in together:
            models[t] = together[n]
            continue
        rows = assembled.filter(F.col(n).isNotNull())
        if tasks[t] == "Classification":
            found = class_values(assembled, n, max_classes)
            if found is None:
                values, k = class_codes(assembled, n)
                models[t] = ClassChain(values, k, *digit_base(k)).fit(rows, n, algorithm, stats[f"n{n}"], len(feats))
                continue
            classes[t] = found
            codes = train_df.sparkSession.createDataFrame([(v, float(i)) for i, v in enumerate(found)], "__v double, __code double")
            rows = rows.join(F.broadcast(codes), rows[n] == F.col("__v")).select(FEATURES, with_classes(F.col("__code"), n, len(found)))
        est = estimator_for(algorithm, tasks[t], n, len(classes.get(t, ())) or 2, n_rows=stats[f"n{n}"])
        models[t] = est.fit(rows)
    return TrainedModels(algorithm, tuple(feats), dict(tasks), models, limits, classes)


def predict(tm: TrainedModels, df: DataFrame, clip: bool = True) -> DataFrame:
    """M4 + M5: ``Pred_<target>`` for every row of ``df``; regression clipped to the training
    range, class codes turned back into the target's values; vectors and probabilities dropped."""
    out = assemble(df, tm.features)
    values = []
    for i, (t, m) in enumerate(tm.models.items()):
        if isinstance(m, ClassChain):
            out = m.predict(out, f"__value{i}")
            values.append(F.col(f"__value{i}").alias(fixed.PRED_PREFIX + t))
            continue
        out = m.transform(out)
        pred = F.col(f"`{m.getPredictionCol()}`").cast("double")
        if t in tm.classes:
            pred = F.get(F.array(*[F.lit(float(v)) for v in tm.classes[t]]), pred.cast("int"))
        values.append(pred.alias(fixed.PRED_PREFIX + t))
    out = out.select(*[F.col(f"`{c}`") for c in df.columns], *values)
    return clip_predictions(out, tm.limits, tm.tasks) if clip else out


def save_models(tm: TrainedModels, path: str) -> None:
    """Each target's model under ``path/models/<target>`` (a digit chain: one model a digit, its
    values under ``path/values/<target>``) plus a JSON manifest."""
    chains, linear = {}, {}
    for t, m in tm.models.items():
        if isinstance(m, ClassChain):
            m.values.write.mode("overwrite").parquet(f"{path}/values/{t}")
            for j, digit in enumerate(m.models):
                digit.write().overwrite().save(f"{path}/models/{t}/{j}")
            chains[t] = {"n": m.n, "digits": m.digits, "base": m.base, "classes": [type(x).__name__ for x in m.models]}
        elif isinstance(m, LinearModel):
            linear[t] = [m.label, m.intercept, m.coefficients]
        else:
            m.write().overwrite().save(f"{path}/models/{t}")
    s = SparkSession.getActiveSession()
    manifest = {"algorithm": tm.algorithm, "features": list(tm.features), "tasks": tm.tasks, "targets": list(tm.models),
                "limits": {k: list(v) for k, v in tm.limits.items()}, "values": tm.classes, "chains": chains, "linear": linear,
                "classes": {t: type(m).__name__ for t, m in tm.models.items() if t not in chains and t not in linear}}
    s.createDataFrame([(json.dumps(manifest),)], "manifest string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/manifest")


def load_models(spark, path: str) -> TrainedModels:
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])

    def load(cls: str, where: str):
        return (getattr(C, cls, None) or getattr(R, cls, None)).load(f"{path}/models/{where}")

    models = {}
    for t in manifest.get("targets", manifest["classes"]):
        if t in manifest.get("chains", {}):
            c = manifest["chains"][t]
            digits = [load(cls, f"{t}/{j}") for j, cls in enumerate(c["classes"])]
            models[t] = ClassChain(spark.read.parquet(f"{path}/values/{t}"), c["n"], c["digits"], c["base"], digits)
        elif t in manifest.get("linear", {}):
            models[t] = LinearModel(*manifest["linear"][t])
        else:
            models[t] = load(manifest["classes"][t], t)
    return TrainedModels(manifest["algorithm"], tuple(manifest["features"]), manifest["tasks"], models,
                         {k: tuple(v) for k, v in manifest["limits"].items()}, manifest["values"])
