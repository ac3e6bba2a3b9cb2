"""The cleaning recipe: fit the nine phases once, apply them to any table of the same shape.

    recipe = fit(df, Config(targets=["price"]))
    clean = recipe.transform(df)          # lazy: one projection per phase, two row filters

Fitting reads the source at most four times: two scans of the profile, which also take the text
and date decisions, one that looks up long values the profile shows, and one that writes the
typed table (texts cleaned, numbers and dates parsed). One more confirms columns that look equal.
All later passes read the typed table, each over the output of the previous phase (as the rules
require: skew after text cleaning, bounds after filling):

    3 target codes (text targets only)   6 moments / medians / modes   7 quartiles   8 levels / codes

Only per-column numbers, at most ``max_levels + 1`` levels per column and label counts
reach the driver; label mappings stay distributed.
"""

from __future__ import annotations

import json
import logging
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith import fixed
from tabsmith.operators import audit, dates, encode, impute, outliers, prune, target, text
from tabsmith.operators.profile import profile_with_texts
from tabsmith.sources.tables import scratch_path

log = logging.getLogger(__name__)

#: Values up to which the typed table is dealt over all cores; a larger one has splits enough as it is read.
SMALL_TABLE = 100_000_000


@dataclass(frozen=True)
class Config:
    targets: tuple[str, ...]
    protect_text: bool = False           # True: text columns are never dropped as IDs
    keep_sign: bool = False              # formatted numbers keep a leading minus
    max_levels: int = fixed.CLASS_MAX_DISTINCT
    parity: bool = False                 # True: label-coded text targets follow the <=15 rule too
    validate: bool = True

    def __post_init__(self):
        if isinstance(self.targets, str):
            object.__setattr__(self, "targets", (self.targets,))
        object.__setattr__(self, "targets", tuple(self.targets))


@dataclass
class Recipe:
    config: Config
    columns: tuple[str, ...]
    drops: dict = field(default_factory=dict)            # column -> reasons
    tasks: dict = field(default_factory=dict)            # target -> Classification / Regression
    target_coded: tuple = ()                             # text targets turned into codes
    target_mapping: DataFrame | None = None              # (column_name, label, code)
    target_classes: dict = field(default_factory=dict)
    text: text.TextPlan = field(default_factory=text.TextPlan)
    date_columns: tuple = ()
    fill: impute.FillPlan = field(default_factory=impute.FillPlan)
    bounds: dict = field(default_factory=dict)
    encoding: encode.EncodePlan = field(default_factory=encode.EncodePlan)
    profile_rows: list = field(default_factory=list)
    fit_seconds: dict = field(default_factory=dict)      # wall time per fit phase

    # --- apply ------------------------------------------------------------
    def drop_columns(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in self.drops if c in df.columns])

    def handle_targets(self, df: DataFrame) -> DataFrame:
        df = target.drop_null_target(df, self.config.targets)
        if self.target_coded:
            df = encode.apply_labels(df, self.target_mapping, self.target_coded, self.target_classes)
        for t in self.config.targets:
            if t not in self.target_coded:
                df = target.cast_target(df, t)
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """Phases 2-8 as lazy projections (plus the null-target and bad-date row filters)."""
        df = self.drop_columns(df)
        df = self.handle_targets(df)
        df = text.apply_text(df, self.text)
        df = dates.date_parts(df, list(self.date_columns))
        df = impute.apply_fill(df, self.fill)
        df = outliers.clip(df, self.bounds)
        df = encode.apply_encoding(df, self.encoding)
        return df

    @property
    def mappings(self) -> DataFrame | None:
        """Every label mapping (features and text targets) as one long table."""
        parts = [m for m in (self.target_mapping, self.encoding.mappings) if m is not None]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def label_counts(self) -> encode.LabelCounts:
        """Label counts and mapping sizes of coded features and targets."""
        parts = (self.encoding.label_counts, self.target_classes)
        return encode.LabelCounts({k: v for p in parts for k, v in p.items()},
                                  {k: v for p in parts for k, v in getattr(p, "nbytes", {}).items()})

    def encodings(self) -> dict:
        e = {c: "one_hot" for c in self.encoding.one_hot}
        e.update({c: "label" for c in self.encoding.label})
        e.update({c: "bool_to_int" for c in self.encoding.boolean})
        e.update({t: "label_target" for t in self.target_coded})
        return e


def _numeric_types():
    return (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def check_supported(df: DataFrame) -> None:
    """Only primitive columns are supported; arrays, maps and structs are named in the error."""
    bad = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields
           if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    if bad:
        raise TypeError("unsupported column types: " + ", ".join(bad))


class _Clock:
    def __init__(self):
        self.t = time.time()
        self.laps = {}

    def lap(self, name):
        now = time.time()
        self.laps[name] = round(now - self.t, 3)
        self.t = now


def fit(df: DataFrame, config: Config) -> Recipe:
    """Fit every phase on ``df`` (all rows, the parity default)."""
    clock = _Clock()
    check_supported(df)
    spark = df.sparkSession
    targets = list(config.targets)
    unknown = [t for t in targets if t not in df.columns]
    if unknown:
        raise ValueError(f"unknown target column(s): {unknown}")
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    if decimals:
        df = df.select(*[F.col(f"`{c}`").cast("double").alias(c) if c in decimals else F.col(f"`{c}`")
                         for c in df.columns])

    # phase 1: profile the raw table (one job), decisions read the collected rows. The same
    # pass takes the text statistics of phase 4 over the rows that phase 3 will keep, and counts
    # date parses of date-hinted text: phase 4 leaves the columns it does not select
    # unchanged, so those counts are what phase 5 would see
    types = {f.name: f.dataType for f in df.schema.fields}
    typed_dates, hinted = dates.date_candidates(df, exclude=targets)
    probe = text.TextProbe(tuple(text.string_columns(df, targets)), tuple(hinted), target.has_targets(df, targets), config.keep_sign)
    prof_small, text_rows = profile_with_texts(df, probe, digits=None)
    rows = prof_small.collect()
    distinct = {r.column_name: r.n_distinct for r in rows}
    recipe = Recipe(config=config, columns=tuple(df.columns), profile_rows=rows)
    clock.lap("profile")

    # phase 2: drop plan (targets protected)
    recipe.drops = {r.column_name: r.reasons for r in
                    prune.plan_drops(df, targets, prof_small, config.protect_text).collect()}
    cur = recipe.drop_columns(df)
    clock.lap("drops")

    # phases 4 and 5: text (formatted numbers, long text, yes/no words) and dates, by the rows of phase 1
    recipe.text = text.decide([r for r in text_rows if r.column_name not in recipe.drops], config.keep_sign)
    touched = set(recipe.text.formatted) | set(recipe.text.truncated) | set(recipe.text.boolean)
    found = set(typed_dates)
    for c in hinted:
        st = recipe.text.stats.get(c)
        if c not in touched and st and st["n_nonnull"] and \
                st["n_parsed"] / st["n_nonnull"] >= fixed.DATE_MIN_PARSED_SHARE:
            found.add(c)
    recipe.date_columns = tuple(c for c in cur.columns if c in found)
    clock.lap("text")

    # the typed table: what all later passes read, several times, in place of the source
    cur = target.drop_null_target(cur, targets)
    cur = dates.date_parts(text.apply_text(cur, recipe.text), list(recipe.date_columns), drop_unparsed=False)
    if rows and rows[0].n_rows * len(cur.columns) <= SMALL_TABLE:
        cur = cur.repartition(spark.sparkContext.defaultParallelism)
    typed_path = scratch_path(spark, "typed")
    cur.write.parquet(typed_path)
    cur = spark.read.schema(cur.schema).parquet(typed_path)
    clock.lap("typed")

    # phase 3: targets; a text target's codes cover the rows whose dates are dropped after it, too
    coded = tuple(t for t in targets if not isinstance(types[t], _numeric_types()))
    recipe.target_coded = coded
    if coded:
        recipe.target_mapping, recipe.target_classes = encode.label_codes_counted(
            cur, coded, expected=sum(distinct[t] for t in coded))
    for t in targets:
        nd = distinct[t]
        if t in coded and not config.parity:
            recipe.tasks[t] = "Classification"
        elif isinstance(types[t], T.BooleanType) or nd <= config.max_levels:
            recipe.tasks[t] = "Classification"
        else:
            recipe.tasks[t] = "Regression"
    cur = recipe.handle_targets(cur.filter(dates.all_parsed(recipe.date_columns)))
    clock.lap("targets")

    # phase 6: fill (skew measured after phases 4-5; targets never filled)
    # proven label-count bounds: text cleaning can only merge values; a fill adds one
    bounded = {c: n + 1 for c, n in distinct.items()}
    bounded |= {f"{c}_{part}": distinct[c] + 1 for c in recipe.date_columns for part in dates.PARTS}
    recipe.fill = impute.fit_fill(cur, exclude=targets, max_levels=config.max_levels, distinct=bounded)
    cur = impute.apply_fill(cur, recipe.fill)
    clock.lap("fill")

    # phase 7: cap numeric features (not targets, not binary, IQR > 0)
    num = impute.numeric_columns(cur, exclude=targets)
    mm = {c: (s["min"], s["max"]) for c, s in recipe.fill.stats.items() if c in num}
    if all(c in mm for c in num):
        recipe.bounds = outliers.fit_iqr(cur, num, bounds=mm, distinct=bounded)
    else:
        recipe.bounds = outliers.fit_iqr(cur, num, distinct=bounded)
    cur = outliers.clip(cur, recipe.bounds)
    clock.lap("outliers")

    # phase 8: encode text / boolean features
    recipe.encoding = encode.fit_encoding(cur, exclude=targets, max_levels=config.max_levels,
                                          levels=recipe.fill.levels, distinct=bounded)
    cur = encode.apply_encoding(cur, recipe.encoding)
    clock.lap("encode")

    # phase 9: contract
    if config.validate:
        audit.assert_clean(cur, targets)
    clock.lap("validate")
    recipe.fit_seconds = clock.laps
    log.info("recipe fitted: drops=%s tasks=%s", recipe.drops, recipe.tasks)
    return recipe


def clean(df: DataFrame, targets, **kw) -> tuple[DataFrame, Recipe]:
    """Fit and apply in one call: ``(clean frame, recipe)``."""
    r = fit(df, Config(targets=tuple([targets] if isinstance(targets, str) else targets), **kw))
    return r.transform(df), r


def save_recipe(recipe: Recipe, path: str) -> str:
    """Write the fitted decisions as one JSON document (``path/recipe``) and the label
    mappings as JSON lines (``path/mappings``), so the recipe can be applied later."""
    from tabsmith.sources.records import write_mappings
    spark = SparkSession.getActiveSession()
    doc = {
        "config": asdict(recipe.config), "columns": list(recipe.columns), "drops": recipe.drops,
        "tasks": recipe.tasks, "target_coded": list(recipe.target_coded),
        "target_classes": recipe.target_classes,
        "text": {"formatted": list(recipe.text.formatted), "truncated": list(recipe.text.truncated),
                 "boolean": list(recipe.text.boolean), "keep_words": recipe.text.keep_words,
                 "keep_sign": recipe.text.keep_sign},
        "date_columns": list(recipe.date_columns),
        "fill": {"numeric": {c: list(v) for c, v in recipe.fill.numeric.items()},
                 "categorical": recipe.fill.categorical,
                 "stats": {c: {"n": st["n"], "nn": st["nn"]} for c, st in recipe.fill.stats.items()}},
        "bounds": {c: list(v) for c, v in recipe.bounds.items()},
        "encoding": {"one_hot": {c: list(v) for c, v in recipe.encoding.one_hot.items()},
                     "label": list(recipe.encoding.label), "boolean": list(recipe.encoding.boolean),
                     "label_counts": recipe.encoding.label_counts},
        # counted sizes of the mappings: without them a loaded recipe could broadcast none
        "nbytes": {"targets": getattr(recipe.target_classes, "nbytes", {}), "labels": getattr(recipe.encoding.label_counts, "nbytes", {})},
    }
    spark.createDataFrame([(json.dumps(doc),)], "recipe string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/recipe")
    if recipe.mappings is not None:
        write_mappings(recipe.mappings, f"{path}/mappings")
    return path


def load_recipe(spark, path: str) -> Recipe:
    """Read a recipe written by ``save_recipe``; mappings stay distributed."""
    from tabsmith.sources.records import read_mappings
    doc = json.loads(spark.read.text(f"{path}/recipe").first()[0])
    maps = read_mappings(spark, f"{path}/mappings")
    coded = tuple(doc["target_coded"])
    enc = doc["encoding"]
    target_map = maps.filter(F.col("column_name").isin(list(coded))) if (maps is not None and coded) else None
    label_map = maps.filter(F.col("column_name").isin(enc["label"])) if (maps is not None and enc["label"]) else None
    nbytes = doc.get("nbytes", {"targets": {}, "labels": {}})  # recipes saved before have none
    cfg = doc["config"]
    cfg["targets"] = tuple(cfg["targets"])
    return Recipe(
        config=Config(**cfg), columns=tuple(doc["columns"]), drops=doc["drops"], tasks=doc["tasks"],
        target_coded=coded, target_mapping=target_map, target_classes=encode.LabelCounts(doc["target_classes"], nbytes["targets"]),
        text=text.TextPlan(tuple(doc["text"]["formatted"]), tuple(doc["text"]["truncated"]),
                           tuple(doc["text"]["boolean"]), doc["text"]["keep_words"], doc["text"]["keep_sign"]),
        date_columns=tuple(doc["date_columns"]),
        fill=impute.FillPlan(numeric={c: tuple(v) for c, v in doc["fill"]["numeric"].items()},
                             categorical=doc["fill"]["categorical"], stats=doc["fill"]["stats"]),
        bounds={c: tuple(v) for c, v in doc["bounds"].items()},
        encoding=encode.EncodePlan(one_hot={c: tuple(v) for c, v in enc["one_hot"].items()},
                                   label=tuple(enc["label"]), boolean=tuple(enc["boolean"]),
                                   mappings=label_map, label_counts=encode.LabelCounts(enc["label_counts"], nbytes["labels"])))
