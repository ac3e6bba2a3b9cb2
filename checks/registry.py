"""Registered queries (Spark side) and their DuckDB oracles.

Every query reads whole driver tables under ``sf_dir`` (or frames Spark derives from
them); nothing is sampled, capped or filtered to make the check cheaper.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.oracles import SCHEMAS, drop_plan_sql, duplicates_sql, profile_sql
from tabsmith.operators import profile as prof

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _no_fp(df: DataFrame) -> DataFrame:
    return df.drop("fingerprint")


# ---------------------------------------------------------------- profiling (P)

for _t in ("orders", "lineitem", "customer", "part"):
    def _profile(spark, sf_dir, _t=_t):
        return _no_fp(prof.profile(table(spark, sf_dir, _t)))
    register(f"profile_{_t}", profile_sql(f"SELECT * FROM {_t}", SCHEMAS[_t]))(_profile)

EVENTS_WITH_NULLS = ("SELECT event_id, ts, user_id, event_type, "
                     "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, "
                     "CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL ELSE props END "
                     "AS props FROM events")


def events_with_nulls(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "ts", "user_id", "event_type",
                    F.when(F.col("event_type") == "error", None).otherwise(F.col("value")).alias("value"),
                    F.when(F.col("event_type").isin("error", "view", "click"), None)
                     .otherwise(F.col("props")).alias("props"))


@register("profile_events_nulls", profile_sql(EVENTS_WITH_NULLS, SCHEMAS["events"]))
def q_profile_events_nulls(spark, sf_dir):
    return _no_fp(prof.profile(events_with_nulls(spark, sf_dir)))


@register("shape_lineitem", "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_cols FROM lineitem")
def q_shape_lineitem(spark, sf_dir):
    return prof.shape(table(spark, sf_dir, "lineitem"))


@register("column_types_orders", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(SCHEMAS["orders"]))
    + ") AS v(ordinal, column_name, dtype)")
def q_column_types_orders(spark, sf_dir):
    return prof.column_types(table(spark, sf_dir, "orders"))


@register("column_summary_part", " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS ordinal, '{n}' AS column_name, '{t}' AS dtype, "
    f"count(DISTINCT {n}) AS n_distinct FROM part" for i, (n, t) in enumerate(SCHEMAS["part"])))
def q_column_summary_part(spark, sf_dir):
    return prof.column_summary(table(spark, sf_dir, "part"))


@register("top_values_documents", """
SELECT ordinal, column_name, CAST(rank AS INTEGER) AS rank, value, cnt FROM (
  SELECT ordinal, column_name, value, cnt,
         row_number() OVER (PARTITION BY ordinal ORDER BY cnt DESC, value) AS rank
  FROM (SELECT 1 AS ordinal, 'text' AS column_name, text AS value, count(*) AS cnt
          FROM documents GROUP BY text
        UNION ALL SELECT 2, 'lang', lang, count(*) FROM documents GROUP BY lang
        UNION ALL SELECT 3, 'source', source, count(*) FROM documents GROUP BY source))
WHERE rank <= 3""")
def q_top_values_documents(spark, sf_dir):
    return prof.top_values_long(table(spark, sf_dir, "documents"), 3)


@register("target_stats_lineitem", """
SELECT 'l_extendedprice' AS target, count(l_extendedprice) AS n,
       round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
       round(min(l_extendedprice), 4) AS min, round(max(l_extendedprice), 4) AS max
FROM lineitem""")
def q_target_stats_lineitem(spark, sf_dir):
    return prof.target_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> recipe -> exact split -> linear regression on l_extendedprice -> metrics."""
    from tabsmith.plans.run import run
    li = table(spark, sf_dir, "lineitem")
    return run(li, "l_extendedprice", ["l_orderkey", "l_linenumber"]).metrics


# ------------------------------------------------------- pruning (D) and target (T)

from tabsmith.operators import prune, target as tgt  # noqa: E402

ORDERS_DERIVED = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
                  "o_orderpriority, o_totalprice AS total_copy, 'web' AS channel, "
                  "CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority END AS rush_flag "
                  "FROM orders")
ORDERS_DERIVED_SCHEMA = SCHEMAS["orders"] + [("total_copy", "double"), ("channel", "string"),
                                             ("rush_flag", "string")]


def orders_derived(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("*", F.col("o_totalprice").alias("total_copy"), F.lit("web").alias("channel"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority"))
                     .alias("rush_flag"))


@register("drop_plan_orders", drop_plan_sql(ORDERS_DERIVED, ORDERS_DERIVED_SCHEMA, ["o_orderstatus"]))
def q_drop_plan_orders(spark, sf_dir):
    return prune.plan_drops(orders_derived(spark, sf_dir), ["o_orderstatus"])


LINEITEM_DUPS = ("SELECT *, l_quantity AS qty_copy, l_tax AS tax_copy, "
                 "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount END AS disc_gap, "
                 "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount END AS disc_gap2 FROM lineitem")
LINEITEM_DUPS_SCHEMA = SCHEMAS["lineitem"] + [("qty_copy", "double"), ("tax_copy", "double"),
                                              ("disc_gap", "double"), ("disc_gap2", "double")]


@register("duplicate_columns_lineitem", duplicates_sql(LINEITEM_DUPS, LINEITEM_DUPS_SCHEMA))
def q_duplicate_columns_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    gap = F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_discount"))
    df = li.select("*", F.col("l_quantity").alias("qty_copy"), F.col("l_tax").alias("tax_copy"),
                   gap.alias("disc_gap"), gap.alias("disc_gap2"))
    return prune.find_duplicate_columns(df)


def _task_sql(source, schema):
    p = profile_sql(source, schema)
    return (f"WITH p AS ({p}) SELECT column_name, CASE WHEN dtype NOT IN "
            "('tinyint','smallint','int','bigint','float','double') OR n_distinct <= 15 "
            "THEN 'Classification' ELSE 'Regression' END AS task FROM p")


@register("task_of_orders", _task_sql("SELECT * FROM orders", SCHEMAS["orders"]))
def q_task_of_orders(spark, sf_dir):
    return tgt.task_of(prof.profile(table(spark, sf_dir, "orders")))


@register("infer_problem_lineitem", "WITH p AS (" + profile_sql("SELECT * FROM lineitem", SCHEMAS["lineitem"])
          + ") SELECT column_name, CASE WHEN dtype NOT IN ('tinyint','smallint','int','bigint','float',"
          "'double') OR n_distinct <= 15 THEN 'classification' ELSE 'regression' END AS problem_type FROM p")
def q_infer_problem_lineitem(spark, sf_dir):
    return tgt.infer_problem(prof.profile(table(spark, sf_dir, "lineitem")))


@register("rank_targets_orders", "WITH p AS (" + profile_sql(ORDERS_DERIVED, ORDERS_DERIVED_SCHEMA)
          + "), w AS (SELECT ordinal, column_name, round(CASE WHEN flags <> '' THEN 0.0 ELSE "
          "0.5 + 0.3 * (1.0 - null_pct / 100.0) + 0.2 * CASE WHEN dtype IN ('tinyint','smallint',"
          "'int','bigint','float','double') THEN 1.0 ELSE 0.0 END END, 4) AS weight FROM p) "
          "SELECT CAST(row_number() OVER (ORDER BY weight DESC, ordinal) AS INTEGER) AS rank, column_name, weight FROM w")
def q_rank_targets_orders(spark, sf_dir):
    return tgt.rank_targets(prof.profile(orders_derived(spark, sf_dir)))


@register("rank_problem_types_orders", """
WITH s AS (SELECT CASE WHEN count(DISTINCT o_orderpriority) <= 2 THEN 0.9 ELSE 1.0 END AS c
           FROM orders)
SELECT CAST(row_number() OVER (ORDER BY suitability DESC, problem_type) AS INTEGER) AS rank, problem_type, suitability
FROM (SELECT 'Classification' AS problem_type, CAST(c AS DOUBLE) AS suitability FROM s
      UNION ALL SELECT 'Regression', CAST(round(1.0 - c, 4) AS DOUBLE) FROM s)""")
def q_rank_problem_types_orders(spark, sf_dir):
    return tgt.rank_problem_types(prof.profile(table(spark, sf_dir, "orders")), "o_orderpriority")


def _algo_sql(tab: str, task: str, n_features: int) -> str:
    vals = ", ".join(f"('{a}', '{t}', {b})" for a, t, b in tgt.ALGORITHMS)
    wide = "true" if n_features > 50 else "false"
    return f"""
WITH n AS (SELECT count(*) AS n_rows FROM {tab}),
c AS (SELECT * FROM (VALUES {vals}) AS v(algorithm, task, base) WHERE task = '{task}'),
s AS (SELECT algorithm, task, round(base
        + CASE WHEN n_rows < 1000 AND algorithm IN ('LinearRegression','LogisticRegression','LinearSVC')
               THEN 0.1 WHEN n_rows < 1000 AND algorithm LIKE 'GBT%' THEN -0.1 ELSE 0.0 END
        + CASE WHEN algorithm LIKE 'RandomForest%' AND {wide} THEN 0.05 ELSE 0.0 END, 4) AS suitability
      FROM c, n)
SELECT CAST(row_number() OVER (ORDER BY suitability DESC, algorithm) AS INTEGER) AS rank, algorithm, task,
       CAST(suitability AS DOUBLE) AS suitability FROM s"""


@register("rank_algorithms_lineitem", _algo_sql("lineitem", "Regression", 10))
def q_rank_algorithms_lineitem(spark, sf_dir):
    return tgt.rank_algorithms(table(spark, sf_dir, "lineitem"), "Regression")


@register("rank_algorithms_labels", _algo_sql("labels", "Classification", 2))
def q_rank_algorithms_labels(spark, sf_dir):
    return tgt.rank_algorithms(table(spark, sf_dir, "labels"), "Classification")


@register("task_from_algorithm", """
SELECT algorithm, CASE WHEN lower(algorithm) LIKE '%classifier%' OR lower(algorithm) LIKE '%classification%'
  OR lower(algorithm) LIKE '%logistic%' OR lower(algorithm) LIKE '%svc%' THEN 'Classification'
  ELSE 'Regression' END AS task
FROM (SELECT DISTINCT 'Pred' || event_type || 'Classifier' AS algorithm FROM events
      UNION SELECT DISTINCT source || 'Regressor' FROM documents
      UNION SELECT DISTINCT 'LogisticOn' || lang FROM documents)""")
def q_task_from_algorithm(spark, sf_dir):
    e, d = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    names = (e.select(F.concat(F.lit("Pred"), "event_type", F.lit("Classifier")).alias("algorithm"))
             .union(d.select(F.concat("source", F.lit("Regressor"))))
             .union(d.select(F.concat(F.lit("LogisticOn"), "lang"))).distinct())
    return names.select("algorithm", tgt.task_from_algorithm(F.col("algorithm")).alias("task"))


@register("drop_null_target_events", "SELECT * FROM (" + EVENTS_WITH_NULLS + ") WHERE value IS NOT NULL")
def q_drop_null_target_events(spark, sf_dir):
    return tgt.drop_null_target(events_with_nulls(spark, sf_dir), ["value"])


@register("cast_target_part", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS DOUBLE) AS p_size, "
          "p_retailprice FROM part")
def q_cast_target_part(spark, sf_dir):
    return tgt.cast_target(table(spark, sf_dir, "part"), "p_size")


# ------------------------------------------------------------- text cleaning (X)

from tabsmith import fixed  # noqa: E402
from tabsmith.functions import text as tx  # noqa: E402
from tabsmith.operators import text as txt  # noqa: E402

LINEITEM_TEXT = ("SELECT l_orderkey, l_linenumber, "
                 "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',000 kms' AS dist_txt, "
                 "CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || '%' AS disc_txt, "
                 "'$' || CAST(CAST(l_partkey AS BIGINT) AS VARCHAR) || '.' "
                 "|| CAST(l_linenumber AS VARCHAR) AS price_txt, "
                 "CASE WHEN l_linenumber = 1 THEN '$' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) "
                 "ELSE l_returnflag END AS half_txt, l_returnflag FROM lineitem")
FMT_COLS = ["dist_txt", "disc_txt", "price_txt", "half_txt", "l_returnflag"]


def lineitem_text(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    return li.select(
        "l_orderkey", "l_linenumber", F.concat(qty, F.lit(",000 kms")).alias("dist_txt"),
        F.concat(F.round(F.col("l_discount") * 100).cast("bigint").cast("string"), F.lit("%")).alias("disc_txt"),
        F.concat(F.lit("$"), F.col("l_partkey").cast("string"), F.lit("."),
                 F.col("l_linenumber").cast("string")).alias("price_txt"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("$"), qty))
         .otherwise(F.col("l_returnflag")).alias("half_txt"), "l_returnflag")


def _fmt_stats_sql(source, cols):
    pat = fixed.FORMATTED_PATTERN
    parts = [f"SELECT '{c}' AS column_name, count({c}) AS n_nonnull, "
             f"count(*) FILTER (WHERE {c} IS NOT NULL AND regexp_matches(trim({c}), '{pat}')) AS n_match, "
             f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST(regexp_replace({c}, '[^0-9.]', '', 'g') "
             f"AS DOUBLE) IS NULL) AS n_fail FROM src" for c in cols]
    return (f"WITH src AS ({source}), s AS ({' UNION ALL '.join(parts)}) "
            "SELECT *, (n_match / n_nonnull >= 0.5 AND n_fail / n_nonnull <= 0.5 AND n_nonnull > 0) "
            "AS converted FROM s")


@register("formatted_fit_lineitem", _fmt_stats_sql(LINEITEM_TEXT, FMT_COLS))
def q_formatted_fit_lineitem(spark, sf_dir):
    return txt.fit_formatted(lineitem_text(spark, sf_dir), FMT_COLS)


@register("formatted_apply_lineitem", f"""
WITH src AS ({LINEITEM_TEXT})
SELECT l_orderkey, l_linenumber,
  TRY_CAST(regexp_replace(dist_txt, '[^0-9.]', '', 'g') AS DOUBLE) AS dist_txt,
  TRY_CAST(regexp_replace(disc_txt, '[^0-9.]', '', 'g') AS DOUBLE) AS disc_txt,
  TRY_CAST(regexp_replace(price_txt, '[^0-9.]', '', 'g') AS DOUBLE) AS price_txt,
  half_txt, l_returnflag FROM src""")
def q_formatted_apply_lineitem(spark, sf_dir):
    df = lineitem_text(spark, sf_dir)
    plan = txt.fit_text(df, exclude=["l_returnflag"])
    return txt.apply_text(df, plan)


@register("truncate_words_documents", """
WITH w AS (SELECT avg(CASE WHEN trim(text) = '' THEN 0 ELSE len(string_split_regex(trim(text), '\\s+')) END) AS t,
                  avg(CASE WHEN trim(source) = '' THEN 0 ELSE len(string_split_regex(trim(source), '\\s+')) END) AS s
           FROM documents)
SELECT doc_id,
  CASE WHEN w.t > 3 THEN array_to_string(list_slice(string_split_regex(trim(text), '\\s+'), 1, 2), ' ') ELSE text END AS text,
  lang,
  CASE WHEN w.s > 3 THEN array_to_string(list_slice(string_split_regex(trim(source), '\\s+'), 1, 2), ' ') ELSE source END AS source,
  n_chars
FROM documents, w""")
def q_truncate_words_documents(spark, sf_dir):
    return txt.truncate_words(table(spark, sf_dir, "documents"), ["text", "source"])


ORDERS_BOOL = ("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' ELSE 'No' END AS is_urgent, "
               "CASE WHEN o_orderstatus = 'F' THEN ' Y' ELSE 'n' END AS filled, o_orderstatus FROM orders")


@register("boolean_words_orders", f"""
WITH src AS ({ORDERS_BOOL})
SELECT o_orderkey,
  CASE WHEN lower(trim(is_urgent)) IN ('yes','y') THEN 1 WHEN lower(trim(is_urgent)) IN ('no','n') THEN 0 END AS is_urgent,
  CASE WHEN lower(trim(filled)) IN ('yes','y') THEN 1 WHEN lower(trim(filled)) IN ('no','n') THEN 0 END AS filled,
  o_orderstatus FROM src""")
def q_boolean_words_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    df = o.select("o_orderkey",
                  F.when(F.col("o_orderpriority") == "1-URGENT", "Yes").otherwise("No").alias("is_urgent"),
                  F.when(F.col("o_orderstatus") == "F", " Y").otherwise("n").alias("filled"),
                  "o_orderstatus")
    return txt.map_boolean_words(df, ["is_urgent", "filled", "o_orderstatus"])


WS = "'^\\s+|\\s+$', '', 'g'"


@register("strip_code_fences_conversations", f"""
SELECT conv_id, turn,
  coalesce(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, {WS}),
    '^```[a-zA-Z0-9]*\\n', ''), '\\n```$', ''), {WS}), '') AS plain,
  coalesce(regexp_replace(regexp_replace(regexp_replace(regexp_replace('```' || role || chr(10) || text || chr(10) || '```', {WS}),
    '^```[a-zA-Z0-9]*\\n', ''), '\\n```$', ''), {WS}), '') AS fenced
FROM conversations""")
def q_strip_code_fences_conversations(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    fenced = F.concat(F.lit("```"), "role", F.lit("\n"), "text", F.lit("\n```"))
    return c.select("conv_id", "turn", tx.strip_code_fences(F.col("text")).alias("plain"),
                    tx.strip_code_fences(fenced).alias("fenced"))


@register("safe_name_pages", """
SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}_-]', '', 'g') AS safe_url FROM pages
UNION ALL SELECT doc_id, regexp_replace(source || ' ' || lang || '/é#', '[^\\p{L}\\p{N}_-]', '', 'g') FROM documents""")
def q_safe_name_pages(spark, sf_dir):
    p, d = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    return (p.select("page_id", tx.safe_name(F.col("url")).alias("safe_url"))
            .union(d.select("doc_id", tx.safe_name(F.concat_ws(" ", "source", F.concat("lang", F.lit("/é#")))))))


def conversation_lines(spark, sf_dir) -> DataFrame:
    """Conversations as a log table: one row per text line, whole texts."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


CONV_LINES = ("SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, s[i] AS line FROM "
              "(SELECT conv_id, turn, string_split(text, chr(10)) AS s FROM conversations), "
              "LATERAL (SELECT unnest(generate_series(1, len(s))) AS i)")


@register("clean_log_lines_conversations", f"""
WITH l AS ({CONV_LINES})
SELECT conv_id, turn, pos, regexp_replace(regexp_replace(regexp_replace(regexp_replace('[2026-06-20 18:27:05] - ' || line || ' :',
  '{fixed.LOG_TIMESTAMP_PATTERN}', '', 'g'), {WS}), '^[:\\-\\s]+|[:\\-\\s]+$', '', 'g'), {WS}) AS line
FROM l""")
def q_clean_log_lines_conversations(spark, sf_dir):
    l = conversation_lines(spark, sf_dir)
    raw = F.concat(F.lit("[2026-06-20 18:27:05] - "), "line", F.lit(" :"))
    return l.select("conv_id", "turn", "pos", tx.clean_log_line(raw).alias("line"))


# ------------------------------------------------------------------- dates (C)

from tabsmith.operators import dates as dt  # noqa: E402


@register("date_parts_orders", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
  CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month, CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_dayofweek
FROM orders""")
def q_date_parts_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return dt.date_parts(o, dt.find_dates(o))


ORDERS_DATES = ("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y/%m/%d') "
                "WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%m/%d/%Y') "
                "WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'n/a' "
                "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ship_date, "
                "o_orderpriority AS priority_time FROM orders")


@register("parse_dates_orders", f"""
WITH src AS ({ORDERS_DATES}),
p AS (SELECT o_orderkey, coalesce(try_strptime(ship_date, '%Y-%m-%d %H:%M:%S'), try_strptime(ship_date, '%Y-%m-%d'),
        try_strptime(ship_date, '%Y/%m/%d'), try_strptime(ship_date, '%m/%d/%Y')) AS d, priority_time FROM src)
SELECT o_orderkey, CAST(year(d) AS INTEGER) AS ship_date_year, CAST(month(d) AS INTEGER) AS ship_date_month,
  CAST(day(d) AS INTEGER) AS ship_date_day,
  CAST(isodow(d) - 1 AS INTEGER) AS ship_date_dayofweek, priority_time FROM p WHERE d IS NOT NULL""")
def q_parse_dates_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    d = o.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT",
                                      F.date_format("o_orderdate", "yyyy/MM/dd"))
                 .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "MM/dd/yyyy"))
                 .when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"), F.lit("n/a"))
                 .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("ship_date"),
                 F.col("o_orderpriority").alias("priority_time"))
    return dt.date_parts(d, dt.find_dates(d))


@register("date_share_orders", f"""
WITH src AS ({ORDERS_DATES})
SELECT 'ship_date' AS column_name, count(ship_date) AS n_nonnull,
  count(coalesce(try_strptime(ship_date, '%Y-%m-%d'), try_strptime(ship_date, '%Y/%m/%d'),
                 try_strptime(ship_date, '%m/%d/%Y'))) AS n_parsed FROM src
UNION ALL SELECT 'priority_time', count(priority_time), 0 FROM src""")
def q_date_share_orders(spark, sf_dir):
    d = (table(spark, sf_dir, "orders")
         .select(F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy/MM/dd"))
                 .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "MM/dd/yyyy"))
                 .when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"), F.lit("n/a"))
                 .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("ship_date"),
                 F.col("o_orderpriority").alias("priority_time")))
    return dt.parse_share(d, ["ship_date", "priority_time"])


# --------------------------------------------------------- fill (I), capping (O)

from tabsmith.operators import impute, outliers  # noqa: E402

LINEITEM_NULLS = ("SELECT l_orderkey, l_linenumber, "
                  "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS qty, "
                  "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS price, "
                  "CASE WHEN l_linenumber >= 6 THEN NULL ELSE l_returnflag END AS flag, "
                  "l_linestatus FROM lineitem")


def lineitem_nulls(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_quantity")).alias("qty"),
                     F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("l_extendedprice")).alias("price"),
                     F.when(F.col("l_linenumber") >= 6, None).otherwise(F.col("l_returnflag")).alias("flag"),
                     "l_linestatus")


def _fill_sql(source, num_cols, cat_cols, keep):
    nums = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN skewness({c}) > 1 THEN 'median' ELSE 'mean' END AS method, "
        f"round(CASE WHEN skewness({c}) > 1 THEN quantile_cont({c}, 0.5) ELSE avg({c}) END, 4) AS fill FROM src"
        for c in num_cols)
    return f"WITH src AS ({source}) SELECT column_name, method, fill FROM ({nums})"


def _fill_frame(plan: impute.FillPlan, spark) -> DataFrame:
    rows = [(c, m, round(float(v), 4) if v is not None else None) for c, (v, m) in plan.numeric.items()]
    return spark.createDataFrame(rows, "column_name string, method string, fill double")


@register("fill_values_events", _fill_sql(EVENTS_WITH_NULLS, ["value", "user_id", "event_id"], [], []))
def q_fill_values_events(spark, sf_dir):
    df = events_with_nulls(spark, sf_dir)
    return _fill_frame(impute.fit_numeric_fill(df, ["value", "user_id", "event_id"]), spark)


@register("fill_values_events_nan", _fill_sql(
    "SELECT CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS value, user_id FROM events", ["value", "user_id"], [], []))
def q_fill_values_events_nan(spark, sf_dir):
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(F.col("event_type") != "view", F.col("value"))
    df = table(spark, sf_dir, "events").select(value.alias("value"), "user_id")
    return _fill_frame(impute.fit_numeric_fill(df, ["value", "user_id"]), spark)


@register("fill_values_documents", _fill_sql(
    "SELECT doc_id, CASE WHEN lang = 'en' THEN NULL ELSE n_chars END AS n_chars FROM documents",
    ["n_chars", "doc_id"], [], []))
def q_fill_values_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    df = d.select("doc_id", F.when(F.col("lang") == "en", None).otherwise(F.col("n_chars")).alias("n_chars"))
    return _fill_frame(impute.fit_numeric_fill(df, ["n_chars", "doc_id"]), spark)


def _mode_sql(source, col):
    return (f"SELECT '{col}' AS column_name, coalesce((SELECT v FROM (SELECT {col} AS v, count(*) AS n FROM "
            f"({source}) WHERE {col} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1), 'Unknown') AS mode")


@register("mode_fill_lineitem", _mode_sql(LINEITEM_NULLS, "flag") + " UNION ALL "
          + _mode_sql(LINEITEM_NULLS, "l_linestatus") + " UNION ALL "
          + _mode_sql("SELECT CAST(NULL AS VARCHAR) AS empty_col", "empty_col"))
def q_mode_fill_lineitem(spark, sf_dir):
    df = lineitem_nulls(spark, sf_dir).withColumn("empty_col", F.lit(None).cast("string"))
    return impute.mode_table(df, ["flag", "l_linestatus", "empty_col"])


@register("fill_apply_lineitem", f"""
WITH src AS ({LINEITEM_NULLS}),
s AS (SELECT CASE WHEN skewness(qty) > 1 THEN median(qty) ELSE avg(qty) END AS fq,
             CASE WHEN skewness(price) > 1 THEN median(price) ELSE avg(price) END AS fp,
             CASE WHEN skewness(l_orderkey) > 1 THEN median(l_orderkey) ELSE avg(l_orderkey) END AS fo FROM src),
m AS (SELECT flag AS mf FROM src WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)
SELECT l_orderkey, l_linenumber, round(coalesce(qty, fq), 4) AS qty, round(coalesce(price, fp), 4) AS price,
       coalesce(flag, mf) AS flag, l_linestatus FROM src, s, m""")
def q_fill_apply_lineitem(spark, sf_dir):
    df = lineitem_nulls(spark, sf_dir)
    plan = impute.fit_fill(df)
    out = impute.apply_fill(df, plan)
    return out.select("l_orderkey", "l_linenumber", F.round("qty", 4).alias("qty"),
                      F.round("price", 4).alias("price"), "flag", "l_linestatus")


def _iqr_sql(source, cols):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, "
        f"count(DISTINCT {c}) AS nd FROM src" for c in cols)
    return (f"WITH src AS ({source}), q AS ({parts}) SELECT column_name, round(q1, 4) AS q1, round(q3, 4) AS q3, "
            "round(q1 - 1.5 * (q3 - q1), 4) AS lo, round(q3 + 1.5 * (q3 - q1), 4) AS hi FROM q "
            "WHERE nd > 2 AND q3 - q1 <> 0")


def _round_all(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


EVENTS_NUM = "SELECT event_id, user_id, value, CAST(value > 10 AS INTEGER) AS big FROM events"


@register("iqr_bounds_events", _iqr_sql(EVENTS_NUM, ["event_id", "user_id", "value", "big"]))
def q_iqr_bounds_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value",
                                             (F.col("value") > 10).cast("int").alias("big"))
    return _round_all(outliers.iqr_table(e, ["event_id", "user_id", "value", "big"]))


EVENTS_INF = ("SELECT CASE WHEN event_id % 100 = 0 THEN CAST('inf' AS DOUBLE) WHEN event_id % 100 = 1 THEN CAST('-inf' AS DOUBLE) "
              "WHEN event_id % 100 < 12 THEN NULL ELSE value END AS value FROM events")


@register("iqr_bounds_events_inf", _iqr_sql(EVENTS_INF, ["value"]))
def q_iqr_bounds_events_inf(spark, sf_dir):
    m = F.col("event_id") % 100
    value = (F.when(m == 0, F.lit(float("inf"))).when(m == 1, F.lit(float("-inf"))).when(m < 6, F.lit(float("nan")))
             .when(m >= 12, F.col("value")))
    return _round_all(outliers.iqr_table(table(spark, sf_dir, "events").select(value.alias("value")), ["value"]))


@register("iqr_bounds_lineitem", _iqr_sql("SELECT * FROM lineitem",
                                          ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def q_iqr_bounds_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return _round_all(outliers.iqr_table(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@register("clip_events", f"""
WITH src AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events),
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM src)
SELECT event_id, round(CASE WHEN value IS NULL THEN NULL ELSE greatest(least(value, q3 + 1.5 * (q3 - q1)),
       q1 - 1.5 * (q3 - q1)) END, 4) AS value FROM src, q""")
def q_clip_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", None).otherwise(F.col("value")).alias("value"))
    return _round_all(outliers.clip(e, outliers.fit_iqr(e, ["value"])))


# --------------------------------------------------------------- encoding (E)

from tabsmith.operators import encode as enc  # noqa: E402

STATUS = ("F", "O", "P")
PRIORITY = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register("one_hot_orders", "SELECT o_orderkey, o_totalprice, "
          + ", ".join(f"CAST(o_orderstatus IS NOT DISTINCT FROM '{v}' AS INTEGER) AS \"o_orderstatus_{v}\""
                      for v in STATUS) + ", "
          + ", ".join(f"CAST(o_orderpriority IS NOT DISTINCT FROM '{v}' AS INTEGER) AS \"o_orderpriority_{v}\""
                      for v in PRIORITY) + " FROM orders")
def q_one_hot_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return enc.one_hot(o, enc.fit_levels(o, ["o_orderstatus", "o_orderpriority"]))


@register("label_codes_part", """
SELECT 'p_name' AS column_name, p_name AS label, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT p_name FROM part)
UNION ALL
SELECT 'p_brand', p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) FROM (SELECT DISTINCT p_brand FROM part)""")
def q_label_codes_part(spark, sf_dir):
    return enc.label_codes(table(spark, sf_dir, "part"), ["p_name", "p_brand"])


@register("label_codes_customer", """
SELECT 'c_name' AS column_name, c_name AS label, CAST(row_number() OVER (ORDER BY c_name) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT c_name FROM customer)""")
def q_label_codes_customer(spark, sf_dir):
    return enc.label_codes(table(spark, sf_dir, "customer"), ["c_name"])


PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@register("encode_part", """
WITH n AS (SELECT p_name AS l, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS c FROM (SELECT DISTINCT p_name FROM part)),
b AS (SELECT p_brand AS l, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS c FROM (SELECT DISTINCT p_brand FROM part))
SELECT p_partkey, n.c AS p_name, b.c AS p_brand, p_size, p_retailprice, """
          + ", ".join(f"CAST(p_type IS NOT DISTINCT FROM '{v}' AS INTEGER) AS \"p_type_{v}\"" for v in PART_TYPES)
          + " FROM part JOIN n ON part.p_name = n.l JOIN b ON part.p_brand = b.l")
def q_encode_part(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    plan = enc.fit_encoding(p)
    return enc.apply_encoding(p, plan)


@register("encode_target_orders", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS BIGINT) AS o_orderstatus FROM orders""")
def q_encode_target_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return tgt.encode_target(o, "o_orderstatus")[0]


@register("decode_orders", """
WITH m AS (SELECT o_orderpriority AS label, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS code
           FROM (SELECT DISTINCT o_orderpriority FROM orders)),
e AS (SELECT o_orderkey, m.code AS y, (m.code + 1) % 6 + 0.7 AS p FROM orders JOIN m ON orders.o_orderpriority = m.label)
SELECT o_orderkey, coalesce(my.label, 'Unknown') AS y, coalesce(mp.label, 'Unknown') AS p
FROM e LEFT JOIN m my ON CAST(trunc(e.y) AS INTEGER) = my.code LEFT JOIN m mp ON CAST(trunc(e.p) AS INTEGER) = mp.code""")
def q_decode_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    coded, mapping, n = tgt.encode_target(o, "o_orderpriority")
    scored = coded.select("o_orderkey", F.col("o_orderpriority").alias("y"),
                          ((F.col("o_orderpriority") + 1) % 6 + 0.7).alias("p"))
    return enc.decode(scored, mapping, {"y": "o_orderpriority", "p": "o_orderpriority"},
                      counts={"o_orderpriority": n})


@register("bool_to_int_lineitem", "SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS returned, "
          "CAST(l_discount > 0.05 AS INTEGER) AS discounted FROM lineitem")
def q_bool_to_int_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                (F.col("l_returnflag") == "R").alias("returned"),
                                                (F.col("l_discount") > 0.05).alias("discounted"))
    return enc.bool_to_int(li)


# ------------------------------------------------ audit (V, A) and split (F)

from tabsmith.operators import audit as aud, split as spl  # noqa: E402


@register("contract_lineitem_nulls", f"""
WITH src AS ({LINEITEM_NULLS})
SELECT 'no_nulls' AS "check", sum(CASE WHEN qty IS NULL THEN 1 ELSE 0 END + CASE WHEN price IS NULL THEN 1 ELSE 0 END
  + CASE WHEN flag IS NULL THEN 1 ELSE 0 END) = 0 AS passed,
  CAST(sum(CASE WHEN qty IS NULL THEN 1 ELSE 0 END + CASE WHEN price IS NULL THEN 1 ELSE 0 END
  + CASE WHEN flag IS NULL THEN 1 ELSE 0 END) AS VARCHAR) AS detail FROM src
UNION ALL SELECT 'not_empty', count(*) > 0, CAST(count(*) AS VARCHAR) FROM src
UNION ALL SELECT 'all_numeric', false, 'flag,l_linestatus'
UNION ALL SELECT 'target_present', true, ''
UNION ALL SELECT 'target_numeric', true, ''""")
def q_contract_lineitem_nulls(spark, sf_dir):
    return aud.contract(lineitem_nulls(spark, sf_dir), ["price"])


@register("contract_lineitem_numeric", """
SELECT 'no_nulls' AS "check", true AS passed, '0' AS detail
UNION ALL SELECT 'not_empty', count(*) > 0, CAST(count(*) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'all_numeric', true, ''
UNION ALL SELECT 'target_present', false, 'missing_target'
UNION ALL SELECT 'target_numeric', true, ''""")
def q_contract_lineitem_numeric(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
    return aud.contract(li, ["l_extendedprice", "missing_target"])


@register("audit_flaws_lineitem", f"""
WITH src AS ({LINEITEM_NULLS})
SELECT * FROM (
  SELECT 'flag' AS column_name, 'text' AS flaw, CAST(NULL AS BIGINT) AS n
  UNION ALL SELECT 'l_linestatus', 'text', NULL
  UNION ALL SELECT 'qty', 'nulls', count(*) - count(qty) FROM src
  UNION ALL SELECT 'price', 'nulls', count(*) - count(price) FROM src
  UNION ALL SELECT 'flag', 'nulls', count(*) - count(flag) FROM src
  UNION ALL SELECT 'date_txt', 'nulls', count(*) FROM src
  UNION ALL SELECT 'date_txt', 'date', NULL) WHERE n IS NULL OR n > 0""")
def q_audit_flaws_lineitem(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem")
    clean = lineitem_nulls(spark, sf_dir).withColumn("date_txt", F.lit(None).cast("date"))
    return aud.audit(raw, clean)


@register("audit_passed_lineitem", f"SELECT count(*) = 0 AS passed, count(*) AS n_flaws FROM ({ORACLES['audit_flaws_lineitem']})")
def q_audit_passed_lineitem(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem")
    clean = lineitem_nulls(spark, sf_dir).withColumn("date_txt", F.lit(None).cast("date"))
    return aud.audit_passed(aud.audit(raw, clean))


@register("audit_passed_clean", """
WITH f AS (SELECT count(*) FILTER (WHERE l_quantity IS NULL) AS a, count(*) FILTER (WHERE l_extendedprice IS NULL) AS b
           FROM lineitem)
SELECT (CASE WHEN a > 0 THEN 1 ELSE 0 END + CASE WHEN b > 0 THEN 1 ELSE 0 END) = 0 AS passed,
       CAST(CASE WHEN a > 0 THEN 1 ELSE 0 END + CASE WHEN b > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_flaws FROM f""")
def q_audit_passed_clean(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    clean = li.select("l_quantity", "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("r"))
    return aud.audit_passed(aud.audit(li, clean))


@register("split_orders", """
WITH h AS (SELECT o_orderkey, md5('42|' || CAST(o_orderkey AS VARCHAR)) AS h FROM orders),
c AS (SELECT count(*) AS n FROM h)
SELECT o_orderkey, row_number() OVER (ORDER BY h) <= ceil(0.2 * n) AS is_test FROM h, c""")
def q_split_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return spl.split_flags(o, "o_orderkey")


@register("split_sizes_lineitem", """
WITH h AS (SELECT md5('42|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)) AS h FROM lineitem),
c AS (SELECT count(*) AS n FROM h),
r AS (SELECT row_number() OVER (ORDER BY h) <= ceil(0.2 * n) AS t FROM h, c)
SELECT count(*) FILTER (WHERE NOT t) AS n_train, count(*) FILTER (WHERE t) AS n_test FROM r""")
def q_split_sizes_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    flagged = spl.split_flags(li, ["l_orderkey", "l_linenumber"])
    return flagged.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"))


@register("split_repeated_keys", """
WITH h AS (SELECT l_orderkey, md5('42|' || l_orderkey) AS h, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey),
c AS (SELECT *, sum(n_rows) OVER (ORDER BY h) AS upto, CAST(ceil(0.2 * sum(n_rows) OVER ()) AS BIGINT) AS k FROM h)
SELECT l_orderkey, CAST(n_rows AS BIGINT) AS n_rows, CAST(greatest(0, least(n_rows, k - (upto - n_rows))) AS BIGINT) AS n_test FROM c""")
def q_split_repeated_keys(spark, sf_dir):
    flagged = spl.split_flags(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return flagged.groupBy("l_orderkey").agg(F.count("*").alias("n_rows"), F.count_if("is_test").alias("n_test"))


@register("split_tiny_statuses", "SELECT o_orderstatus, count(*) AS n, true AS is_test FROM orders GROUP BY o_orderstatus")
def q_split_tiny_statuses(spark, sf_dir):
    few = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))  # three rows
    return spl.split_flags(few, "o_orderstatus")


@register("split_tiny_region", "SELECT r_regionkey, r_name, true AS is_test FROM region WHERE false "
          "UNION ALL SELECT r_regionkey, r_name, CASE WHEN (SELECT count(*) FROM region) < 5 THEN true ELSE "
          "row_number() OVER (ORDER BY md5('42|' || CAST(r_regionkey AS VARCHAR))) <= ceil(0.2 * (SELECT count(*) FROM region)) END FROM region")
def q_split_tiny_region(spark, sf_dir):
    return spl.split_flags(table(spark, sf_dir, "region"), "r_regionkey")


@register("features_lineitem", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, "
          "l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def q_features_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(*spl.features(li, ["l_extendedprice"]))


@register("display_columns_lineitem", "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem")
def q_display_columns_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    shown = spl.display_columns(li.columns, ["l_extendedprice"])
    return li.select(*shown, "l_extendedprice")


# -------------------------------------------- metrics (K), limits (M3/M5), verdict (Q)

from tabsmith.operators import metrics as met, verdict as ver  # noqa: E402

DOC_LABELS = ("SELECT d.doc_id, l.quality, CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS pred "
              "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
ORDERS_PRED = ("SELECT o_orderkey, o_orderstatus AS y, CASE WHEN o_totalprice > 400000 THEN 'X' "
               "WHEN o_totalprice > 200000 THEN 'O' ELSE 'F' END AS p FROM orders")
LINEITEM_PRED = "SELECT l_extendedprice AS y, l_quantity * 950.0 + 1000.0 AS p FROM lineitem"
LINEITEM_BAD = "SELECT l_extendedprice AS y, 100000.0 - l_quantity * 500.0 AS p FROM lineitem"


def doc_labels(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.join(l, "doc_id").select("doc_id", "quality",
                                      F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("pred"))


def orders_pred(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.col("o_orderstatus").alias("y"),
                    F.when(F.col("o_totalprice") > 400000, "X").when(F.col("o_totalprice") > 200000, "O")
                     .otherwise("F").alias("p"))


def lineitem_pred(spark, sf_dir, bad=False):
    li = table(spark, sf_dir, "lineitem")
    p = (F.lit(100000.0) - F.col("l_quantity") * 500.0) if bad else (F.col("l_quantity") * 950.0 + 1000.0)
    return li.select(F.col("l_extendedprice").alias("y"), p.alias("p"))


def _cls_sql(source):
    return f"""
WITH src AS ({source}),
conf AS (SELECT y, p, count(*) AS n FROM src GROUP BY y, p),
s AS (SELECT y AS c, sum(n) AS support FROM conf GROUP BY y),
pr AS (SELECT p AS c, sum(n) AS predicted FROM conf GROUP BY p),
t AS (SELECT y AS c, n AS tp FROM conf WHERE y = p),
per AS (SELECT s.c, support, coalesce(predicted, 0) AS predicted, coalesce(tp, 0) AS tp FROM s
        LEFT JOIN pr ON s.c = pr.c LEFT JOIN t ON s.c = t.c),
m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pc, tp / support AS rc FROM per)
SELECT round(sum(tp) / sum(support), 4) AS accuracy, round(sum(pc * support) / sum(support), 4) AS precision,
  round(sum(rc * support) / sum(support), 4) AS recall,
  round(sum(CASE WHEN pc + rc > 0 THEN 2 * pc * rc / (pc + rc) ELSE 0.0 END * support) / sum(support), 4) AS f1,
  count(*) AS n_classes FROM m"""


def _reg_sql(source):
    return f"""
WITH src AS ({source}),
a AS (SELECT avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae, sum((y - p) * (y - p)) AS sse,
             var_pop(y) * count(y) AS sst FROM src)
SELECT round(mse, 4) AS mse, round(mae, 4) AS mae,
  round(CASE WHEN sst > 0 THEN 1 - sse / sst WHEN sse = 0 THEN 1.0 ELSE 0.0 END, 4) AS r2 FROM a"""


def _round4(df):
    return df.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register("classification_metrics_labels",
          _cls_sql(DOC_LABELS.replace("l.quality,", "l.quality AS y,").replace("AS pred", "AS p")))
def q_classification_metrics_labels(spark, sf_dir):
    return _round4(met.classification_metrics(doc_labels(spark, sf_dir), "quality", "pred"))


@register("classification_metrics_orders", _cls_sql(ORDERS_PRED))
def q_classification_metrics_orders(spark, sf_dir):
    return _round4(met.classification_metrics(orders_pred(spark, sf_dir), "y", "p"))


@register("regression_metrics_lineitem", _reg_sql(LINEITEM_PRED))
def q_regression_metrics_lineitem(spark, sf_dir):
    return _round4(met.regression_metrics(lineitem_pred(spark, sf_dir), "y", "p"))


@register("regression_metrics_negative_r2", _reg_sql(LINEITEM_BAD))
def q_regression_metrics_negative_r2(spark, sf_dir):
    return _round4(met.regression_metrics(lineitem_pred(spark, sf_dir, bad=True), "y", "p"))


@register("target_limits_lineitem", """
SELECT 'l_extendedprice' AS target, min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem
UNION ALL SELECT 'l_quantity', min(l_quantity), max(l_quantity) FROM lineitem""")
def q_target_limits_lineitem(spark, sf_dir):
    return met.target_limits(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"])


@register("clip_predictions_lineitem", """
WITH lim AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice,
  round(greatest(least(l_quantity * 2500.0 - 20000.0, hi), lo), 4) AS Pred_l_extendedprice,
  CAST(l_linenumber % 3 AS INTEGER) AS Pred_l_linenumber FROM lineitem, lim""")
def q_clip_predictions_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    lim = {r["target"]: (r["min"], r["max"]) for r in met.target_limits(li, ["l_extendedprice"]).collect()}
    scored = li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                       (F.col("l_quantity") * 2500.0 - 20000.0).alias("Pred_l_extendedprice"),
                       (F.col("l_linenumber") % 3).alias("Pred_l_linenumber"))
    out = met.clip_predictions(scored, lim, {"l_extendedprice": "Regression", "l_linenumber": "Classification"})
    return out.withColumn("Pred_l_extendedprice", F.round("Pred_l_extendedprice", 4))


def _metric_rows(spark, sf_dir):
    a = met.metrics_long(doc_labels(spark, sf_dir), "quality", "Classification", "pred")
    b = met.metrics_long(orders_pred(spark, sf_dir), "y", "Classification", "p")
    c = met.metrics_long(lineitem_pred(spark, sf_dir), "y", "Regression", "p").withColumn("target", F.lit("price"))
    d = met.metrics_long(lineitem_pred(spark, sf_dir, True), "y", "Regression", "p").withColumn(
        "target", F.lit("price_bad"))
    return a.unionByName(b).unionByName(c).unionByName(d)


def _metric_rows_sql():
    def cls_long(src, target):
        return (f"SELECT '{target}' AS target, 'Classification' AS task, n_classes, m.metric, m.value FROM "
                f"({_cls_sql(src)}) x, LATERAL (SELECT unnest(['accuracy','precision','recall','f1']) AS metric, "
                "unnest([accuracy, precision, recall, f1]) AS value) m")

    def reg_long(src, target):
        return (f"SELECT '{target}' AS target, 'Regression' AS task, CAST(NULL AS BIGINT) AS n_classes, m.metric, "
                f"m.value FROM ({_reg_sql(src)}) x, LATERAL (SELECT unnest(['mse','mae','r2']) AS metric, "
                "unnest([mse, mae, r2]) AS value) m")
    return " UNION ALL ".join([
        cls_long(DOC_LABELS.replace("l.quality,", "l.quality AS y,").replace("AS pred", "AS p"), "quality"),
        cls_long(ORDERS_PRED, "y"), reg_long(LINEITEM_PRED, "price"), reg_long(LINEITEM_BAD, "price_bad")])


@register("metric_rows", _metric_rows_sql())
def q_metric_rows(spark, sf_dir):
    return _metric_rows(spark, sf_dir)


VERDICT_SQL = f"""
WITH m AS ({_metric_rows_sql()}),
per AS (SELECT target, task, max(CASE WHEN metric = 'accuracy' THEN value END) AS acc,
          max(CASE WHEN metric = 'r2' THEN value END) AS r2, max(n_classes) AS k,
          string_agg(metric || '=' || printf('%.4f', value), ', ' ORDER BY metric) AS metrics
        FROM m GROUP BY target, task)
SELECT target, task, round(CASE WHEN task = 'Classification' THEN acc ELSE greatest(r2, 0.0) END, 4) AS rating,
  coalesce(CASE WHEN task = 'Classification' THEN acc >= CASE WHEN k <= 2 THEN 0.55 ELSE 0.45 END
           ELSE r2 > 0 END, false) AS passed, metrics FROM per"""


@register("verdict_targets", VERDICT_SQL)
def q_verdict_targets(spark, sf_dir):
    return ver.verdict(_metric_rows(spark, sf_dir)).withColumn("metrics", ver.metric_text(F.col("metrics")))


@register("verdict_overall", f"SELECT coalesce(bool_and(passed), false) AS sane, count(*) AS n_targets FROM ({VERDICT_SQL})")
def q_verdict_overall(spark, sf_dir):
    return ver.overall(ver.verdict(_metric_rows(spark, sf_dir)))


@register("prediction_checks_lineitem", """
WITH src AS (SELECT l_quantity * 950.0 + 1000.0 AS p FROM lineitem),
lim AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT min(p) < max(p) AS varies, count(*) FILTER (WHERE p < lo OR p > hi) AS n_outside,
  count(*) FILTER (WHERE p < lo OR p > hi) = 0 AS inside FROM src, lim""")
def q_prediction_checks_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    lim = met.target_limits(li, ["l_extendedprice"]).first()
    p = li.select((F.col("l_quantity") * 950.0 + 1000.0).alias("p"))
    return ver.prediction_checks(p, "p", lim["min"], lim["max"])


@register("scorecard_lineitem", f"""
WITH m AS ({_reg_sql(LINEITEM_PRED)}),
l AS (SELECT 0 AS g, 0 AS p, '{fixed.SCORECARD_START}' AS line
  UNION ALL SELECT 0, 1, '{fixed.SCORECARD_HEADER}'
  UNION ALL SELECT 0, 2, 'Task Strategy: Regression'
  UNION ALL SELECT 0, 3, 'Selected Framework: LinearRegression'
  UNION ALL SELECT 0, 4, 'Target Variables: ["y"]'
  UNION ALL SELECT 0, 5, ''
  UNION ALL SELECT 1, 0, 'Target: y (Regression)'
  UNION ALL SELECT 1, 5, 'Mean Squared Error (MSE): ' || printf('%.4f', mse) FROM m
  UNION ALL SELECT 1, 6, 'Mean Absolute Error (MAE): ' || printf('%.4f', mae) FROM m
  UNION ALL SELECT 1, 7, 'R-squared (R2) Score: ' || printf('%.4f', r2) FROM m
  UNION ALL SELECT 2, 0, '{fixed.SCORECARD_RULE}'
  UNION ALL SELECT 2, 1, '{fixed.SCORECARD_END}')
SELECT CAST(row_number() OVER (ORDER BY g, p) AS INTEGER) AS line_no, line FROM l""")
def q_scorecard_lineitem(spark, sf_dir):
    m = met.metrics_long(lineitem_pred(spark, sf_dir), "y", "Regression", "p")
    return met.scorecard_lines(m, "Regression", "LinearRegression", ["y"])


# ------------------------------------------- whole recipe (phases 1-9) and runs (M, K8, K9)

from tabsmith.plans import recipe as rcp  # noqa: E402
from tabsmith.plans.run import run as run_all  # noqa: E402

_ORD_FEATS = ["o_custkey", "o_orderdate_year", "o_orderdate_month", "o_orderdate_day", "o_orderdate_dayofweek"]


def _recipe_sql(tab, plain, date_col, feats, target, onehots):
    """The nine phases in SQL for a table without nulls or formatted text: date parts,
    IQR capping of non-binary numeric features, one-hot text, target as double."""
    parts = (f"year({date_col}) AS {date_col}_year, month({date_col}) AS {date_col}_month, "
             f"day({date_col}) AS {date_col}_day, isodow({date_col}) - 1 AS {date_col}_dayofweek")
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}, "
                   f"count(DISTINCT {c}) AS nd_{c}" for c in feats)
    clipped = ", ".join(
        f"CASE WHEN q3_{c} - q1_{c} = 0 OR nd_{c} <= 2 THEN CAST({c} AS DOUBLE) ELSE greatest(least(CAST({c} AS DOUBLE), "
        f"q3_{c} + 1.5 * (q3_{c} - q1_{c})), q1_{c} - 1.5 * (q3_{c} - q1_{c})) END AS {c}" for c in feats)
    dummies = ", ".join(f"CAST({c} = '{v}' AS INTEGER) AS \"{c}_{v}\"" for c, vals in onehots for v in vals)
    keep = ", ".join(plain + [c for c, _ in onehots])
    return f"""
WITH p AS (SELECT {keep}, CAST({target} AS DOUBLE) AS {target}, {parts}
           FROM {tab} WHERE {target} IS NOT NULL AND {date_col} IS NOT NULL),
q AS (SELECT {qs} FROM p)
SELECT {clipped}, {target}, {dummies} FROM p, q"""


def _clean_orders_sql():
    return _recipe_sql("orders", ["o_custkey"], "o_orderdate", _ORD_FEATS, "o_totalprice",
                      [("o_orderstatus", STATUS), ("o_orderpriority", PRIORITY)])


_LI_PLAIN = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"]
_LI_FEATS = _LI_PLAIN + ["l_shipdate_year", "l_shipdate_month", "l_shipdate_day", "l_shipdate_dayofweek"]


@register("clean_orders", _clean_orders_sql())
def q_clean_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    out, _ = rcp.clean(o, "o_totalprice")
    return out


@register("clean_lineitem_rows", _recipe_sql("lineitem", _LI_PLAIN, "l_shipdate", _LI_FEATS, "l_extendedprice",
                                            [("l_returnflag", ("A", "N", "R")), ("l_linestatus", ("F", "O"))]))
def q_clean_lineitem_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out, _ = rcp.clean(li, ["l_extendedprice"])
    return out


def documents_labelled(spark, sf_dir) -> DataFrame:
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.join(l, "doc_id")


@register("recipe_mappings_documents", """
WITH j AS (SELECT d.text, d.source FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
w AS (SELECT avg(CASE WHEN trim(text) = '' THEN 0 ELSE len(string_split_regex(trim(text), '\\s+')) END) AS tw,
             avg(CASE WHEN trim(source) = '' THEN 0 ELSE len(string_split_regex(trim(source), '\\s+')) END) AS sw FROM j),
t AS (SELECT CASE WHEN tw > 3 THEN array_to_string(list_slice(string_split_regex(trim(text), '\\s+'), 1, 2), ' ')
             ELSE text END AS text,
             CASE WHEN sw > 3 THEN array_to_string(list_slice(string_split_regex(trim(source), '\\s+'), 1, 2), ' ')
             ELSE source END AS source FROM j, w),
n AS (SELECT count(DISTINCT text) AS nt, count(DISTINCT source) AS ns FROM t)
SELECT 'text' AS column_name, text AS label, CAST(dense_rank() OVER (ORDER BY text) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT text FROM t) WHERE (SELECT nt FROM n) > 15
UNION ALL
SELECT 'source', source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER)
FROM (SELECT DISTINCT source FROM t) WHERE (SELECT ns FROM n) > 15""")
def q_recipe_mappings_documents(spark, sf_dir):
    r = rcp.fit(documents_labelled(spark, sf_dir), rcp.Config(targets=("quality",)))
    return r.mappings


@register("run_metrics_lineitem")
def q_run_metrics_lineitem(spark, sf_dir):
    return flagship(spark, sf_dir)


@register("run_scorecard_documents")
def q_run_scorecard_documents(spark, sf_dir):
    res = run_all(documents_labelled(spark, sf_dir), ["quality", "toxic"], "doc_id",
                  algorithm="RandomForestClassifier")
    return res.scorecard


@register("run_predictions_orders")
def q_run_predictions_orders(spark, sf_dir):
    res = run_all(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderkey",
                  algorithm="XGBoostClassifier")
    return res.predictions


# ------------------------------------------------------------ log tables (L)

from tabsmith.operators import logs as lg  # noqa: E402

BLOCK = [
    "[2026-06-20 18:27:05] INFO - Model trained and saved to model.joblib",
    fixed.SCORECARD_START, fixed.SCORECARD_HEADER, "Task Strategy: Regression",
    "Selected Framework: LinearRegression", 'Target Variables: ["chars"]', "",
    "Target: chars (Regression)", None, fixed.SCORECARD_RULE, fixed.SCORECARD_END, "Done.",
]


def run_logs(spark, sf_dir) -> DataFrame:
    """A log table Spark derives from conversations: every line of every turn, and for
    conversations of six or more turns a scorecard block whose metric is the run's own
    mean turn length."""
    c = table(spark, sf_dir, "conversations")
    lines = c.select(F.col("conv_id").alias("run_id"), "turn",
                     F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("run_id", (F.col("turn") * 1_000_000 + F.col("pos")).alias("line_no"), "line")
    per = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.avg(F.length("text")).alias("m"))
    metric = F.format_string("Mean Absolute Error (MAE): %.4f", F.col("m"))
    block = F.array(*[metric if b is None else F.lit(b) for b in BLOCK])
    blocks = (per.filter(F.col("turns") >= 6)
              .select(F.col("conv_id").alias("run_id"), F.posexplode(block).alias("k", "line"))
              .select("run_id", (F.lit(100_000_000) + F.col("k")).cast("bigint").alias("line_no"), "line"))
    return lines.unionByName(blocks)


def _run_logs_sql():
    vals = []
    for k, b in enumerate(BLOCK):
        text = "'Mean Absolute Error (MAE): ' || printf('%.4f', m)" if b is None else "'" + b.replace("'", "''") + "'"
        vals.append(f"SELECT conv_id AS run_id, CAST({100_000_000 + k} AS BIGINT) AS line_no, {text} AS line FROM per "
                    "WHERE turns >= 6")
    return f"""
per AS (SELECT conv_id, count(*) AS turns, avg(length(text)) AS m FROM conversations GROUP BY conv_id),
raw AS (SELECT conv_id AS run_id, turn * 1000000 + (i - 1) AS line_no, s[i] AS line FROM
          (SELECT conv_id, turn, string_split(text, chr(10)) AS s FROM conversations),
          LATERAL (SELECT unnest(generate_series(1, len(s))) AS i)
        UNION ALL {' UNION ALL '.join(vals)})"""


def _clean_sql(x):
    ws = "'^\\s+|\\s+$', '', 'g'"
    return (f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '{fixed.LOG_TIMESTAMP_PATTERN}', '', 'g'), "
            f"{ws}), '^[:\\-\\s]+|[:\\-\\s]+$', '', 'g'), {ws})")


def _logs_sql(final: str) -> str:
    kw = " OR ".join(f"contains(lower(line), '{k}')" for k in fixed.SCORECARD_KEYWORDS)
    wr = " OR ".join(f"contains(lower(line), '{k}')" for k in fixed.SCORECARD_WRAPPER_WORDS)
    return f"""
WITH {_run_logs_sql().strip()},
cl AS (SELECT * FROM (SELECT run_id, line_no, {_clean_sql('line')} AS line FROM raw) WHERE line <> ''),
h AS (SELECT run_id, min(line_no) AS h FROM cl WHERE contains(line, '{fixed.SCORECARD_START}')
      OR contains(line, '{fixed.SCORECARD_HEADER}') GROUP BY run_id),
win AS (SELECT * FROM (SELECT cl.run_id, cl.line_no, cl.line,
        row_number() OVER (PARTITION BY cl.run_id ORDER BY cl.line_no) AS idx
        FROM cl JOIN h ON cl.run_id = h.run_id AND cl.line_no >= h.h) WHERE idx <= 100),
k AS (SELECT *, ({kw}) AND NOT ({wr}) AS kept FROM win),
kc AS (SELECT *, sum(CASE WHEN kept THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY idx) AS kcum FROM k),
st AS (SELECT run_id, min(idx) AS stop FROM kc WHERE contains(line, '{fixed.SCORECARD_END}')
       OR (contains(line, '{fixed.SCORECARD_RULE}') AND kcum > 1) GROUP BY run_id),
l2 AS (SELECT kc.run_id, kc.line_no, kc.line FROM kc LEFT JOIN st ON kc.run_id = st.run_id
       WHERE kept AND (stop IS NULL OR idx <= stop)),
l3 AS (SELECT run_id, line_no, line FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY line_no DESC) AS rd
       FROM cl WHERE run_id NOT IN (SELECT run_id FROM l2)) WHERE rd <= 15),
l4 AS (SELECT run_id, arg_min(line, line_no) AS line, min(line_no) AS line_no FROM cl
       WHERE contains(lower(line), '{fixed.STATUS_LINE_WORDS}') GROUP BY run_id)
{final}"""


@register("log_block_markers", f"""
WITH {_run_logs_sql().strip()},
pos AS (SELECT run_id, min(line_no) FILTER (WHERE contains(line, '{fixed.SCORECARD_START}')) AS s,
               min(line_no) FILTER (WHERE contains(line, '{fixed.SCORECARD_END}')) AS e FROM raw GROUP BY run_id)
SELECT raw.run_id, raw.line_no, raw.line FROM raw JOIN pos ON raw.run_id = pos.run_id
WHERE s IS NULL OR e IS NULL OR (line_no >= s AND line_no <= e)""")
def q_log_block_markers(spark, sf_dir):
    return lg.between_markers(run_logs(spark, sf_dir))


@register("log_scorecard_lines", _logs_sql("SELECT * FROM l2"))
def q_log_scorecard_lines(spark, sf_dir):
    return lg.scorecard_lines(lg.clean_lines(run_logs(spark, sf_dir)))


@register("log_fallback_lines", _logs_sql("SELECT * FROM l3"))
def q_log_fallback_lines(spark, sf_dir):
    clean = lg.clean_lines(run_logs(spark, sf_dir))
    return lg.fallback_lines(clean, lg.scorecard_lines(clean))


@register("log_status_lines", _logs_sql("SELECT run_id, line, line_no FROM l4"))
def q_log_status_lines(spark, sf_dir):
    return lg.status_line(lg.clean_lines(run_logs(spark, sf_dir)))


@register("log_snippets", _logs_sql("""
, parts AS (SELECT run_id, 0 AS g, line_no, line FROM l4 UNION ALL SELECT run_id, 1, line_no, line FROM l2
            UNION ALL SELECT run_id, 1, line_no, line FROM l3)
SELECT run_id, string_agg(line, chr(10) ORDER BY g, line_no) AS snippet FROM parts GROUP BY run_id""").replace(
    "\n\n, parts AS", ", parts AS"))
def q_log_snippets(spark, sf_dir):
    return lg.snippet(run_logs(spark, sf_dir))


# ------------------------------------------------------- sources and sinks (S)

from tabsmith import sources as src  # noqa: E402
from tabsmith.operators import models as mdl, sample as smp  # noqa: E402


@register("discover_tables", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS name, '.parquet' AS suffix, true AS readable, count(*) AS n_rows FROM {t}" for t in sorted(SCHEMAS) + ["embeddings"]))
def q_discover_tables(spark, sf_dir):
    return src.table_sizes(spark, src.discover(spark, sf_dir)).select("name", "suffix", "readable", "n_rows")


@register("peek_columns_lineitem", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, (n, _) in enumerate(SCHEMAS["lineitem"])) + ") AS v(ordinal, column_name)")
def q_peek_columns_lineitem(spark, sf_dir):
    cols = src.peek_columns(spark, f"{sf_dir}/lineitem.parquet")
    rows = spark.createDataFrame(list(enumerate(cols)), "ordinal int, column_name string")
    return rows


ORDERS_CSV_SQL = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS o_custkey,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus = 'F' AS is_final FROM orders"""


def orders_csv_roundtrip(spark, sf_dir) -> DataFrame:
    """S6 then S2: a CSV derived from orders (with NA tokens) is written and read back."""
    o = table(spark, sf_dir, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NA")).otherwise(F.col("o_custkey").cast("string"))
         .alias("o_custkey"),
        F.when(F.col("o_orderstatus") == "P", F.lit("null")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.when(F.col("o_orderstatus") == "F", "True").otherwise("False").alias("is_final"))
    path = src.scratch_path(spark, "orders-csv")
    src.write_table(text, path, "csv")
    return src.read_table(spark, path, "csv")


@register("read_csv_orders", ORDERS_CSV_SQL)
def q_read_csv_orders(spark, sf_dir):
    return orders_csv_roundtrip(spark, sf_dir)


@register("read_csv_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_read_csv_documents(spark, sf_dir):
    path = src.scratch_path(spark, "documents-csv")
    src.write_table(table(spark, sf_dir, "documents"), path, "csv")
    return src.read_table(spark, path, "csv")


@register("read_csv_split_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_read_csv_split_documents(spark, sf_dir):
    path = src.scratch_path(spark, "documents-csv")
    src.write_table(table(spark, sf_dir, "documents"), path, "csv")
    return src.read_table(spark, path, "csv", split=True)


@register("window_sample_orders", """
WITH w AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM w
ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)) LIMIT 10""")
def q_window_sample_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderpriority")
    return smp.window_sample(o, "o_orderkey")


@register("head_rows_part", """
SELECT 0 AS line_no, 'p_partkey|p_name|p_brand|p_type|p_size|p_retailprice' AS line
UNION ALL SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER), concat_ws('|', CAST(p_partkey AS VARCHAR),
  p_name, p_brand, p_type, CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR))
FROM (SELECT * FROM part ORDER BY p_partkey LIMIT 3)""")
def q_head_rows_part(spark, sf_dir):
    return smp.head_rows(table(spark, sf_dir, "part"), 3, "p_partkey", "|")


@register("pool_accounts", """
SELECT c_custkey AS acct, c_name AS name, c_acctbal AS balance, CAST(NULL AS INTEGER) AS nation, 'customer' AS source
FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, s_nationkey, 'supplier' FROM supplier""")
def q_pool_accounts(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("acct"), F.col("c_name").alias("name"),
                                                F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("acct"), F.col("s_name").alias("name"),
                                                F.col("s_acctbal").alias("balance"),
                                                F.col("s_nationkey").alias("nation"))
    return src.pool([c, s], ["customer", "supplier"])


@register("pool_files", """
SELECT r_regionkey AS k, r_name AS name, 'region.parquet' AS source FROM region
UNION ALL SELECT n_nationkey, n_name, 'nation.parquet' FROM nation""")
def q_pool_files(spark, sf_dir):
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"),
                                              "_metadata")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"),
                                              "_metadata")
    return src.pool([r, n]).drop("_metadata")


@register("pool_mixed_types", """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_totalprice AS DOUBLE) AS amount, CAST(o_orderstatus AS VARCHAR) AS code, o_orderpriority AS note, 'orders' AS source
FROM orders
UNION ALL SELECT p_partkey, p_size, CAST(p_size AS VARCHAR), NULL, 'part' FROM part
UNION ALL SELECT n_nationkey, NULL, CASE WHEN n_regionkey = 1 THEN 'true' ELSE 'false' END, NULL, 'nation' FROM nation""")
def q_pool_mixed_types(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("id"), F.col("o_totalprice").alias("amount"),
                                              F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("note"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("id"), F.col("p_size").cast("int").alias("amount"),
                                            F.col("p_size").cast("int").alias("code"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("smallint").alias("id"), F.lit(None).alias("amount"),
                                              (F.col("n_regionkey") == 1).alias("code"))
    return src.pool([o, p, n], ["orders", "part", "nation"])


@register("mappings_roundtrip_part", """
SELECT 'p_name' AS column_name, p_name AS label, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT p_name FROM part)""")
def q_mappings_roundtrip_part(spark, sf_dir):
    m = enc.label_codes(table(spark, sf_dir, "part"), ["p_name"])
    path = src.scratch_path(spark, "mappings")
    src.write_mappings(m, path)
    return src.read_mappings(spark, path)


@register("run_record_lineitem")
def q_run_record_lineitem(spark, sf_dir):
    from tabsmith.plans.run import run, run_record
    res = run(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_orderkey", "l_linenumber"])
    path = src.write_run_record(spark, run_record(res), src.scratch_path(spark, "record"))
    return spark.read.text(path)


@register("run_record_facts_orders", f"""
SELECT 'dropped' AS fact, column_name AS name, reasons AS value
FROM ({drop_plan_sql(ORDERS_DERIVED, ORDERS_DERIVED_SCHEMA, ["o_totalprice"])})
UNION ALL SELECT 'task', 'o_totalprice', 'Regression'
UNION ALL SELECT 'metric', m, 'Regression' FROM (VALUES ('mse'), ('mae'), ('r2')) t(m)""")
def q_run_record_facts_orders(spark, sf_dir):
    """What a run's record tells after it was written and read back: dropped columns, tasks, metrics."""
    from tabsmith.plans.run import run, run_record
    res = run(orders_derived(spark, sf_dir), "o_totalprice", "o_orderkey", allow_flaws=True, protect_text=True)
    path = src.write_run_record(spark, run_record(res), src.scratch_path(spark, "facts"))
    schema = ("dropped map<string,string>, tasks map<string,string>, "
              "metrics array<struct<target:string,task:string,metric:string>>")
    rec = spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")
    facts = [rec.select(F.lit(fact).alias("fact"), F.explode(c).alias("name", "value")) for fact, c in (("dropped", "dropped"), ("task", "tasks"))]
    scores = rec.select(F.explode("metrics").alias("m")).select(F.lit("metric").alias("fact"), F.col("m.metric").alias("name"), F.col("m.task").alias("value"))
    return facts[0].unionByName(facts[1]).unionByName(scores)


@register("models_roundtrip_documents")
def q_models_roundtrip_documents(spark, sf_dir):
    from tabsmith.plans.run import run
    res = run(documents_labelled(spark, sf_dir), ["quality"], "doc_id", algorithm="DecisionTreeClassifier")
    path = src.scratch_path(spark, "models")
    mdl.save_models(res.trained, path)
    loaded = mdl.load_models(spark, path)
    return mdl.predict(loaded, res.test)


@register("models_roundtrip_equal_documents", """
SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_rows, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_equal
FROM documents JOIN labels USING (doc_id)""")
def q_models_roundtrip_equal_documents(spark, sf_dir):
    """Test rows, and those for which a saved and loaded model predicts what the trained one did."""
    from tabsmith.plans.run import run
    res = run(documents_labelled(spark, sf_dir), ["quality"], "doc_id", algorithm="DecisionTreeClassifier")
    path = src.scratch_path(spark, "models")
    mdl.save_models(res.trained, path)
    again = mdl.predict(mdl.load_models(spark, path), res.scored.withColumnRenamed("Pred_quality", "first_pred"))
    return again.agg(F.count("*").alias("n_rows"), F.count_if(F.col("first_pred") == F.col("Pred_quality")).alias("n_equal"))


@register("run_truth_orders", """
WITH h AS (SELECT o_orderstatus, row_number() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR))) AS r,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderstatus, count(*) AS n_rows, true AS known FROM h WHERE r <= ceil(0.2 * n) GROUP BY 1""")
def q_run_truth_orders(spark, sf_dir):
    """Decoded truth of the prediction table over the exact test split; predictions are decoded labels too."""
    res = run_all(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderkey", algorithm="DecisionTreeClassifier")
    known = F.bool_and(F.col("Pred_o_orderstatus").isin("F", "O", "P"))
    return res.predictions.groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), known.alias("known"))


@register("linear_fit_lineitem", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
SELECT l_quantity, count(*) AS n, round(a * l_quantity + b, 3) AS pred FROM lineitem, f GROUP BY l_quantity, a, b""")
def q_linear_fit_lineitem(spark, sf_dir):
    """One-feature linear regression on all rows against its closed form."""
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    tm = mdl.train(li, ["l_extendedprice"], "LinearRegression", {"l_extendedprice": "Regression"})
    out = mdl.predict(tm, li, clip=False)
    return out.groupBy("l_quantity").agg(F.count("*").alias("n"), F.round(F.max("Pred_l_extendedprice"), 3).alias("pred"))


@register("linear_fit_two_targets_lineitem", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b,
                  regr_slope(l_tax, l_quantity) AS c, regr_intercept(l_tax, l_quantity) AS d FROM lineitem)
SELECT l_quantity, count(*) AS n, round(a * l_quantity + b, 3) AS price, round(c * l_quantity + d, 6) AS tax
FROM lineitem, f GROUP BY l_quantity, a, b, c, d""")
def q_linear_fit_two_targets_lineitem(spark, sf_dir):
    """Two linear targets solved from one pass, against their closed forms."""
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_tax")
    targets = ["l_extendedprice", "l_tax"]
    tm = mdl.train(li, targets, "LinearRegression", dict.fromkeys(targets, "Regression"))
    out = mdl.predict(tm, li, clip=False)
    return out.groupBy("l_quantity").agg(F.count("*").alias("n"), F.round(F.max("Pred_l_extendedprice"), 3).alias("price"),
                                         F.round(F.max("Pred_l_tax"), 6).alias("tax"))


@register("class_digits_part", """
WITH c AS (SELECT p_retailprice AS value, dense_rank() OVER (ORDER BY p_retailprice) - 1 AS code
           FROM (SELECT DISTINCT p_retailprice FROM part)),
k AS (SELECT count(*) AS n FROM c),
d AS (SELECT min(j) AS digits FROM range(1, 9) t(j), k WHERE pow(256, j) >= n),
b AS (SELECT min(i) AS base FROM range(2, 257) t(i), k, d WHERE pow(i, digits) >= n)
SELECT value, CAST(code AS BIGINT) AS code, CAST(digits AS INTEGER) AS digits,
       CAST(code // CAST(pow(base, digits - 1) AS BIGINT) AS BIGINT) AS first_digit, CAST(code % base AS BIGINT) AS last_digit
FROM c, d, b""")
def q_class_digits_part(spark, sf_dir):
    """Class codes of a target with many values, and the first and last of their digits."""
    codes, n = mdl.class_codes(table(spark, sf_dir, "part"), "p_retailprice")
    digits, base = mdl.digit_base(n)
    places = mdl.code_digits(F.col("code"), digits, base)
    return codes.select("value", "code", F.lit(digits).alias("digits"), places[0].alias("first_digit"), places[-1].alias("last_digit"))


@register("run_many_classes_customer", """
SELECT 'Classification' AS task, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_rows, true AS known, true AS digit_chain FROM customer""")
def q_run_many_classes_customer(spark, sf_dir):
    """A run on a text target of many labels: codes are learned in digits, every prediction is a label of the table."""
    from tabsmith.plans.run import run
    c = table(spark, sf_dir, "customer")
    res = run(c, "c_name", "c_custkey", algorithm="DecisionTreeClassifier", max_classes=100, allow_flaws=True)
    names = c.select(F.col("c_name").alias("Pred_c_name"), F.lit(True).alias("known")).distinct()
    chain = isinstance(res.trained.models["c_name"], mdl.ClassChain)
    return res.predictions.join(names, "Pred_c_name", "left").agg(
        F.lit(res.trained.tasks["c_name"]).alias("task"), F.count("*").alias("n_rows"),
        F.bool_and(F.coalesce("known", F.lit(False))).alias("known"), F.lit(chain).alias("digit_chain"))


@register("mappings_document_part", """
WITH l AS (SELECT 'p_name' AS column_name, p_name AS label FROM part UNION SELECT 'p_type', p_type FROM part),
c AS (SELECT column_name, label, row_number() OVER (PARTITION BY column_name ORDER BY label) - 1 AS code,
             row_number() OVER (ORDER BY column_name DESC, label DESC) AS back FROM l)
SELECT (CASE WHEN code > 0 THEN ',' WHEN column_name = 'p_name' THEN '{"p_name":{' ELSE '},"p_type":{' END)
       || CAST(to_json(label) AS VARCHAR) || ':' || code || (CASE WHEN back = 1 THEN '}}' ELSE '' END) AS line
FROM c""")
def q_mappings_document_part(spark, sf_dir):
    """The nested mapping document, written in range partitions and read back as its lines."""
    m = enc.label_codes(table(spark, sf_dir, "part"), ["p_name", "p_type"])
    path = src.write_mappings_document(m, src.scratch_path(spark, "document"))
    return spark.read.text(path).withColumnRenamed("value", "line")


# ---------------------------------------------- audit statistics (P10), clean report (V6)


def _audit_stats_sql():
    before = profile_sql("SELECT * FROM orders", SCHEMAS["orders"])
    after_schema = [("o_custkey", "double"), ("o_totalprice", "double"), ("o_orderdate_year", "double"),
                    ("o_orderdate_month", "double"), ("o_orderdate_day", "double"),
                    ("o_orderdate_dayofweek", "double")] + \
        [(f"o_orderstatus_{v}", "int") for v in STATUS] + [(f"o_orderpriority_{v}", "int") for v in PRIORITY]
    after = profile_sql(f"SELECT * FROM ({_clean_orders_sql()})", after_schema)
    cols = ["dtype", "n_rows", "null_pct", "n_distinct"]
    sel_b = ", ".join(f"b.{c} AS {c}_before" for c in cols)
    sel_a = ", ".join(f"a.{c} AS {c}_after" for c in cols)
    return (f"WITH b AS ({before}), a AS ({after}) SELECT coalesce(b.column_name, a.column_name) AS column_name, "
            f"{sel_b}, {sel_a} FROM b FULL OUTER JOIN a ON b.column_name = a.column_name")


@register("audit_stats_orders", _audit_stats_sql())
def q_audit_stats_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    clean, _ = rcp.clean(o, "o_totalprice")
    clean = clean.select(*[F.col(f"`{c}`").cast("double").alias(c) if c.startswith("o_orderdate") or c == "o_custkey"
                           else F.col(f"`{c}`") for c in clean.columns])
    return prof.audit_stats(o, clean)


@register("clean_report_orders", """
WITH s AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS nk, count(DISTINCT o_totalprice) AS nt,
                  count(DISTINCT o_orderstatus) AS ns, count(DISTINCT o_orderpriority) AS np FROM orders)
SELECT 'original_shape' AS item, CAST(n AS VARCHAR) || ' x 6' AS value FROM s
UNION ALL SELECT 'cleaned_shape', CAST(n AS VARCHAR) || ' x ' || CAST(2 + 4 + ns + np AS VARCHAR) FROM s
UNION ALL SELECT 'target:o_totalprice', CASE WHEN nt <= 15 THEN 'Classification' ELSE 'Regression' END FROM s
UNION ALL SELECT 'dropped:o_orderkey', 'id' FROM s WHERE nk = n
UNION ALL SELECT 'encoding:o_orderpriority', CASE WHEN np <= 15 THEN 'one_hot' ELSE 'label' END FROM s
UNION ALL SELECT 'encoding:o_orderstatus', CASE WHEN ns <= 15 THEN 'one_hot' ELSE 'label' END FROM s""")
def q_clean_report_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    r = rcp.fit(o, rcp.Config(targets=("o_totalprice",)))
    return aud.clean_report(o, r.transform(o), ["o_totalprice"], r.tasks, r.drops, r.encodings())


# --------------------------------- CSV source through the whole recipe (S6 + S2 + phases 1-9)


def orders_csv_raw(spark, sf_dir) -> DataFrame:
    """A CSV Spark derives from orders, written and read back as text with typing:
    formatted amounts, NA tokens, text dates, yes/no words and a text target."""
    o = table(spark, sf_dir, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"), F.lit("NA"))
         .otherwise(F.col("o_custkey").cast("string")).alias("cust_no"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("amount"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Yes").otherwise("No").alias("urgent"),
        F.col("o_orderpriority").alias("priority"))
    path = src.scratch_path(spark, "orders-raw-csv")
    src.write_table(text, path, "csv")
    return src.read_table(spark, path, "csv")


def _csv_recipe_sql():
    feats = ["cust_no", "amount", "order_date_year", "order_date_month", "order_date_day", "order_date_dayofweek"]
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in feats)
    clipped = ", ".join(
        f"round(CASE WHEN q3_{c} - q1_{c} = 0 THEN CAST({c} AS DOUBLE) ELSE greatest(least(CAST({c} AS DOUBLE), "
        f"q3_{c} + 1.5 * (q3_{c} - q1_{c})), q1_{c} - 1.5 * (q3_{c} - q1_{c})) END, 4) AS {c}" for c in feats)
    return f"""
WITH raw AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cust_no,
         round(o_totalprice, 2) AS amount,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
         o_orderdate AS d,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent,
         o_orderpriority AS priority_label
  FROM orders),
codes AS (SELECT priority_label AS label, CAST(dense_rank() OVER (ORDER BY priority_label) - 1 AS BIGINT) AS code
          FROM (SELECT DISTINCT priority_label FROM raw)),
m AS (SELECT status AS mode FROM raw WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1),
p AS (SELECT cust_no, amount, coalesce(status, mode) AS status, year(d) AS order_date_year, month(d) AS order_date_month,
             day(d) AS order_date_day, isodow(d) - 1 AS order_date_dayofweek, urgent, codes.code AS priority
      FROM raw JOIN codes ON raw.priority_label = codes.label, m),
f AS (SELECT CASE WHEN skewness(cust_no) > 1 THEN median(cust_no) ELSE avg(cust_no) END AS fc FROM p),
g AS (SELECT coalesce(cust_no, fc) AS cust_no, amount, status, order_date_year, order_date_month, order_date_day,
             order_date_dayofweek, urgent, priority FROM p, f),
q AS (SELECT {qs} FROM g)
SELECT {clipped}, urgent, priority, CAST(status = 'F' AS INTEGER) AS status_F, CAST(status = 'O' AS INTEGER) AS status_O
FROM g, q"""


@register("clean_csv_orders", _csv_recipe_sql())
def q_clean_csv_orders(spark, sf_dir):
    df = orders_csv_raw(spark, sf_dir)
    out, _ = rcp.clean(df, "priority")
    return out.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in out.dtypes])


@register("run_fit_on_train_orders")
def q_run_fit_on_train_orders(spark, sf_dir):
    """The leakage-free variant: statistics fitted on the training rows only."""
    return run_all(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey", fit_on="train").metrics


@register("recipe_roundtrip_orders", _clean_orders_sql())
def q_recipe_roundtrip_orders(spark, sf_dir):
    """Fit on orders, save the recipe, load it back and apply it: same rows as clean_orders."""
    o = table(spark, sf_dir, "orders")
    path = rcp.save_recipe(rcp.fit(o, rcp.Config(targets=("o_totalprice",))), src.scratch_path(spark, "recipe"))
    return rcp.load_recipe(spark, path).transform(o)
