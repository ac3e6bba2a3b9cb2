"""DuckDB SQL builders for the oracle side of the correctness check.

The driver tables have fixed schemas, listed here with Spark's type names, so the
profile-style oracles can be written out column by column.
"""

from __future__ import annotations

SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"),
                 ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
             ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
               ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"),
                 ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
                 ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"),
                  ("source", "string"), ("n_chars", "bigint")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"),
                      ("text", "string")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
}

NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def r2(expr: str, digits: int = 2) -> str:
    """Round like Spark: adding 0.0 turns DuckDB's -0.0 into 0.0."""
    return f"(round({expr}, {digits}) + 0.0)"


def profile_sql(source: str, schema: list[tuple[str, str]], k: int = 3) -> str:
    """One SELECT per column, UNION ALL; mirrors operators.profile.profile."""
    parts = []
    for i, (name, dtype) in enumerate(schema):
        c = q(name)
        num = dtype in NUMERIC
        x = f"CAST({c} AS DOUBLE)"
        stats = (f"{r2(f'skewness({x})')} AS skew, {r2(f'avg({x})')} AS mean, "
                 f"{r2(f'stddev_samp({x})')} AS std, {r2(f'min({x})')} AS min, "
                 f"{r2(f'max({x})')} AS max, CAST(NULL AS VARCHAR) AS top_values"
                 if num else
                 "CAST(NULL AS DOUBLE) AS skew, CAST(NULL AS DOUBLE) AS mean, "
                 "CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, "
                 "CAST(NULL AS DOUBLE) AS max, "
                 f"(SELECT '{{' || string_agg('''' || v || ''': ' || cnt, ', ' ORDER BY cnt DESC, v)"
                 f" || '}}' FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS cnt FROM src"
                 f" WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY cnt DESC, v LIMIT {k})) AS top_values")
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS ordinal, '{name}' AS column_name, '{dtype}' AS dtype, "
            f"count(*) AS n_rows, round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct, "
            f"count(DISTINCT {c}) AS n_distinct, {stats} FROM src")
    body = "\nUNION ALL\n".join(parts)
    return (f"WITH src AS ({source}), p AS ({body})\n"
            "SELECT *, concat_ws(', ', "
            "CASE WHEN n_distinct = n_rows AND n_distinct > 1 THEN 'POTENTIAL ID' END, "
            "CASE WHEN n_distinct <= 1 THEN 'CONSTANT' END, "
            "CASE WHEN null_pct > 60 THEN 'HIGH NULL' END) AS flags FROM p")


def duplicates_sql(source: str, schema: list[tuple[str, str]]) -> str:
    """Every same-type pair compared null-safely; the earliest partner is reported."""
    pairs = [(a, b) for j, (b, tb) in enumerate(schema) for (a, ta) in schema[:j] if ta == tb]
    if not pairs:
        return "SELECT CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS duplicate_of WHERE false"
    checks = ", ".join(f"bool_and({q(a)} IS NOT DISTINCT FROM {q(b)}) AS p{k}"
                       for k, (a, b) in enumerate(pairs))
    order = {n: i for i, (n, _) in enumerate(schema)}
    rows = " UNION ALL ".join(
        f"SELECT '{b}' AS column_name, '{a}' AS duplicate_of, {order[a]} AS k, p{k} AS same FROM chk"
        for k, (a, b) in enumerate(pairs))
    return (f"WITH src AS ({source}), chk AS (SELECT {checks} FROM src) "
            f"SELECT column_name, arg_min(duplicate_of, k) AS duplicate_of FROM ({rows}) "
            "WHERE same GROUP BY column_name")


ID_HINTS = ("id", "index", "serial", "key", "no.")


def drop_plan_sql(source: str, schema: list[tuple[str, str]], targets=()) -> str:
    """D1-D6 from the profile and the duplicate check."""
    hint = " OR ".join(f"instr(lower(column_name), '{h}') > 0" for h in ID_HINTS)
    keep = ", ".join(f"'{t}'" for t in targets) or "''"
    return (f"WITH p AS ({profile_sql(source, schema)}), d AS ({duplicates_sql(source, schema)}), "
            "r AS ("
            f"SELECT column_name, 'id' AS reason FROM p WHERE n_distinct = n_rows AND ({hint}) "
            "AND dtype <> 'string' "
            "UNION ALL SELECT column_name, 'high_null' FROM p WHERE null_pct > 60 "
            "UNION ALL SELECT column_name, 'constant' FROM p WHERE n_distinct <= 1 "
            "UNION ALL SELECT column_name, 'duplicate' FROM d) "
            "SELECT column_name, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons "
            f"FROM r WHERE column_name NOT IN ({keep}) GROUP BY column_name")
