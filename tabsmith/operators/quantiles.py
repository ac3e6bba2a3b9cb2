"""Exact quantiles (linear interpolation, as pandas / DuckDB ``quantile_cont``).

One path for every column and size; NaN counts as missing. The values of all columns go as
``(column, value)`` rows through three passes, whatever the width: one mergeable rank sketch per
column (``percentile_approx``, a bounded buffer) brackets every wanted rank between two values; one
aggregate counts exactly what lies below, on and between them; a rank is then one of the two values,
or is picked by a window over the open interval between, which holds about two thousandths of the
rows. A column known to have few values is answered from the counts of its values instead, in one
pass. Intervals of more than ``small`` values are narrowed once more in the same way. Brackets are
ranks, not widths, so skewed and infinite values take no more rounds; every round takes at least the
two end values out. Only rows of counts reach the driver.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.unpivot import unpivot

SMALL = 50_000
ACCURACY = 2_000
#: Ranks handled by one job: bounds the sketches that a task holds.
RANKS_PER_JOB = 64


def _value(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def _inside(v: Column, lo: float | None, hi: float | None) -> Column:
    """Is ``v`` in the open interval? None is no bound."""
    out = v.isNotNull()
    if lo is not None:
        out = out & (v > F.lit(lo))
    if hi is not None:
        out = out & (v < F.lit(hi))
    return out


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(i, v)``: position in ``cols`` and value, missing values left out."""
    return unpivot(df, [(F.lit(i), _value(c)) for i, c in enumerate(cols)], ("i", "v")).where(F.col("v").isNotNull())


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(i, v, n)``: position in ``cols``, value, rows with it; meant for columns of few values."""
    return _long(df, cols).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))


def few_valued(cols: list[str], distinct: dict[str, int] | None, small: int = SMALL) -> list[str]:
    """The columns that ``distinct`` (upper bounds of their numbers of values) shows to have at most ``small``."""
    return [c for c in cols if (distinct or {}).get(c, small + 1) <= small]


def counted_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, tuple[int, list[float | None]]]:
    """``{column: (number of values, [quantile for each prob])}`` of columns of few values, exact, in one pass.

    The window of a column holds its distinct values, not its rows; a column of more values than thought
    is only slower.
    """
    if not cols:
        return {}
    upto, whole = Window.partitionBy("i").orderBy("v"), Window.partitionBy("i")
    ranked = value_counts(df, cols).select(
        "i", "v", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("size"), F.count("v").over(whole).alias("values"))
    spot = [f((F.col("size") - 1) * F.lit(float(p))) for p in probs for f in (F.floor, F.ceil)]
    wanted = reduce(or_, [(at < F.col("upto")) & (at >= F.col("upto") - F.col("n")) for at in spot])
    size, values, found = {c: 0 for c in cols}, {c: 0 for c in cols}, {}
    for r in ranked.where(wanted).collect():
        c = cols[r["i"]]
        size[c], values[c] = r["size"], r["values"]
        for p in probs:
            h = (r["size"] - 1) * p
            for rank in (math.floor(h), math.ceil(h)):
                if r["upto"] - r["n"] <= rank < r["upto"]:
                    found[c, rank] = r["v"]
    return {c: (values[c], [_interpolate(found, c, size[c], p) for p in probs]) for c in cols}


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], small: int = SMALL,
                    accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """``{column: [quantile for each prob]}``; None for a column without values."""
    if not cols:
        return {}
    long = _long(df, cols)
    around = F.array(*[F.lit(float(min(1.0, max(0.0, p + d / accuracy)))) for p in probs for d in (-2, 2)])
    rows = long.groupBy("i").agg(F.count("v").alias("n"), F.percentile_approx("v", around, accuracy).alias("ends")).collect()
    size = {c: 0 for c in cols} | {cols[r["i"]]: r["n"] for r in rows}
    found: dict[tuple[str, int], float] = {}
    # (column, rank from 0) -> open interval, values below or on its lower end, values inside
    state, spots = {}, []
    for r in rows:
        c, n = cols[r["i"]], r["n"]
        for j, p in enumerate(probs):
            h = (n - 1) * p
            ranks = {math.floor(h), math.ceil(h)}
            if n <= small:
                state.update({(c, rank): (None, None, 0, n) for rank in ranks})
            else:
                spots.append((r["i"], ranks, r["ends"][2 * j], r["ends"][2 * j + 1]))
    if spots:
        table = df.sparkSession.createDataFrame([(i, k, a, b) for k, (i, _, a, b) in enumerate(spots)], "i int, k int, a double, b double")
        counts = long.join(F.broadcast(table), "i").groupBy("k").agg(  # a row per column and prob
            F.count_if(F.expr("v < a")).alias("l"), F.count_if(F.expr("v = a")).alias("a"), F.count_if(F.expr("v > a and v < b")).alias("m"), F.count_if(F.expr("v = b")).alias("e"))
        for r in counts.collect():
            i, ranks, a, b = spots[r["k"]]
            for rank in ranks:
                _settle((cols[i], rank), (None, None, 0, size[cols[i]]), a, b, [r[x] for x in "lame"], found, state)
    while state:
        done = {k: s for k, s in state.items() if s[3] <= small}
        found.update(_pick(df, done))
        rest = [(k, s) for k, s in state.items() if k not in done]
        state = {}
        for at in range(0, len(rest), RANKS_PER_JOB):
            _narrow(df, dict(rest[at:at + RANKS_PER_JOB]), accuracy, found, state)
    return {c: [_interpolate(found, c, size[c], p) for p in probs] for c in cols}


def _settle(key: tuple, interval: tuple, a: float, b: float, counts: list[int], found: dict, state: dict) -> None:
    """Answers a rank from the counts below ``a``, on it, between, and on ``b``, or gives its smaller interval."""
    lo, hi, below, n = interval
    less, on_a, mid, on_b = counts
    on_b = 0 if a == b else on_b
    rank = key[1]
    above = less + on_a + mid + on_b
    if rank < less:
        state[key] = (lo, a, below, less - below)
    elif rank < less + on_a:
        found[key] = a
    elif rank < less + on_a + mid:
        state[key] = (a, b, less + on_a, mid)
    elif rank < above:
        found[key] = b
    else:
        state[key] = (b, hi, above, below + n - above)


def _interpolate(found: dict, c: str, n: int, p: float) -> float | None:
    if not n:
        return None
    h = (n - 1) * p
    a, b = found[c, math.floor(h)], found[c, math.ceil(h)]
    return a if a == b else a + (h - math.floor(h)) * (b - a)


def _pick(df: DataFrame, done: dict) -> dict:
    """Exact values of ranks whose interval is small: one ordered window per interval."""
    if not done:
        return {}
    spots: dict[tuple, list[int]] = {}
    for (c, rank), (lo, hi, below, _) in done.items():
        spots.setdefault((c, lo, hi), []).append(rank - below + 1)
    keys = list(spots)
    entries = [F.when(_inside(_value(c), lo, hi), F.struct(F.lit(g).alias("g"), _value(c).alias("v"))) for g, (c, lo, hi) in enumerate(keys)]
    inside = reduce(or_, [_inside(_value(c), lo, hi) for c, lo, hi in keys])  # few rows: the others need no array
    long = df.where(inside).select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    ranks = F.create_map(*[x for g, k in enumerate(keys) for x in (F.lit(g), F.array(*map(F.lit, spots[k])))])
    order = Window.partitionBy("g").orderBy("v")  # at most ``small`` values each
    rows = (long.withColumn("rn", F.row_number().over(order))
            .filter(F.array_contains(F.element_at(ranks, F.col("g")), F.col("rn"))).collect())
    got = {(r["g"], r["rn"]): r["v"] for r in rows}
    return {(c, rank): got[keys.index((c, lo, hi)), rank - below + 1] for (c, rank), (lo, hi, below, _) in done.items()}


def _narrow(df: DataFrame, part: dict, accuracy: int, found: dict, state: dict) -> None:
    """One round for some ranks: each is answered (``found``) or moves to a smaller interval (``state``)."""
    keys = list(part)
    sketch = []
    for i, k in enumerate(keys):
        lo, hi, below, n = part[k]
        p = (k[1] - below + 0.5) / n
        v = _value(k[0])
        around = F.array(F.lit(max(0.0, p - 2 / accuracy)), F.lit(min(1.0, p + 2 / accuracy)))
        sketch.append(F.percentile_approx(F.when(_inside(v, lo, hi), v), around, accuracy).alias(f"b{i}"))
    row = df.agg(*sketch).first()
    ends = [row[f"b{i}"] for i in range(len(keys))]
    counts = []
    for i, (k, (a, b)) in enumerate(zip(keys, ends, strict=True)):
        v = _value(k[0])
        counts += [F.count_if(v < F.lit(a)).alias(f"l{i}"), F.count_if(v == F.lit(a)).alias(f"a{i}"),
                   F.count_if((v > F.lit(a)) & (v < F.lit(b))).alias(f"m{i}"), F.count_if(v == F.lit(b)).alias(f"e{i}")]
    row = df.agg(*counts).first()
    for i, (k, (a, b)) in enumerate(zip(keys, ends, strict=True)):
        _settle(k, part[k], a, b, [row[f"{x}{i}"] for x in "lame"], found, state)
