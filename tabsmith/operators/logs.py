"""Log-table operators over ``(run_id, line_no, line)``.

Per-run positions come from aggregates (marker and header positions) joined back on
``run_id``; ordered work is confined to bounded sets per run (the 100-line scan after
a scorecard header, the last 15 lines), picked with the salted top-k so a run holding
most of the table never lands on one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith import fixed
from tabsmith.functions.text import clean_log_line
from tabsmith.operators.topk import top_k_per_group


def _contains_any(c: Column, words) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | (F.instr(c, w) > 0)
    return cond


def between_markers(df: DataFrame, start: str = fixed.SCORECARD_START,
                    end: str = fixed.SCORECARD_END) -> DataFrame:
    """L1: when a run holds both markers, the text from the first start marker to the end
    of the first end marker (lines cut at the markers); otherwise every line."""
    pos = df.groupBy("run_id").agg(
        F.min(F.when(F.instr("line", start) > 0, F.col("line_no"))).alias("__s"),
        F.min(F.when(F.instr("line", end) > 0, F.col("line_no"))).alias("__e"))
    j = df.join(pos, "run_id")
    both = F.col("__s").isNotNull() & F.col("__e").isNotNull()
    inside = (F.col("line_no") >= F.col("__s")) & (F.col("line_no") <= F.col("__e"))
    first = F.col("line_no") == F.col("__s")
    last = F.col("line_no") == F.col("__e")
    cut_end = F.instr("line", end) + len(end) - 1
    line = F.col("line")
    line = F.when(both & last, F.substring(line, 1, cut_end)).otherwise(line)
    line = F.when(both & first, F.expr(f"substring(line, instr(line, '{start}'))")).otherwise(line)
    # start and end on one line: keep the span between them
    same = both & first & last
    line = F.when(same, F.expr(f"substring(line, instr(line, '{start}'), "
                                f"instr(line, '{end}') + {len(end)} - instr(line, '{start}'))")).otherwise(line)
    return (j.filter(~both | inside).select("run_id", "line_no", line.alias("line")))


def clean_lines(df: DataFrame) -> DataFrame:
    """X7 on every line, blank results removed."""
    return (df.select("run_id", "line_no", clean_log_line(F.col("line")).alias("line"))
              .filter(F.col("line") != ""))


def scorecard_lines(clean: DataFrame) -> DataFrame:
    """L2 over cleaned lines: from the first header line scan at most 100 lines, keep
    keyword lines that are not the start/end wrappers, and stop at the end marker or at
    the 35-'=' rule once more than one line is kept."""
    low = F.lower(F.col("line"))
    is_head = (F.instr("line", fixed.SCORECARD_START) > 0) | (F.instr("line", fixed.SCORECARD_HEADER) > 0)
    head = clean.groupBy("run_id").agg(F.min(F.when(is_head, F.col("line_no"))).alias("__h"))
    after = (clean.join(head.filter(F.col("__h").isNotNull()), "run_id")
                  .filter(F.col("line_no") >= F.col("__h")).drop("__h"))
    scan = top_k_per_group(after, ["run_id"], [F.col("line_no").asc()], fixed.SCORECARD_MAX_LINES,
                           F.xxhash64("line_no"), rank_col="idx")
    kept = _contains_any(low, fixed.SCORECARD_KEYWORDS) & ~_contains_any(low, fixed.SCORECARD_WRAPPER_WORDS)
    w = Window.partitionBy("run_id").orderBy("idx")           # at most 100 rows per run
    scan = scan.withColumn("kept", kept).withColumn(
        "kcum", F.sum(F.col("kept").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    stop = (F.instr("line", fixed.SCORECARD_END) > 0) | (
        (F.instr("line", fixed.SCORECARD_RULE) > 0) & (F.col("kcum") > 1))
    first_stop = F.min(F.when(stop, F.col("idx"))).over(Window.partitionBy("run_id"))
    return (scan.withColumn("__stop", first_stop)
                .filter(F.col("kept") & (F.col("__stop").isNull() | (F.col("idx") <= F.col("__stop"))))
                .select("run_id", "line_no", "line"))


def tail_lines(clean: DataFrame, n: int = fixed.FALLBACK_TAIL_LINES) -> DataFrame:
    """The last ``n`` cleaned lines of each run."""
    return (top_k_per_group(clean, ["run_id"], [F.col("line_no").desc()], n, F.xxhash64("line_no"))
            .select("run_id", "line_no", "line"))


def fallback_lines(clean: DataFrame, block: DataFrame, n: int = fixed.FALLBACK_TAIL_LINES) -> DataFrame:
    """L3: last ``n`` lines for runs without a scorecard block."""
    return tail_lines(clean.join(block.select("run_id").distinct(), "run_id", "left_anti"), n)


def status_line(clean: DataFrame) -> DataFrame:
    """L4: the first line that reports a trained and saved model."""
    hit = F.instr(F.lower(F.col("line")), fixed.STATUS_LINE_WORDS) > 0
    return (clean.filter(hit).groupBy("run_id")
                 .agg(F.min_by("line", "line_no").alias("line"), F.min("line_no").alias("line_no")))


def snippet(df: DataFrame) -> DataFrame:
    """Per run, the status line then the scorecard block (or the fallback tail),
    joined by newlines. At most 1 + 100 lines per run are gathered."""
    clean = clean_lines(df)
    block = scorecard_lines(clean)
    tail = fallback_lines(clean, block)
    parts = (status_line(clean).select("run_id", F.lit(0).alias("g"), "line_no", "line")
             .unionByName(block.select("run_id", F.lit(1).alias("g"), "line_no", "line"))
             .unionByName(tail.select("run_id", F.lit(1).alias("g"), "line_no", "line")))
    agg = parts.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("g", "line_no", "line"))).alias("l"))
    return agg.select("run_id", F.array_join(F.col("l.line"), "\n").alias("snippet"))
