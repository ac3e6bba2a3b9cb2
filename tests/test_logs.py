from tabsmith import fixed
from tabsmith.operators import logs


def _table(spark, runs):
    rows = [(rid, i, line) for rid, lines in runs.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "run_id int, line_no int, line string")


def test_block_and_fallback(spark):
    block = ["[2026-06-20 18:27:05] Model trained and saved", "noise", fixed.SCORECARD_START,
             fixed.SCORECARD_HEADER, "Task Strategy: Regression", "chatter", "R-squared (R2) Score: 0.9",
             fixed.SCORECARD_RULE, "Accuracy after rule", fixed.SCORECARD_END]
    plain = [f"line {i}" for i in range(20)]
    snip = {r.run_id: r.snippet for r in logs.snippet(_table(spark, {1: block, 2: plain})).collect()}
    assert snip[1].split("\n") == ["Model trained and saved", fixed.SCORECARD_HEADER,
                                   "Task Strategy: Regression", "R-squared (R2) Score: 0.9",
                                   fixed.SCORECARD_RULE]
    assert snip[2].split("\n") == [f"line {i}" for i in range(5, 20)]


def test_scan_cap_100(spark):
    lines = [fixed.SCORECARD_HEADER] + [f"target {i}" for i in range(150)]
    out = logs.scorecard_lines(logs.clean_lines(_table(spark, {1: lines})))
    assert out.count() == 100


def test_between_markers(spark):
    lines = ["a", fixed.SCORECARD_START, "b", fixed.SCORECARD_END, "c"]
    got = [r.line for r in logs.between_markers(_table(spark, {1: lines, 2: ["x", "y"]}))
           .orderBy("run_id", "line_no").collect()]
    assert got == [fixed.SCORECARD_START, "b", fixed.SCORECARD_END, "x", "y"]
