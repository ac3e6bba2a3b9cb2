"""Quoted CSV files read by many tasks: the true record borders inside every byte range.

A line break may stand inside a quoted field, so a task that starts in the middle of a file does not
know whether it starts inside one. A first scan finds for each byte range in which state (inside a
quoted field or not) it ends for either state it may begin in; the ranges of a file are chained from
its start; a second scan, now knowing its state, cuts records. The record that runs over the end of a
range is put together from its pieces, at most two per range. Records are then parsed by Spark's own
CSV expression.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed values of the format (RFC 4180): separator and quote.
SEP, QUOTE = ",", '"'
_ENDS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("out", pa.bool_()), ("inside", pa.bool_())])
_PIECES = pa.schema([("path", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("text", pa.string())])


def inside_after(line: str, inside: bool) -> bool:
    """Is the end of ``line`` inside a quoted field, if its start is (``inside``) or is a record's start?

    A quote opens a field only at its start and closes it unless doubled; one in the middle of an
    unquoted field is text, as for Spark's reader.
    """
    at = 0
    while True:
        if not inside:
            if line.startswith(QUOTE, at):
                at += 1
            else:
                at = line.find(SEP, at) + 1
                if not at:
                    return False
                continue
        while True:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if not line.startswith(QUOTE, at + 1):
                break
            at += 2
        inside = False
        at = line.find(SEP, at) + 1
        if not at:
            return False


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path, block, out, inside``: the state at the end of each byte range for both states at its start."""
    key, out, inside = None, False, True
    for b in batches:
        for path, block, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (path, block) != key:
                if key:
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, out, inside)], schema=_ENDS)
                key, out, inside = (path, block), False, True
            if QUOTE in line:
                out, inside = inside_after(line, out), inside_after(line, inside)
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, out, inside)], schema=_ENDS)


def _pieces(begins: dict[tuple[str, int], bool]):
    """Records of each byte range; ``head`` ends a record of a range before, ``mid`` is all inside one, ``tail`` begins one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, kind, inside, rows, header = None, [], "record", False, [], False

        def left() -> list[tuple]:
            if not held:
                return []
            if header:
                raise ValueError(f"the header of {key[0]} is longer than a partition")
            return [(*key, {"head": "mid", "record": "tail"}[kind], "\n".join(held))]

        for b in batches:
            for path, block, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (path, block) != key:
                    rows += left()
                    key, held = (path, block), []
                    inside = begins[key]
                    kind, header = "head" if inside else "record", block == 0
                held.append(line)
                inside = inside_after(line, inside) if QUOTE in line else inside
                if not inside:
                    if not header:
                        rows.append((*key, kind, "\n".join(held)))
                    held, kind, header = [], "record", False
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)
                rows = []
        rows = left()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)
    return run


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``path, block, text``: the records of CSV files (first one, the header, left out), each with its line breaks, by all tasks at once.

    A row per byte range comes to the driver (two states), nothing else. Files end lines with \\n or
    \\r\\n; a quoted field that no quote closes takes the rest of its file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    begins, state = {}, {}
    for r in sorted(lines.mapInArrow(_ends, "path string, block long, out boolean, inside boolean").collect()):
        begins[r.path, r.block] = state.get(r.path, False)
        state[r.path] = r.inside if begins[r.path, r.block] else r.out
    pieces = lines.mapInArrow(_pieces(begins), "path string, block long, kind string, text string")
    whole = pieces.where("kind = 'record'").select("path", "block", "text")
    torn = pieces.where("kind <> 'record'").withColumn("last", (F.col("kind") == "tail").cast("int"))
    # at most two pieces of each range: a tail begins a record, what follows belongs to it
    nth = F.sum("last").over(Window.partitionBy("path").orderBy("block", "last"))
    torn = torn.withColumn("record", nth).groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("block", "last", "text"))).alias("l"))
    # order inside a range: the head of one record stands before the tail of the next
    return whole.unionByName(torn.select("path", F.col("l.block")[0].alias("block"), F.array_join("l.text", "\n").alias("text")))


def read_csv(spark: SparkSession, path: str, columns: list[str], options: dict) -> DataFrame:
    """All columns as text, equal to Spark's multi-line reader (with a header in every file), by many tasks."""
    names = [f"c{i}" for i in range(len(columns))]
    records = read_records(spark, path).withColumn("text", F.regexp_replace("text", "\r\\z", "")).where(F.col("text") != "")
    rules = {k: str(v) if not isinstance(v, bool) else str(v).lower() for k, v in options.items() if k != "header"}
    parsed = F.from_csv("text", ", ".join(f"{n} string" for n in names), rules)
    rows = records.withColumn("r", parsed)
    return rows.select(*[F.col(f"r.{n}").alias(c) for n, c in zip(names, columns, strict=True)])
