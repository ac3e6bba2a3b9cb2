"""Mapping and run-record sinks / sources (JSON)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.session import ensure_checkpoint_dir

MAPPING_SCHEMA = "column_name string, label string, code bigint"


def write_mappings(mappings: DataFrame, path: str) -> str:
    """The long mapping table as JSON lines, written by the executors."""
    mappings.select("column_name", "label", "code").write.mode("overwrite").json(path)
    return path


def read_mappings(spark: SparkSession, path: str) -> DataFrame | None:
    """The mapping table, or None when nothing was written (no decoding then)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(MAPPING_SCHEMA).json(path)


def _json_text(col):
    """A text column as a JSON string, quotes included."""
    return F.regexp_extract(F.to_json(F.struct(col.alias("t"))), r'(?s)^\{"t":(.*)\}$', 1)


def mappings_document(mappings: DataFrame) -> DataFrame:
    """``(column_name, code, line)``: the nested ``{column: {label: code}}`` document, one line a label, in
    range partitions ordered by column and code.

    A line opens its column's object if its code is the column's first and closes the document if it is the
    last of all. Only the first and last code of each column are gathered, so a column with a billion labels
    is split over as many partitions as its rows need. Without labels there is no line.
    """
    spark = mappings.sparkSession
    ends = mappings.groupBy("column_name").agg(F.min("code").alias("lo"), F.max("code").alias("hi")).collect()
    if not ends:
        return spark.createDataFrame([], "column_name string, code bigint, line string")
    top, last = (f(r["column_name"].encode() for r in ends).decode() for f in (min, max))
    edges = F.broadcast(spark.createDataFrame(ends, "column_name string, lo bigint, hi bigint"))
    name, first = F.col("column_name"), F.col("code") == F.col("lo")
    opening = F.when(~first, ",").otherwise(F.concat(F.when(name == top, "{").otherwise("},"), _json_text(name), F.lit(":{")))
    closing = F.when((name == last) & (F.col("code") == F.col("hi")), "}}").otherwise("")
    line = F.concat(opening, _json_text(F.col("label")), F.lit(":"), F.col("code").cast("string"), closing)
    lines = mappings.join(edges, "column_name").select("column_name", "code", line.alias("line"))
    return lines.repartitionByRange("column_name", "code").sortWithinPartitions("column_name", "code")


def write_mappings_document(mappings: DataFrame, path: str) -> str:
    """The nested document as text parts under ``path``; read one after the other in name order they
    are one JSON document (nothing is written for a mapping without labels)."""
    mappings_document(mappings).select("line").write.mode("overwrite").text(path)
    return path


def write_run_record(spark: SparkSession, record: dict, path: str | None = None) -> str:
    """The run's final state as one JSON document. Without a path it goes under the
    shared checkpoint folder."""
    if path is None:
        path = ensure_checkpoint_dir(spark).rstrip("/") + "/tabsmith/run-records"
    doc = json.dumps(record, default=str, sort_keys=True)
    spark.createDataFrame([(doc,)], "record string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_run_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
