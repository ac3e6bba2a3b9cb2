"""Table sources and sinks: discovery, CSV with pandas-like typing, header peek, pooling, writes.

Listing uses the Hadoop file system of the path (metadata only). CSV is read as text,
null tokens become nulls, and column types are inferred with ``try_cast`` in one
aggregate pass, so a numeric column holding ``NA`` is still numeric.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith import fixed
from tabsmith.session import ensure_checkpoint_dir
from tabsmith.sources import csv_split

READABLE = (".csv", ".parquet")
BOOL_WORDS = ("true", "false")
INT_SHAPE = "^\\s*[+-]?[0-9]+\\s*$"
NUM_SHAPE = "^\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$"


def as_long(x):
    """Integer text as bigint; other text null without the cast's exception path."""
    return F.when(x.rlike(INT_SHAPE), x.try_cast("bigint"))


def as_double(x):
    """Numeric text as double; other text null without the cast's exception path."""
    return F.when(x.rlike(NUM_SHAPE), x.try_cast("double"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discover(spark: SparkSession, path: str, suffixes: Sequence[str] = fixed.TABLE_SUFFIXES) -> DataFrame:
    """``(path, name, suffix, size, readable)`` of table files: the file itself, or the files
    directly inside a directory (not recursive). A directory with a table suffix is a table of
    part files. Excel files are listed but not ``readable`` here. No match is an error."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    status = fs.getFileStatus(p)
    entries = [status] if status.isFile() else list(fs.listStatus(p))
    rows = []
    for s in entries:
        name = s.getPath().getName()
        dot = name.rfind(".")
        suffix = name[dot:].lower() if dot >= 0 else ""
        if suffix in suffixes:
            size = int(s.getLen()) if s.isFile() else int(fs.getContentSummary(s.getPath()).getLength())
            rows.append((s.getPath().toString(), name, suffix, size, suffix in READABLE))
    if not rows:
        raise ValueError(f"no table files ({', '.join(suffixes)}) at {path}")
    return spark.createDataFrame(sorted(rows, key=lambda r: r[1]), "path string, name string, suffix string, size long, readable boolean")


def table_sizes(spark: SparkSession, found: DataFrame) -> DataFrame:
    """The discovered tables, each readable one opened, with ``n_rows`` (one row per file on the driver)."""
    out = None
    for r in found.collect():
        one = F.lit(None).cast("long") if not r.readable else None
        rows = spark.range(1).select(one.alias("n_rows")) if one is not None else read_table(spark, r.path, infer=False).agg(F.count(F.lit(1)).alias("n_rows"))
        rows = rows.select(*[F.lit(r[c]).alias(c) for c in found.columns], "n_rows")
        out = rows if out is None else out.unionAll(rows)
    return out


def _null_tokens(c):
    return F.when(c.isin(list(fixed.NA_TOKENS)), F.lit(None).cast("string")).otherwise(c)


def infer_types(df: DataFrame) -> DataFrame:
    """Type string columns like pandas: integers (double when nulls are present), floats,
    True/False words as booleans, everything else text. One aggregate pass."""
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not cols:
        return df
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"nn{i}"), F.count(as_long(x)).alias(f"i{i}"),
                 F.count(as_double(x)).alias(f"d{i}"),
                 F.count_if(F.lower(x).isin(list(BOOL_WORDS))).alias(f"b{i}")]
    row = df.agg(*aggs).first()
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c in cols:
            i = cols.index(c)
            nn, n = row[f"nn{i}"], row["__n"]
            if nn and row[f"i{i}"] == nn:
                x = as_long(x) if nn == n else as_long(x).cast("double")
            elif nn and row[f"d{i}"] == nn:
                x = as_double(x)
            elif nn and nn == n and row[f"b{i}"] == nn:
                x = F.lower(x) == "true"
        out.append(x.alias(c))
    return df.select(*out)


#: RFC 4180: fields in double quotes, a quote doubled inside them, white space kept.
CSV_RULES = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file at ``path`` (metadata only); a pattern counts as small."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return 0
    status = fs.getFileStatus(p)
    return max([int(s.getLen()) for s in ([status] if status.isFile() else fs.listStatus(p)) if s.isFile()], default=0)


def _partition_bytes(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def read_table(spark: SparkSession, path: str, fmt: str | None = None, infer: bool = True, multiline: bool = True,
               split: bool | None = None) -> DataFrame:
    """CSV with a header (null tokens, inferred types) or Parquet as it is.

    ``multiline`` (default) lets a quoted field hold line breaks. A file that is larger than one
    partition (``split`` None; True: any) is then cut at its true record borders and read by many
    tasks (``csv_split``), a smaller one by one task; the rows are the same. Without ``multiline``
    a record torn by a line break is an error.
    """
    fmt = fmt or ("parquet" if path.lower().rstrip("/").endswith(".parquet") else "csv")
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        raise ValueError(f"unsupported table format {fmt!r}; export Excel sheets to CSV or Parquet")
    if multiline and (split or split is None and _largest_file(spark, path) > _partition_bytes(spark)):
        raw = csv_split.read_csv(spark, path, peek_columns(spark, path, fmt), CSV_RULES)
        raw = raw.select(*[_null_tokens(F.col(f"`{c}`")).alias(c) for c in raw.columns])
        return infer_types(raw) if infer else raw
    rules = CSV_RULES | ({"multiLine": True} if multiline else {"mode": "FAILFAST"})
    raw = spark.read.options(**rules).option("inferSchema", False).csv(path)
    raw = raw.select(*[_null_tokens(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    return infer_types(raw) if infer else raw


def peek_columns(spark: SparkSession, path: str, fmt: str | None = None) -> list[str]:
    """S3: column names only (the header line, or the Parquet footer)."""
    fmt = fmt or ("parquet" if path.lower().rstrip("/").endswith(".parquet") else "csv")
    if fmt == "parquet":
        return spark.read.parquet(path).columns
    return spark.read.options(**CSV_RULES).option("inferSchema", False).csv(path).columns


#: Whole numbers from narrow to wide.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both: the join of the type lattice.

    Whole numbers widen to the longer one; with a decimal or floating number they are double (two
    floats stay float; a decimal takes the digits of both if 38 are enough); a date is a timestamp at
    midnight; a column without a type (all null) takes the other's. Everything else, booleans with
    numbers too, meets in text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return max(a, b, key=lambda t: WHOLE.index(type(t)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    kinds = {type(a), type(b)}
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if kinds <= {T.DateType, T.TimestampNTZType, T.TimestampType}:
        return T.TimestampNTZType()
    return T.StringType()


def pooled_schema(dfs: Sequence[DataFrame]) -> dict[str, T.DataType]:
    """``{column: type}`` of the tables stacked by name, in order of first appearance."""
    out: dict[str, T.DataType] = {}
    for d in dfs:
        for f in d.schema.fields:
            out[f.name] = wider(out[f.name], f.dataType) if f.name in out else f.dataType
    return out


def pool(dfs: Sequence[DataFrame], names: Sequence[str] | None = None, source_col: str = "source") -> DataFrame:
    """Stack tables by column name (missing columns become null) with a source label.

    Columns whose types differ are cast to the type that holds both (``wider``) before the union, in
    each table's own projection. Without ``names`` the label is the file each row came from
    (``_metadata.file_name``)."""
    types = pooled_schema(dfs)
    out = None
    for i, d in enumerate(dfs):
        label = F.lit(names[i]) if names else F.col("_metadata.file_name")
        own = [F.col(f"`{f.name}`") if f.dataType == types[f.name] else F.col(f"`{f.name}`").cast(types[f.name]).alias(f.name) for f in d.schema.fields]
        d = d.select(*own, label.alias(source_col))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True) -> str:
    """Overwrite ``path``. Spark cannot overwrite a path the plan reads, so that is refused."""
    def norm(p: str) -> str:
        u = urlparse(p)
        return (u.netloc + "/" + u.path.lstrip("/")).rstrip("/") if u.scheme else p.rstrip("/")

    target = norm(path)
    for f in df.inputFiles():
        if (norm(f) + "/").startswith(target + "/"):
            raise ValueError(f"{path} is an input of this frame; write to a new path")
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.options(**(CSV_RULES | {"header": header}))
    w.save(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabsmith/{name}-{uuid.uuid4().hex[:12]}"
