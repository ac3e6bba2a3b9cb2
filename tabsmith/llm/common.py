"""Helpers shared by the training-data operators.

Text work that needs bytes runs in Arrow batches: a string column is viewed as one byte
buffer with offsets, and words, windows and hashes are computed on the whole buffer with
numpy. Batches are cut to ``max_bytes`` of text first, so a task holds a few MB at a time
(or one document, if that is longer).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.session import ensure_checkpoint_dir

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


# ---------------------------------------------------------------- Spark side

def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Queries run in the block hand rows to Python in batches of about ``most`` bytes (or one row)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under names that cannot clash."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))


def fold_of(id_column: Column, folds: int = 5) -> Column:
    """``crc32(id as text) mod folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def blocks_for(df: DataFrame, text_col: str, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the texts make (one column scan)."""
    total = df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return int(max(1, -(-int(total) // block_bytes)))


def min_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): rows ``(node, component)``, smallest node wins.

    Alternating large-star and small-star rounds (each a grouped minimum and a join on the
    node, so no component meets in one task); every round is checkpointed to the shared
    folder, so a lost executor costs one round. Nodes without an edge are not returned.
    A hub's neighbours are spread by AQE's skew-join splitting; the minimum per node is a
    partial aggregate, combined before the shuffle.
    """
    cur = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()
    for _ in range(max_rounds):
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        new = small.checkpoint()
        old_sum, new_sum = (x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for x in (cur, new))
        cur = new
        if tuple(old_sum) == tuple(new_sum):
            nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.unionAll(cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
    raise RuntimeError(f"{name}: components did not settle in {max_rounds} rounds")


# ---------------------------------------------------------------- inside tasks

def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string or binary array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def small_batches(batches: Iterator[pa.RecordBatch], text: int = 1, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that column ``text`` holds at most ``max_bytes`` (or one row)."""
    for b in batches:
        if not b.num_rows:
            continue
        _, off = text_buffer(b.column(text))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1)
            to = min(to, b.num_rows)
            yield b.slice(at, to - at)
            at = to


def spans(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross a document: ``(starts, ends, runs before each document)``."""
    n = len(mask)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    first = off[:-1]
    before[first[first < n]] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    last = off[1:][off[1:] > off[:-1]] - 1
    after[last] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_M = 0x9E3779B97F4A7C15 | 1
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _M, np.uint64), np.full(size, pow(_M, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POW, _INV = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POW, _INV


class SpanHash:
    """64-bit hashes of any spans of one byte buffer, from a running polynomial sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.inv = _powers(n + 1)
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_BYTE[data] * power[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inv[starts]
        return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of hashes side by side, order kept."""
    h = parts[0].copy()
    for p in parts[1:]:
        h = mix64(h * np.uint64(0xE7037ED1A0B428DB) + p)
    return h


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column of ``df`` has that name (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base
