"""Prefix trie of conversations: what they share from their first turn on, by time-forward processing.

Every distinct sequence of first turns is a node. Paths (16-byte turn digests) are put in
lexicographic order over range partitions, the shards. A scan of a shard compares each path with
the one before and writes down the nodes that begin there; equal paths are ordered by id, so a
sequence that a third of all conversations have may span many shards. The nodes of a shard are then
sorted externally by reverse level order, and each node passes its subtree totals to its parent
through a priority queue that spills to disk. Only the nodes on a shard's first and last path can
reach into other shards: these shard roots are added up by key and take a second pass of the same
kind. Nothing but a pending node and the messages in the queue is held in memory.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm import common as C

PATH = "array<struct<k:binary,n:int>>"
ROOT = hashlib.md5(b"").digest()
NOTHING = hashlib.sha256(b"").hexdigest()
#: Turns of a shard, ids of one chunk of a long member list, messages held in memory, rows that may be broadcast.
SHARD_TURNS, CHUNK_IDS, QUEUE_ITEMS, BROADCAST_ROWS = 500_000, 512, 200_000, 200_000
INNER, SPINE, CHUNK = 0, 1, 2
NONE = 1 << 63  # stands for "no id" where ids are compared: above every long

_FIELDS = [("kind", pa.int32()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("chars", pa.int64()), ("conv_id", pa.int64()),
           ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
           ("ends", pa.binary())]
_ARROW = pa.schema(_FIELDS)
ROWS = "kind int, depth long, key binary, parent binary, chars long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary"


# ---------------------------------------------------------------- paths

def paths_of(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, path)``: each conversation's turns in order, as digest and code points of the text.

    Ordered by turn (nulls first), then role, then text; null roles and texts are empty, repeated
    rows are turns of their own, rows without an id are one conversation. Texts stay out of the
    arrays: a turn is about 20 bytes of its conversation's row.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    base = rows.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    turns = base.select("conv_id", F.struct(F.row_number().over(order).alias("p"), digest.alias("k"), F.length("text").alias("n")).alias("t"))
    path = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["k"].alias("k"), t["n"].alias("n")))
    return turns.groupBy("conv_id").agg(path.cast(PATH).alias("path"))


def with_openings(paths: DataFrame, group: int, shared: Column, longest: int) -> DataFrame:
    """Paths whose first ``shared`` turns (at most ``longest``) come from the first conversation of their group.

    That is conversation ``id - id % group``; without it nothing stands for those turns. The join
    moves one short opening per group, so no group is held together.
    """
    first = F.col("conv_id") - F.col("conv_id") % group
    heads = paths.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_head"), F.slice("path", 1, longest).alias("_opening"))
    own = paths.select("conv_id", "path", first.alias("_head"), F.least(shared.cast("int"), F.lit(longest)).alias("_h"))
    opening = F.coalesce(F.slice("_opening", F.lit(1), F.col("_h")), F.array().cast(PATH))
    rest = F.slice("path", F.col("_h") + 1, F.greatest(F.size("path") - F.col("_h"), F.lit(0)))
    return own.join(heads, "_head", "left").select("conv_id", F.concat(opening, rest).alias("path"))


# ---------------------------------------------------------------- inside a shard

class SpillingQueue:
    """A priority queue of tuples: a heap in memory, sorted runs in unnamed temporary files beyond ``limit``."""

    def __init__(self, limit: int = QUEUE_ITEMS):
        self.limit, self.heap, self.runs, self.made = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        file = tempfile.TemporaryFile()
        for at in range(0, len(self.heap), 4096):
            pickle.dump(self.heap[at:at + 4096], file, protocol=pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self.heap = []
        self.made += 1
        self._next(self._items(file), self.made)

    @staticmethod
    def _items(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    block = pickle.load(file)
                except EOFError:
                    return
                yield from block

    def _next(self, items: Iterator[tuple], run: int) -> None:
        item = next(items, None)
        if item is not None:
            heapq.heappush(self.runs, (item, run, items))

    def head(self) -> tuple | None:
        heads = [h for h in (self.heap[:1], [self.runs[0][0]] if self.runs else []) if h]
        return min(heads)[0] if heads else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, run, items = heapq.heappop(self.runs)
            self._next(items, run)
            return item
        return heapq.heappop(self.heap)


class _Out:
    """Rows gathered into Arrow batches of about ``rows`` rows."""

    def __init__(self, rows: int = 4096):
        self.rows, self.held = rows, []

    def add(self, *row) -> None:
        self.held.append(row)

    def full(self) -> bool:
        return len(self.held) >= self.rows

    def batch(self) -> pa.RecordBatch:
        held, self.held = self.held, []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held, strict=True), _FIELDS, strict=True)], schema=_ARROW)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list, list]]:
    """``(id, digests, code points)`` of every path row."""
    for b in batches:
        ids, path = b.column(0).to_pylist(), b.column(1)
        off = path.offsets.to_pylist()
        turns = path.values.slice(off[0], off[-1] - off[0])
        keys, chars = turns.field(0).to_pylist(), turns.field(1).to_pylist()
        for i, (lo, hi) in zip(ids, itertools.pairwise(off), strict=True):
            yield i, keys[lo - off[0]:hi - off[0]], chars[lo - off[0]:hi - off[0]]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of paths in lexicographic order (equal paths by id), each once, and long member lists in chunks.

    Pending nodes, those on the current path, are held until a path leaves them; the ones on the
    first or last path are marked as shard roots.
    """
    out = _Out()
    pending: list[list] = []  # on the current path: [key, code points, begins on the first path, ends, least end, digest of ends or None]
    path: list[bytes] = []
    ids: list[int] = []
    cut = at_first = True

    def chunk() -> None:
        if ids:
            out.add(CHUNK, -1, pending[-1][0], None, None, ids[0], None, None, None, None, None, ",".join(map(str, ids)).encode())
            ids.clear()

    def settle(edge: bool) -> None:
        """The member list of the current path is whole: its digest, or chunks if it is long or may go on elsewhere."""
        if cut or edge:
            chunk()
        elif pending:
            pending[-1][5] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest().encode()
            ids.clear()

    def leave(depth: int, edge: bool = False) -> None:
        while len(pending) > depth:
            key, chars, left, n, least, ends = pending.pop()
            parent = pending[-1][0] if pending else None
            out.add(SPINE if left or edge else INNER, len(pending), key, parent, chars, None if least == NONE else least, None, n, 0, 0, 0, ends)

    for conv_id, keys, chars in _sequences(batches):
        same = 0
        for a, b in zip(path, keys, strict=False):
            if a != b:
                break
            same += 1
        if not pending or same < len(path) or len(keys) > len(path):
            settle(False)
            leave(same + 1)
            if not pending:
                pending.append([ROOT, 0, True, 0, NONE, NOTHING.encode()])
            for d in range(same, len(keys)):
                key = hashlib.md5(pending[-1][0] + keys[d]).digest()
                pending.append([key, chars[d], at_first, 0, NONE, NOTHING.encode()])
            path, cut = keys, at_first
            pending[-1][5] = None
        top = pending[-1]
        top[3] += 1
        if conv_id is not None:
            top[4] = min(top[4], conv_id)
            ids.append(conv_id)
            if len(ids) >= CHUNK_IDS:
                cut = True
                chunk()
        at_first = False
        if out.full():
            yield out.batch()
    settle(True)
    leave(0, edge=True)
    if out.held:
        yield out.batch()


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes sorted by (depth descending, key): each takes its children's totals from the queue and sends its own on.

    A message is a child's whole row, ordered by (level, parent, least id of the child): the first one
    gives the parent its smallest id, and every child's row goes out as it is taken. Shard roots give
    what they have added up instead of sending it on.
    """
    queue, out = SpillingQueue(), _Out()
    for b in batches:
        for kind, depth, key, parent, chars, least, _, n, children, leaves, saved, ends in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if kind == CHUNK:
                out.add(kind, depth, key, parent, chars, least, None, n, children, leaves, saved, ends)
                continue
            conv = NONE if least is None else least
            first = queue.head()
            if first and first[0] == -depth and first[1] == key:
                conv = min(conv, first[2])
            conv_id = None if conv == NONE else conv
            while (head := queue.head()) and head[0] == -depth and head[1] == key:
                c_least, c_key, c_chars, c_n, c_children, c_leaves, c_saved, c_ends = queue.pop()[2:]
                out.add(INNER, depth + 1, c_key, key, c_chars, None if c_least == NONE else c_least, None if kind == SPINE else conv_id,
                        c_n, c_children, c_leaves, c_saved, c_ends)
                n, children, leaves, saved = n + c_n, children + 1, leaves + c_leaves, saved + c_saved
                if out.full():
                    yield out.batch()
            if kind == SPINE:
                out.add(SPINE, depth, key, parent, chars, conv_id, None, n, children, leaves, saved, ends)
            else:
                leaves = leaves if children else 1
                saved += (n - 1) * chars
                if parent is None:
                    out.add(INNER, depth, key, None, chars, conv_id, None, n, children, leaves, saved, ends)
                else:
                    # levels are popped deepest first: the queue is ordered by -depth of the receiver, ascending
                    queue.push((1 - depth, parent, conv, key, chars, n, children, leaves, saved, ends))
            if out.full():
                yield out.batch()
    if out.held:
        yield out.batch()


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, ends)`` of chunks sorted by key and first id, hashed as they pass."""
    key, state = None, None
    schema = pa.schema([("_key", pa.binary()), ("_ends", pa.string())])
    done: list[tuple] = []
    for b in batches:
        for k, part in zip(b.column("key").to_pylist(), b.column("ends").to_pylist(), strict=True):
            if k != key:
                if state:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(part)
            else:
                state.update(b"," + part)
    if state:
        done.append((key, state.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)


# ---------------------------------------------------------------- the operator

def _few(df: DataFrame) -> DataFrame:
    """Broadcast if counted and small; else a shuffle join, where AQE splits a hot parent."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``paths`` (``conv_id``, ``path`` as ``paths_of`` gives them).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: null), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes in the subtree), ``saved_tokens`` (over the subtree,
    ``(n_convs - 1)`` times the code points of the node's last turn), ``ends_sha256`` (ids of the members
    that end there, ascending, comma-joined) and ``node`` (16 bytes that stand for the sequence).

    A conversation without an id is a member without a number: it counts, but is in no id list, and a
    node of it alone has a null ``conv_id``. A path without turns is a member of the root; an empty
    table gives no node. Extra columns are not read. One path is one row (about 20 bytes a turn).
    """
    spark = paths.sparkSession
    paths = C.written(paths.select("conv_id", "path"), "trie-paths")
    turns = paths.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-turns // shard_turns))
    ordered = paths.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = ordered.mapInArrow(_scan, ROWS).sortWithinPartitions(F.desc("depth"), "key").mapInArrow(_forward, ROWS)
    nodes = C.written(nodes, "trie-shards")
    roots = nodes.where(F.col("kind") == SPINE).groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("chars").alias("chars"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        # whole in at most one shard; chunks hold the rest
        F.min(F.when(F.col("ends") != F.lit(NOTHING).cast("binary"), F.col("ends"))).alias("ends"),
        F.count_if(F.col("ends").isNull()).alias("open"))
    ends = F.when(F.col("open") == 0, F.coalesce("ends", F.lit(NOTHING).cast("binary")))
    roots = roots.select(F.lit(INNER).alias("kind"), "depth", "key", "parent", "chars", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"),
                         "n_convs", "n_children", "n_leaves", "saved_tokens", ends.alias("ends"))
    # at most two paths of each shard: one task, whose queue spills like the others
    roots = C.written(roots.repartition(1).sortWithinPartitions(F.desc("depth"), "key").mapInArrow(_forward, ROWS), "trie-roots")
    chunks = nodes.where(F.col("kind") == CHUNK).select("key", "conv_id", "ends")
    lists = C.written(chunks.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")
                      .mapInArrow(_digest_chunks, "_key binary, _ends string"), "trie-lists")
    late = _few(roots.select(F.col("key").alias("parent"), F.col("conv_id").alias("_parent_conv")))
    inner = nodes.where(F.col("kind") == INNER).join(late, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent_conv"))
    every = inner.drop("_parent_conv").unionByName(roots).withColumnRenamed("key", "_key").join(_few(lists), "_key", "left")
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce(F.col("ends").cast("string"), "_ends", F.lit(NOTHING)).alias("ends_sha256"), F.col("_key").alias("node"))


def conversation_trie(rows: DataFrame, shard_turns: int = SHARD_TURNS, **columns: str) -> DataFrame:
    """``prefix_trie`` of the rows of a conversation table (``conv_id, turn, role, text`` unless named otherwise)."""
    return prefix_trie(paths_of(rows, **columns), shard_turns)
