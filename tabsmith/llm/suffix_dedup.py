"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

A byte goes when a ``length``-byte string that covers it starts anywhere else too. Suffixes are
sorted at anchors only: of every window of ``length`` bytes, the anchor is where its least
``SEED``-byte hash lies, so equal windows have equal anchors at equal places. The windows of one
anchor make its context. Contexts seen twice are repeats as a whole; an anchor whose seed no
other context has is none. What is left (seeds with several contexts) is sorted: tasks
front-code sorted runs of suffixes (common prefix with the one before, and the rest), ship
them to the seed's part, and there a loser tree merges the runs by their known common
prefixes, never comparing a known prefix again. Neighbours in the merged order whose common
prefix is long enough are checked window by window.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm import common as C

SEED = 50
#: A seed with more contexts than this is split by the bytes that 32 neighbouring windows share.
HOT, STRIDE = 4096, 32
#: A longer buffer is scanned in pieces, so that a place fits the low bits of a word.
PLACE_BITS = 23


# ---------------------------------------------------------------- anchors

def anchors(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, C.SpanHash]:
    """``(anchor, first window, last window)`` in the buffer; windows lie in one text. Ties go to the left."""
    hashes = C.SpanHash(data)
    z = np.zeros(0, np.int64)
    n, w = len(data) - SEED + 1, length - SEED + 1
    if n < w:
        return z, z, z, hashes
    at = np.arange(n)
    bits = np.uint64(PLACE_BITS)
    v = (hashes.of(at, at + SEED) >> bits << bits) | at.astype(np.uint64)
    pad = -n % w
    blocks = np.concatenate((v, np.full(pad, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(back[:n - w + 1], ahead[w - 1:n]) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    size = np.diff(off)
    windows = np.maximum(size - length + 1, 0)
    start = np.repeat(off[:-1], windows) + (np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows))
    if not len(start):
        return z, z, z, hashes
    place = place[start]
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)))
    first = np.flatnonzero(new)
    return place[first], start[first], start[np.append(first[1:], len(start)) - 1], hashes


def _pieces(data: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The buffer, or overlapping pieces of a text too long for ``PLACE_BITS``: ``(bytes, offsets, shift)``."""
    most = 1 << PLACE_BITS
    if len(data) <= most:
        yield data, off, 0
        return
    for a in range(0, len(data), most - length):  # one text only, see small_batches
        part = data[a:a + most - 1]
        yield part, np.array([0, len(part)]), a


def _merge_intervals(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of [a, b) intervals, sorted."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1]))) if len(a) else np.zeros(0, np.int64)
    return a[new], b[np.append(new[1:], len(b)) - 1] if len(a) else b


def _scan(length: int):
    """Contexts (kind 0) and intervals that the batch itself shows to be repeated (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small_batches(batches, text=2):
            data, off = C.text_buffer(b.column(2))
            k1, k2 = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for part, part_off, shift in _pieces(data, off, length):
                yield from _contexts(part, part_off, shift, k1, k2, length)
    return run


def _contexts(data: np.ndarray, off: np.ndarray, shift: int, k1: np.ndarray, k2: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    place, low, high, hashes = anchors(data, off, length)
    if not len(place):
        return
    seed = hashes.of(place, place + SEED)
    ctx = C.chain([hashes.of(low, high + length), (place - low).astype(np.uint64)])
    _, inverse, count = np.unique(C.chain([seed, ctx]), return_inverse=True, return_counts=True)
    many = count[inverse] > 1
    doc = np.searchsorted(off, place, side="right") - 1
    base = off[doc] - shift
    one = ~many
    first_of = np.zeros(len(count), np.int64)
    first_of[inverse[::-1]] = np.arange(len(place))[::-1]
    send = np.union1d(np.flatnonzero(one), first_of[count > 1])
    zero, mult = np.zeros(len(send), np.int8), np.minimum(count[inverse[send]], 2).astype(np.int8)
    yield _batch(zero, seed[send], ctx[send], mult, k1[doc[send]], k2[doc[send]], (place - base)[send], (low - base)[send], (high - base)[send])
    if many.any():
        a, e = _merge_intervals(low[many], high[many] + length)
        parts_a, parts_e = _split_at(a, e, off)
        d = np.searchsorted(off, parts_a, side="right") - 1
        o = off[d] - shift
        z = np.zeros(len(parts_a), np.uint64)
        yield _batch(np.ones(len(parts_a), np.int8), z, z, np.zeros(len(parts_a), np.int8), k1[d], k2[d], parts_a - o, parts_a - o, parts_e - o)


def _split_at(a: np.ndarray, e: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals cut at document borders (neighbouring documents may touch)."""
    cuts = np.unique(off)
    i = np.searchsorted(cuts, a, side="right")
    j = np.searchsorted(cuts, e, side="left")
    n = j - i + 1
    which = np.repeat(np.arange(len(a)), n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    start = np.where(nth == 0, a[which], cuts[np.minimum(i[which] + nth - 1, len(cuts) - 1)])
    end = np.where(nth == n[which] - 1, e[which], cuts[np.minimum(i[which] + nth, len(cuts) - 1)])
    return start, end


ROW = "kind byte, seed long, ctx long, mult byte, k1 long, k2 long, place int, low int, high int"


def _batch(kind, seed, ctx, mult, k1, k2, place, low, high) -> pa.RecordBatch:
    cols = [pa.array(kind, pa.int8()), pa.array(seed.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(mult, pa.int8()), pa.array(k1, pa.int64()),
            pa.array(k2, pa.int64()), *(pa.array(x.astype(np.int32)) for x in (place, low, high))]
    return pa.RecordBatch.from_arrays(cols, names=["kind", "seed", "ctx", "mult", "k1", "k2", "place", "low", "high"])


# ---------------------------------------------------------------- runs and their merge

def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings whose first ``known`` bytes are equal."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(items: list[tuple[bytes, bytes, bytes]]) -> bytes:
    """Sorted ``(suffix, left context, rest)`` items as one run.

    A suffix is stored without its common prefix with the one before, a left context
    without its common end with the one before.
    """
    heads, body, last, last_left = [], [], b"", b""
    for key, left, rest in items:
        n = common(last, key, 0)
        m = common(last_left[::-1], left[::-1], 0)
        heads.append(struct.pack("<HHHHH", n, len(key) - n, m, len(left) - m, len(rest)))
        body += [key[n:], left[:len(left) - m], rest]
        last, last_left = key, left
    return len(items).to_bytes(4, "little") + b"".join(heads) + b"".join(body)


def read_run(run: bytes) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """``(common prefix with the one before, suffix, left context, rest)`` in order."""
    n = int.from_bytes(run[:4], "little")
    at, key, left = 4 + 10 * n, b"", b""
    for lcp, k, m, f, r in struct.iter_unpack("<HHHHH", run[4:at]):
        key = key[:lcp] + run[at:at + k]
        left = run[at + k:at + k + f] + (left[len(left) - m:] if m else b"")
        yield lcp, key, left, run[at + k + f:at + k + f + r]
        at += k + f + r


def merge(runs: list[Iterator[tuple[int, bytes, bytes, bytes]]]) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Merge sorted runs by a loser tree; yields ``(common prefix with the one before, suffix, left, rest)``.

    ``known[i]`` is the common prefix of run i's head with the suffix put out last. The head with
    the longer one is smaller; only heads with equal ones are compared, from there on, and the
    loser's new value is where they differ. So no byte of a known prefix is looked at again.
    """
    size = 1
    while size < max(len(runs), 1):
        size *= 2
    heads = [next(r, None) for r in runs] + [None] * (size - len(runs))
    known = [0] * size

    def play(i: int, j: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix becomes that with the winner."""
        a, b = heads[i], heads[j]
        if b is None:
            return i, j
        if a is None:
            return j, i
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        n = common(a[1], b[1], known[i])
        if a[1][n:n + 1] <= b[1][n:n + 1]:
            known[j] = n
            return i, j
        known[i] = n
        return j, i

    losers, level = [0] * size, list(range(size))
    node = size
    while len(level) > 1:
        node //= 2
        nxt = []
        for p in range(0, len(level), 2):
            win, lose = play(level[p], level[p + 1])
            losers[node + p // 2] = lose
            nxt.append(win)
        level = nxt
    win = level[0]
    while heads[win] is not None:
        _, key, left, rest = heads[win]
        yield known[win], key, left, rest
        heads[win] = head = next(runs[win], None)
        known[win] = head[0] if head else 0
        node = (size + win) // 2
        while node:
            best, losers[node] = play(win, losers[node])
            win, node = best, node // 2


# ---------------------------------------------------------------- the sorted order

REST = "<QQHHB"  # seed, context, first and last window before the anchor, seen twice?


def _suffixes(length: int, parts: int):
    """Front-coded sorted runs of the wanted suffixes of a batch of texts, one per part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small_batches(batches, text=0):
            held: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
            for text, want in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w in want:
                    seed, a, low, high = w["seed"] & 0xFFFFFFFFFFFFFFFF, w["place"], w["low"], w["high"]
                    for key, lo, hi in _keys(text, seed, a, low, high, length, w["n_ctx"] > HOT):
                        item = (key.to_bytes(8, "big") + text[a:hi + length], text[lo:a],
                                struct.pack(REST, seed, w["ctx"] & 0xFFFFFFFFFFFFFFFF, a - lo, a - hi, w["n"] > 1))
                        held.setdefault(key % parts, []).append(item)
            runs = [(p, front_code(sorted(items))) for p, items in held.items()]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in runs], pa.int32()), pa.array([r for _, r in runs], pa.binary())], names=["part", "run"])
    return run


def _keys(text: bytes, seed: int, a: int, low: int, high: int, length: int, hot: bool) -> Iterator[tuple[int, int, int]]:
    """``(sort group, first window, last window)``: the seed, or for a hot one, by the bytes that ``STRIDE`` windows share."""
    if not hot:
        yield seed, low, high
        return
    for j in range((a - high) // STRIDE, (a - low) // STRIDE + 1):
        near, far = j * STRIDE, j * STRIDE + STRIDE - 1  # distances of windows before the anchor
        core = text[a - near:a - far + length]
        digest = hashlib.blake2b(core + struct.pack("<QI", seed, j), digest_size=8).digest()
        yield int.from_bytes(digest, "big"), max(low, a - far), min(high, a - near)


def _repeated(length: int, batch: int = 1 << 14):
    """Merge a part's runs and return the repeated windows of each context: ``seed, ctx, far, near``."""
    def run(table: pa.Table) -> pa.Table:
        out: list[pd.DataFrame] = []
        group: list[tuple[int, bytes, bytes, bytes]] = []
        for item in merge([read_run(r) for r in table.column("run").to_pylist()]):
            # a batch ends only where the sort group (the first 8 bytes) changes
            if len(group) >= batch and item[0] < 8:
                out.append(_windows(group, length))
                group = []
            group.append(item)
        out.append(_windows(group, length))
        return pa.Table.from_pandas(pd.concat(out), preserve_index=False)
    return run


def _windows(group: list[tuple[int, bytes, bytes, bytes]], length: int) -> pd.DataFrame:
    """Contexts whose neighbour shares enough, window by window; equal windows have equal hashes."""
    empty = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("seed", "ctx", "far", "near")})
    if len(group) < 2:
        return empty
    rest = [struct.unpack(REST, g[3]) for g in group]
    far, near = np.array([r[2] for r in rest]), np.array([r[3] for r in rest])
    lcp = np.array([g[0] for g in group] + [0]) - 8
    lcp[0] = -8
    best = np.maximum(lcp[:-1], lcp[1:])
    pick = np.flatnonzero(best + far >= length)  # a window far bytes before the anchor needs length - far after it
    if len(pick) < 2:
        return empty
    pieces = [group[i][2] + group[i][1][8:] for i in pick]
    off = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    far, near = far[pick], near[pick]
    h = C.SpanHash(np.frombuffer(b"".join(pieces), np.uint8))
    n = far - near + 1
    who = np.repeat(np.arange(len(pick)), n)
    r = far[who] - (np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n))
    start = off[who] + far[who] - r
    key = h.of(start, start + length)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = np.flatnonzero(twice)
    if not len(hit):
        return empty
    new = np.concatenate(([True], (who[hit][1:] != who[hit][:-1]) | (hit[1:] != hit[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit)) - 1
    own = [rest[pick[i]] for i in who[hit[first]]]
    return pd.DataFrame({"seed": np.array([x[0] for x in own], np.uint64).view(np.int64), "ctx": np.array([x[1] for x in own], np.uint64).view(np.int64),
                         "far": r[hit[first]], "near": r[hit[last]]})


# ---------------------------------------------------------------- Spark

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    base = C.id_text(docs, id_col, text_col)
    return base.select("_id", F.xxhash64("_id", "_text").alias("k1"), F.xxhash64(F.lit(7), "_id", "_text").alias("k2"), F.coalesce("_text", F.lit("")).alias("_text"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """``k1, k2, spans``: per document (by the hashes of id and text) the repeated byte intervals, ``array<struct<a, e>>``.

    Every step is keyed by seed, context or document, all after equal contexts of a batch have
    been merged; a seed with many contexts is split (``HOT``); a part holds its share of the
    front-coded runs, and the number of parts follows spark.sql.shuffle.partitions.
    """
    if length <= SEED:
        raise ValueError(f"length must be over {SEED}")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs, id_col, text_col).where(F.octet_length("_text") >= length)
    rows = C.written(keyed.select("k1", "k2", "_text").mapInArrow(_scan(length), ROW), "suffix-contexts")
    contexts = rows.where("kind = 0").select("seed", "ctx", "mult", "k1", "k2", "place", "low", "high")
    seeds = contexts.groupBy("seed").agg(F.sum("mult").alias("n")).where("n > 1").select("seed")
    shared = C.written(contexts.join(seeds, "seed", "left_semi"), "suffix-shared")
    by_ctx = shared.groupBy("seed", "ctx").agg(F.sum("mult").alias("n"), F.min(F.struct("k1", "k2", "place", "low", "high")).alias("rep"))
    by_ctx = C.written(by_ctx, "suffix-distinct")
    # contexts seen twice: every window is a repeat
    whole = shared.where("mult = 1").join(by_ctx.where("n > 1").select("seed", "ctx"), ["seed", "ctx"]).select(
        "k1", "k2", F.col("low").alias("a"), (F.col("high") + length).alias("e"))
    # seeds with several contexts: sort their suffixes
    several = by_ctx.groupBy("seed").agg(F.count("*").alias("n_ctx")).where("n_ctx > 1")
    wanted = by_ctx.join(several, "seed").select("rep.k1", "rep.k2", F.struct("seed", "ctx", "n", "n_ctx", "rep.place", "rep.low", "rep.high").alias("w"))
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_list("w").alias("want"))
    texts = keyed.join(wanted, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("_text", "want")
    runs = texts.mapInArrow(_suffixes(length, parts), "part int, run binary")
    found = runs.groupBy("part").applyInArrow(_repeated(length), "seed long, ctx long, far long, near long")
    single = by_ctx.where("n = 1").select("seed", "ctx", "rep.k1", "rep.k2", "rep.place")
    partly = found.join(single, ["seed", "ctx"]).select("k1", "k2", (F.col("place") - F.col("far")).cast("int").alias("a"), (F.col("place") - F.col("near") + length).cast("int").alias("e"))
    local = rows.where("kind = 1").select("k1", "k2", F.col("low").alias("a"), F.col("high").alias("e"))
    every = whole.unionAll(partly).unionAll(local)
    return every.groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "e")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` for every row: maximal removed runs and the bytes left.

    Repeats are judged on the input, in one text or across texts, overlapping ones too; a string that
    spans two texts is none. ``kept`` is binary (a cut may fall inside a character). Null, empty and
    short texts lose nothing; repeated rows repeat each other; null ids are kept; an empty table gives none.
    """
    keyed = _keyed(docs, id_col, text_col)
    spans = C.written(repeated(docs, id_col, text_col, length), "suffix-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small_batches(batches):
            out = []
            for text, given in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
                if not given:
                    out.append((len(text), 0, [], text))
                    continue
                a, e = _merge_intervals(np.array([s["a"] for s in given]), np.array([s["e"] for s in given]))
                edges = [0, *np.stack((a, e), axis=1).ravel().tolist(), len(text)]
                kept = b"".join(text[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
                out.append((len(text), int((e - a).sum()), [{"a": x, "e": y} for x, y in zip(a.tolist(), e.tolist(), strict=True)], kept))
            cols = list(zip(*out, strict=True))
            kind = pa.list_(pa.struct([("a", pa.int32()), ("e", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array([len(s) for s in cols[2]], pa.int64()),
                 pa.array(cols[2], kind), pa.array(cols[3], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    both = keyed.join(spans, ["k1", "k2"], "left").select("_id", "_text", "spans")
    return both.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<a:int,e:int>>, kept binary")
