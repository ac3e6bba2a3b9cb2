"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is coded as its lower-cased words with one blank between them and an end byte. Every
byte is eight binary decisions; decision ``bit`` after the byte's first bits ``prefix`` has a
context tree over the ``DEPTH`` bytes before it. Each node keeps counts of zeros and ones, a
Krichevsky-Trofimov estimate, and the weighted probability ``Pw = (KT + product of the children's
Pw) / 2``; the prediction mixes the estimates of all depths by these weights. The tree is learned
once and then only read, so the code length of a byte depends on its (DEPTH + 1)-byte gram.

Learning and scoring therefore work on distinct grams (and words) of blocks of documents:
blocks send their distinct keys with counts to buckets, buckets add up and answer each block,
and the block's documents look the answers up. Grams are dealt by the two bytes before the
predicted one, so everything below depth two of the tree lies in one bucket; the top of the tree
has at most 65,281 nodes, which are added up by one grouped sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log, pi

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm import common as C

DEPTH = 5
END = 0x0A
WORD, GRAM = 0, 1
#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20


# ---------------------------------------------------------------- coding

def squeeze(x: np.ndarray) -> bytes:
    """Integers as zstandard of their byte planes; sorted 64-bit keys as differences."""
    if x.dtype == np.uint64 and len(x):
        x = np.concatenate((x[:1], np.diff(x)))
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(b: bytes, dtype: np.dtype | type) -> np.ndarray:
    raw, size = zstandard.ZstdDecompressor().decompress(b), np.dtype(dtype).itemsize
    x = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)
    return np.cumsum(x, dtype=np.uint64) if dtype == np.uint64 else x


# ---------------------------------------------------------------- texts to keys

def stream(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, offsets, word hashes, words before each document)``: words, blanks and the end byte of every text."""
    low = C.LOWER[data]
    solid = ~C.SPACE[data]
    starts, ends, at = C.spans(solid, off)
    words = C.SpanHash(low).of(starts, ends)
    keep = solid.copy()
    later = np.ones(len(starts), bool)
    later[at[:-1][np.diff(at) > 0]] = False
    keep[starts[later] - 1] = True
    low[starts[later] - 1] = 0x20
    total = np.concatenate(([0], np.cumsum(keep)))
    size = total[off[1:]] - total[off[:-1]]
    new = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.empty(int(new[-1]), np.uint8)
    ends_at = new[1:] - 1
    body = np.ones(len(out), bool)
    body[ends_at] = False
    out[body] = low[keep]
    out[ends_at] = END
    return out, new, words, at


def grams(text: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For every byte its gram: the ``DEPTH`` bytes before it (end bytes before the text) and itself, lowest."""
    out, before = text.astype(np.uint64), text.astype(np.uint64)
    for k in range(1, DEPTH + 1):
        before = np.concatenate((np.array([END], np.uint64), before[:-1]))
        before[off[:-1]] = END
        out |= before << np.uint64(8 * k)
    return out


def _buckets(kind: int, keys: np.ndarray, n: int) -> np.ndarray:
    part = C.mix64(keys.copy() if kind == WORD else (keys >> np.uint64(8)) & np.uint64(0xFFFF))
    return (part % np.uint64(n)).astype(np.int64)


def _block_keys(texts: pa.Array, train: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per kind the block's distinct keys, sorted, and their counts in training texts."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {WORD: [], GRAM: []}
    for lo, hi in _pieces(texts):
        data, off = C.text_buffer(texts.slice(lo, hi - lo))
        text, new, words, at = stream(data, off)
        learn = train[lo:hi]
        for kind, keys, doc in ((WORD, words, np.repeat(learn, np.diff(at))), (GRAM, grams(text, new), np.repeat(learn, np.diff(new)))):
            every = np.unique(keys)
            some, count = np.unique(keys[doc], return_counts=True)
            full = np.zeros(len(every), np.uint64)
            full[np.searchsorted(every, some)] = count
            held[kind].append((every, full))
    return {kind: _add(parts) for kind, parts in held.items()}


def _pieces(texts: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    _, off = C.text_buffer(texts)
    at = 0
    while at < len(texts):
        to = min(len(texts), max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1))
        yield at, to
        at = to


def _add(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.uint64)])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


# ---------------------------------------------------------------- the tree

_LGAMMA_HALF = np.array([lgamma(i + 0.5) for i in range(4096)])
_LGAMMA_ONE = np.array([lgamma(i + 1.0) for i in range(4096)])


def _log_gamma(n: np.ndarray, shift: float, table: np.ndarray) -> np.ndarray:
    """log gamma(n + shift): a table for small n, Stirling's series beyond (error under 1e-12)."""
    x = np.maximum(n, 4000) + shift
    far = (x - 0.5) * np.log(x) - x + 0.5 * log(2 * pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
    return np.where(n < len(table), table[np.minimum(n, len(table) - 1).astype(np.int64)], far)


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return _log_gamma(zeros, 0.5, _LGAMMA_HALF) + _log_gamma(ones, 0.5, _LGAMMA_HALF) - _log_gamma(zeros + ones, 1.0, _LGAMMA_ONE) - log(pi)


def _level(context: np.ndarray, prefix: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts by (context, prefix): ``(key, zeros, ones)``; the prefix has a leading one, so bits are apart."""
    key = (context << np.uint64(8)) | prefix
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(zeros[order], first), np.add.reduceat(ones[order], first)


def _weigh(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    return np.logaddexp(own, children) - log(2)


def _mask(d: int) -> np.uint64:
    return np.uint64((1 << (8 * d)) - 1)


def subtree(keys: np.ndarray, counts: np.ndarray, bit: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes of one bit position from depth ``DEPTH`` up to 2: ``(key, zeros, ones, log odds of KT over children, log Pw)``."""
    some = counts > 0
    cur, ctx, n = keys[some] & np.uint64(255), keys[some] >> np.uint64(8), counts[some].astype(np.float64)
    prefix = (cur | np.uint64(256)) >> np.uint64(8 - bit)
    one = ((cur >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.float64)
    out = []
    z, o = n * (1 - one), n * one
    key, lpw = np.zeros(0, np.uint64), np.zeros(0)
    for d in range(DEPTH, 1, -1):
        if not len(ctx):
            out.append((key, z, o, lpw, lpw))
            continue
        k, z, o = _level(ctx & _mask(d), prefix, z, o)
        own = kt(z, o)
        if d == DEPTH:
            odds, weighted = np.full(len(k), np.inf), own
        else:
            parent = (((key >> np.uint64(8)) & _mask(d)) << np.uint64(8)) | (key & np.uint64(255))
            below = np.bincount(np.searchsorted(k, parent), weights=lpw, minlength=len(k))
            odds, weighted = own - below, _weigh(own, below)
        out.append((k, z, o, odds, weighted))
        key, lpw = k, weighted
        ctx, prefix = k >> np.uint64(8), k & np.uint64(255)
    return out


def top_sums(keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """What a bucket adds to the nodes of depth one: ``node (byte before, prefix), zeros, ones, log Pw`` sums of its depth-two nodes."""
    rows = []
    for bit in range(8):
        key, z, o, _, lpw = subtree(keys, counts, bit)[-1]
        node = (((key >> np.uint64(8)) & np.uint64(255)) << np.uint64(8) | (key & np.uint64(255))).astype(np.int64)
        rows.append(pd.DataFrame({"node": node, "zeros": z, "ones": o, "lpw": lpw}))
    return pd.concat(rows).groupby("node", as_index=False).sum()


class Top:
    """Depths one and zero: counts and odds as dense arrays by (byte before, prefix) and by prefix."""

    def __init__(self, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        dense = [np.zeros(65536) for _ in range(3)]
        for d, v in zip(dense, (zeros, ones, below), strict=True):
            d[node] = v
        self.zeros, self.ones = dense[0], dense[1]
        seen = dense[0] + dense[1] > 0
        own = np.where(seen, kt(dense[0], dense[1]), 0.0)
        self.odds = own - dense[2]
        weighted = np.where(seen, _weigh(own, dense[2]), 0.0).reshape(256, 256).sum(axis=0)
        self.root_zeros, self.root_ones = (x.reshape(256, 256).sum(axis=0) for x in (self.zeros, self.ones))
        self.root_odds = kt(self.root_zeros, self.root_ones) - weighted


def _mix(odds: np.ndarray, own: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """The node's estimate and the deeper prediction, weighed by the node's odds."""
    w = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
    return w * own + (1 - w) * deeper


def log10_probability(keys: np.ndarray, counts: np.ndarray, top: Top) -> np.ndarray:
    """log10 of P(byte | context) for each gram of a bucket; a path ends at the deepest node with a count."""
    total = np.zeros(len(keys))
    cur, ctx = keys & np.uint64(255), keys >> np.uint64(8)
    for bit in range(8):
        prefix = (cur | np.uint64(256)) >> np.uint64(8 - bit)
        one = ((cur >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        p = np.full(len(keys), np.nan)

        def estimate(z: np.ndarray, o: np.ndarray, one: np.ndarray = one) -> np.ndarray:
            return (np.where(one, o, z) + 0.5) / (z + o + 1)

        for d, (k, z, o, odds, _) in zip(range(DEPTH, 1, -1), subtree(keys, counts, bit), strict=True):
            if not len(k):
                continue
            want = ((ctx & _mask(d)) << np.uint64(8)) | prefix
            at = np.minimum(np.searchsorted(k, want), len(k) - 1)
            found = k[at] == want
            own = estimate(z[at], o[at])
            p = np.where(found, np.where(np.isnan(p), own, _mix(odds[at], own, p)), p)
        at = ((ctx & np.uint64(255)) << np.uint64(8) | prefix).astype(np.int64)
        z, o = top.zeros[at], top.ones[at]
        own = estimate(z, o)
        p = np.where(z + o > 0, np.where(np.isnan(p), own, _mix(top.odds[at], own, p)), p)
        at = prefix.astype(np.int64)
        own = estimate(top.root_zeros[at], top.root_ones[at])
        p = np.where(np.isnan(p), own, _mix(top.root_odds[at], own, p))
        total += np.log10(p)
    return total


# ---------------------------------------------------------------- Spark

def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, code_bits_per_byte`` for every row.

    Learns from the rows whose ``crc32(id as text) mod folds`` is not ``held_out``, scores all.
    Tokens are the lower-cased words ``[^\\x20\\x09-\\x0D]+`` and one end. ``base_score``: the sum over tokens of
    log10((c + 0.5) / (N + 0.5 (V + 1))); ``score``: the log10 probability of the words (one blank
    between) and the end byte under the weighted context trees. Null and empty texts are an end alone;
    null ids are kept (fold of the empty text); repeated rows give repeated rows; without training
    rows every bit has probability 1/2; an empty table gives none.

    Documents are dealt to blocks by a hash of (id, text), so a hot id or source spreads; a
    block's keys and answers move as packed arrays, never a row per word.
    """
    spark = docs.sparkSession
    base = C.id_text(docs, id_col, text_col)
    n = C.blocks_for(base, "_text", block_bytes)
    train = C.fold_of(F.col("_id"), folds) != held_out
    dealt = base.select("_id", F.coalesce("_text", F.lit("")).alias("_text"), train.alias("train"), F.pmod(F.xxhash64("_id", "_text"), F.lit(n)).cast("int").alias("block"))

    def keys_of(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        texts = table.column("_text").combine_chunks()
        learn = table.column("train").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        rows = []
        for kind, (keys, counts) in _block_keys(texts, learn).items():
            bucket = _buckets(kind, keys, n)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n + 1))
            for b in range(n):
                own = order[cuts[b]:cuts[b + 1]]
                if len(own):
                    rows.append((kind, b, key[0].as_py(), squeeze(keys[own]), squeeze(counts[own].astype(np.uint32))))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                        names=["kind", "bucket", "block", "keys", "counts"])

    sent = C.written(dealt.groupBy("block").applyInArrow(keys_of, "kind int, bucket int, block int, keys binary, counts binary"), "ctw-keys")
    # N and V of the words, the ends, and the top of the tree
    ends = dealt.where("train").count()

    def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        parts = [(unsqueeze(k, np.uint64), unsqueeze(c, np.uint32).astype(np.uint64)) for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True)]
        return _add(parts)

    def sums(key: tuple[pa.Scalar, pa.Scalar], table: pa.Table) -> pa.Table:
        keys, counts = merged(table)
        if key[0].as_py() == WORD:
            return pa.table({"node": pa.array([-1], pa.int64()), "zeros": pa.array([float((counts > 0).sum())]), "ones": pa.array([float(counts.sum())]), "lpw": pa.array([0.0])})
        return pa.Table.from_pandas(top_sums(keys, counts), preserve_index=False)

    added = sent.groupBy("kind", "bucket").applyInArrow(sums, "node long, zeros double, ones double, lpw double")
    top = added.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "lpw")]).toPandas()  # at most 65,282 rows
    words = top[top["node"] < 0]
    v, total = (float(words["zeros"].iloc[0]), float(words["ones"].iloc[0])) if len(words) else (0.0, 0.0)
    v, total = v + (ends > 0), total + ends
    nodes = top[top["node"] >= 0]
    tree = spark.sparkContext.broadcast(tuple(nodes[c].to_numpy() for c in ("node", "zeros", "ones", "lpw")))
    floor = total + 0.5 * (v + 1)

    def answers(key: tuple[pa.Scalar, pa.Scalar], table: pa.Table) -> pa.Table:
        kind = key[0].as_py()
        keys, counts = merged(table)
        value = counts.astype(np.float64) if kind == WORD else log10_probability(keys, counts, Top(*tree.value))
        packed = [squeeze(value[np.searchsorted(keys, unsqueeze(k, np.uint64))].astype(np.uint32 if kind == WORD else np.float32)) for k in table.column("keys").to_pylist()]
        return pa.table([table.column("kind"), table.column("bucket"), table.column("block"), pa.array(packed, pa.binary())], names=["kind", "bucket", "block", "answer"])

    replies = sent.groupBy("kind", "bucket").applyInArrow(answers, "kind int, bucket int, block int, answer binary")

    def looked_up(docs_of: pa.Table, replies_of: pa.Table) -> pa.Table:
        texts = docs_of.column("_text").combine_chunks() if docs_of.num_rows else pa.array([], pa.string())
        learn = np.zeros(len(texts), bool)
        known = {kind: keys for kind, (keys, _) in _block_keys(texts, learn).items()}
        value = {}
        for kind, keys in known.items():
            bucket = _buckets(kind, keys, n)
            order = np.argsort(bucket, kind="stable")
            rows = sorted((b, a) for k, b, a in zip(*(replies_of.column(c).to_pylist() for c in ("kind", "bucket", "answer")), strict=True) if k == kind)
            got = [unsqueeze(a, np.uint32 if kind == WORD else np.float32).astype(np.float64) for _, a in rows]
            value[kind] = np.empty(len(keys))
            value[kind][order] = np.concatenate(got) if got else np.zeros(0)
        out = []
        for lo, hi in _pieces(texts):
            data, off = C.text_buffer(texts.slice(lo, hi - lo))
            text, new, words_, at = stream(data, off)
            c = value[WORD][np.searchsorted(known[WORD], words_)]
            g = value[GRAM][np.searchsorted(known[GRAM], grams(text, new))]
            sums_ = [np.concatenate(([0.0], np.cumsum(x))) for x in (np.log10((c + 0.5) / floor), c > 0)]
            tokens = np.diff(at) + 1
            base_score = sums_[0][at[1:]] - sums_[0][at[:-1]] + np.log10((ends + 0.5) / floor)
            out.append((tokens, (sums_[1][at[1:]] - sums_[1][at[:-1]]).astype(np.int64) + (ends > 0), base_score, np.add.reduceat(g, new[:-1]), np.diff(new)))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table([docs_of.column("_id"), docs_of.column("train"), pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2]), pa.array(cols[3]),
                         pa.array(-cols[3] / np.log10(2) / cols[4])], names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score", "code_bits_per_byte"])

    found = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        looked_up, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double, code_bits_per_byte double")
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"),
                        "base_score", "score", "code_bits_per_byte")
