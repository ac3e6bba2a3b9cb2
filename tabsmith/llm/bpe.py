"""Byte-level BPE by overlapping chunks, and decoding.

A text longer than ``chunk_chars`` is cut into chunks that overlap. Each chunk is split into
pre-tokens and encoded on its own, in parallel. A pre-token match depends only on what follows
its start, so as soon as two neighbouring chunks share a boundary inside the overlap they agree
from there on: the text's ids are chunk ``k``'s up to that boundary and chunk ``k + 1``'s after
it. Where a pre-token is longer than the overlap, the stitching step splits on from the last
sure boundary until a boundary is shared again. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm import common as C

#: Pieces remembered by a worker; the table is emptied when it is full (about 30 MB).
CACHE = 1 << 17
#: A boundary this close to the end of a cut chunk may move when the text goes on.
UNSURE = 3


class Bpe:
    """Pre-token pattern and ranks of one tokenizer, with the ids of pieces seen lately."""

    def __init__(self, ranks_path: str, pattern: str, odd: tuple[tuple[int, int], ...] = ()):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.seen: dict[str, bytes] = {}
        self.odd = re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in odd) + "]").search if odd else lambda text: None

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def ids(self, pieces: list[str]) -> list[bytes]:
        """For each piece its ids as little-endian 32-bit integers."""
        seen = self.seen
        try:
            return [seen[p] for p in pieces]
        except KeyError:
            pass
        if len(seen) > CACHE:
            seen.clear()
        single = self.encoding._encode_single_piece
        for p in set(pieces).difference(seen):
            seen[p] = np.array(single(p), "<u4").tobytes()
        return [seen[p] for p in pieces]

    def encode(self, text: str) -> bytes:
        if not text.isascii() and self.odd(text):
            return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()
        return b"".join(self.ids(self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def tokenizer(ranks_path: str, pattern: str, odd: tuple[tuple[int, int], ...] = ()) -> Bpe:
    return Bpe(ranks_path, pattern, odd)


@lru_cache(maxsize=4)
def odd_characters(pattern: str) -> tuple[tuple[int, int], ...]:
    """Ranges of characters that ``regex`` and the tokenizer library class differently (their Unicode tables differ in age).

    Every code point that ``regex`` does not class as Unicode 3.2 did is split between a letter, a
    digit, a sign and blanks by both; two-byte ranks around it make a differing split visible.
    """
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    old = unicodedata.ucd_3_2_0.category
    classes = {c: kind for kind in ("L", "N") for c in regex.findall(rf"\p{{{kind}}}", "".join(map(chr, points)))}
    points = [c for c in points if classes.get(chr(c), "") != (old(chr(c))[0] if old(chr(c))[0] in "LN" else "") or chr(c).isspace()]
    ranks = {bytes([b]): b for b in range(256)}
    for b in range(256):
        for side in b"a1!":
            for pair in (bytes([side, b]), bytes([b, side])):
                ranks.setdefault(pair, len(ranks))
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    split = regex.compile(pattern)

    def differs(c: int) -> bool:
        text = f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}! {chr(c)}a\n"
        own = [i for p in split.findall(text) for i in probe._encode_single_piece(p)]
        return own != probe.encode_ordinary(text)

    found: list[list[int]] = []
    for c in points:
        if differs(c):
            if found and found[-1][1] == c - 1:
                found[-1][1] = c
            else:
                found.append([c, c])
    return tuple((a, b) for a, b in found)


def cut(text: str, chunk_chars: int, overlap: int) -> list[str]:
    """Chunk ``k`` starts at ``k * chunk_chars`` and reaches ``overlap`` characters into the next."""
    return [text[a:a + chunk_chars + overlap] for a in range(0, max(1, len(text)), chunk_chars)]


def stitch(bpe: Bpe, chunks: list[str], ends: list[np.ndarray], ids: list[list[bytes]], chunk_chars: int, overlap: int) -> bytes:
    """Ids of the whole text. ``ends[k]`` are the ends of chunk ``k``'s pieces, from the chunk's start."""
    out: list[bytes] = []
    last = len(chunks) - 1
    k, at = 0, 0  # pieces of chunk k from absolute position at on are right
    while True:
        here = ends[k] + k * chunk_chars
        first = int(np.searchsorted(here, at, side="right"))
        if k == last:
            return b"".join(out + ids[k][first:])
        sure = here[first:]
        sure = sure[sure <= k * chunk_chars + len(chunks[k]) - UNSURE]
        nxt = np.concatenate(([0], ends[k + 1])) + (k + 1) * chunk_chars
        shared = np.intersect1d(np.append(sure, at), nxt)
        if len(shared):
            upto = int(np.searchsorted(here, shared[0], side="right"))
            out += ids[k][first:upto]
            k, at = k + 1, int(shared[0])
            continue
        # a piece longer than the overlap: split on from the last sure boundary
        out += ids[k][first:first + len(sure)]
        at = int(sure[-1]) if len(sure) else at
        m = k + 1
        while True:
            joined = chunks[k][at - k * chunk_chars:chunk_chars] if at < (k + 1) * chunk_chars else ""
            tail = "".join(chunks[x][:chunk_chars] for x in range(k + 1, m))
            skip = max(0, at - (k + 1) * chunk_chars)
            text = joined + (tail + chunks[m])[skip:]
            pieces = bpe.pieces(text)
            done = np.cumsum([len(p) for p in pieces]) + at
            if m == last:
                return b"".join(out + bpe.ids(pieces))
            sure = done[done <= m * chunk_chars + len(chunks[m]) - UNSURE]
            nxt = np.concatenate(([0], ends[m + 1])) + (m + 1) * chunk_chars
            shared = np.intersect1d(sure, nxt)
            if len(shared):
                out += bpe.ids(pieces[:int(np.searchsorted(done, shared[0], side="right"))])
                k, at = m + 1, int(shared[0])
                break
            m += 1


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_chars: int = 1 << 16, overlap: int = 256, decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` for every row: ids as little-endian unsigned 32-bit integers in a binary.

    With ``decoded`` a third column has the bytes decoded from the ids, in the same task.

    Each match of ``pattern`` is encoded by itself; no special tokens. Null and empty texts have
    an empty binary; repeated rows give repeated rows; null ids are kept; an empty table gives
    none. A text with a character that the two pattern engines class differently is encoded
    by the library in one piece. Chunks of long texts are dealt over the cluster by (id, text hash, chunk number) and
    only the pieces of one text meet again, so a long text costs no task more than its own ids.
    """
    base = C.id_text(docs, id_col, text_col)
    odd = odd_characters(pattern)
    fields = ["doc_id", "ids"] + ["decoded"] * decoded
    more = ", decoded binary" * decoded

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks_path, pattern, odd)
        for b in C.small_batches(batches, max_bytes=1 << 20):
            ids = [bpe.encode(t) if t else b"" for t in b.column(1).to_pylist()]
            out = [b.column(0), pa.array(ids, pa.binary())] + ([pa.array(map(bpe.decode, ids), pa.binary())] if decoded else [])
            yield pa.RecordBatch.from_arrays(out, names=fields)

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small_batches(batches, max_bytes=2 << 20):
            for i, h, n, text in zip(*(c.to_pylist() for c in (b.column(0), b.column(2), b.column(3), b.column(1))), strict=True):
                parts = cut(text, chunk_chars, overlap)
                m = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * m, pa.int64()), pa.array([h] * m, pa.int64()), pa.array([n] * m, pa.int64()),
                     pa.array(range(m), pa.int32()), pa.array(parts, pa.string())], names=["doc_id", "h", "n", "k", "part"])

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks_path, pattern, odd)
        for b in C.small_batches(batches, text=4, max_bytes=2 << 20):
            ends, sizes, ids = [], [], []
            for part in b.column(4).to_pylist():
                pieces = bpe.pieces(part)
                got = bpe.ids(pieces)
                ends.append(np.cumsum([len(p) for p in pieces]).astype("<i4").tobytes())
                sizes.append(np.array([len(x) for x in got], "<i4").tobytes())
                ids.append(b"".join(got))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, pa.binary()) for x in (ends, sizes, ids))],
                                             names=["doc_id", "h", "n", "k", "part", "ends", "sizes", "ids"])

    def stitched(pdf: pd.DataFrame) -> pd.DataFrame:
        bpe = tokenizer(ranks_path, pattern, odd)
        pdf = pdf.sort_values("k")
        ids = []
        for sizes, blob in zip(pdf["sizes"], pdf["ids"], strict=True):
            at = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, "<i4"))))
            ids.append([blob[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
        ends = [np.frombuffer(x, "<i4").astype(np.int64) for x in pdf["ends"]]
        out = stitch(bpe, pdf["part"].tolist(), ends, ids, chunk_chars, overlap)
        row = {"doc_id": pdf["doc_id"].iloc[:1], "n": pdf["n"].iloc[:1], "ids": [out]}
        return pd.DataFrame(row | ({"decoded": [bpe.decode(out)]} if decoded else {}))

    long = F.length("_text") > chunk_chars
    if odd:  # texts with such a character go through the library whole
        long = long & ~F.col("_text").rlike("[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in odd) + "]")
    whole = base.where(~F.coalesce(long, F.lit(False))).mapInArrow(short, "doc_id long, ids binary" + more)
    # equal rows are encoded once and repeated afterwards
    many = base.where(long).groupBy("_id", F.xxhash64("_text").alias("h"), F.sha2("_text", 256).alias("s")).agg(
        F.count("*").alias("n"), F.first("_text").alias("_text")).select("_id", "_text", F.xxhash64("h", "s").alias("h"), "n")
    chunks = many.mapInArrow(chunked, "doc_id long, h long, n long, k int, part string").repartition("doc_id", "h", "k")
    tokens = chunks.mapInArrow(pretokenise, "doc_id long, h long, n long, k int, part string, ends binary, sizes binary, ids binary")
    joined = tokens.groupBy("doc_id", "h").applyInPandas(stitched, "doc_id long, n long, ids binary" + more)
    again = joined.select(*fields, F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(*fields)
    return whole.unionAll(again)


def decode(ids: Column, ranks_path: str, pattern: str) -> Column:
    """The raw bytes of a binary of ids (null: empty)."""
    @F.arrow_udf("binary")
    def of(col: pa.Array) -> pa.Array:
        bpe = tokenizer(ranks_path, pattern)
        return pa.array([bpe.decode(x or b"") for x in col.to_pylist()], pa.binary())

    return of(ids)
