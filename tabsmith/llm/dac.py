"""Token ids on disk as directly addressable codes.

A segment holds the ids of consecutive documents. Each id is split into 8-bit chunks, lowest
first; level ``k`` holds the ``k``-th chunk of every id that has one, a continuation bitmap
tells which of them go on, and a rank directory (ones before every 512th bit) finds an id's
place in the next level. Any token is reached by one byte, one bit and one rank per level,
without decoding a block; the files keep segments as they are, neither compressed nor in a
dictionary, and ``token_at`` goes from places among all ids to the segments that hold them.

Segment layout, little-endian: ``DAC1``, u32 documents, u64 ids, u32 levels; i64 document ids
(the least long for null), u64 ids per document; per level u64 entries, the chunks, the bitmap (entries / 8, rounded up)
and the directory (u64 per 512 entries).
"""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm import common as C

MAGIC = b"DAC1"
BLOCK = 512
NULL_ID = -(1 << 63)
#: Words remembered by a worker; the table is emptied when it is full.
CACHE = 3 << 18
#: ASCII signs; one or more at the end of a run, after a letter, are a pre-token of their own.
SIGNS = string.punctuation.replace("<", "").encode()
#: The pre-token pattern whose pieces lie within white-space-free runs (``splits_at_space``).
RUN_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


# ---------------------------------------------------------------- one segment

def pack(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(np.bitwise_count(bits).astype(np.uint64), np.arange(0, len(bits), BLOCK // 8)) if len(bits) else np.zeros(0, np.uint64)
        before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u8") if len(ones) else np.zeros(0, "<u8")
        levels.append(len(rest).to_bytes(8, "little") + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + before.tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            break
    head = MAGIC + len(doc_ids).to_bytes(4, "little") + len(ids).to_bytes(8, "little") + len(levels).to_bytes(4, "little")
    return head + doc_ids.astype("<i8").tobytes() + counts.astype("<u8").tobytes() + b"".join(levels)


class Segment:
    """Reader of one segment; nothing is decoded until asked for."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC1 segment")
        docs, self.n, levels = (int.from_bytes(payload[a:b], "little") for a, b in ((4, 8), (8, 16), (16, 20)))
        at = 20
        self.doc_ids = np.frombuffer(payload, "<i8", docs, at)
        self.counts = np.frombuffer(payload, "<u8", docs, at + 8 * docs).astype(np.int64)
        at += 16 * docs
        self.levels = []
        for _ in range(levels):
            m = int.from_bytes(payload[at:at + 8], "little")
            chunks = np.frombuffer(payload, np.uint8, m, at + 8)
            bits = np.frombuffer(payload, np.uint8, -(-m // 8), at + 8 + m)
            before = np.frombuffer(payload, "<u8", -(-m // BLOCK), at + 8 + m + len(bits))
            self.levels.append((chunks, bits, before))
            at += 8 + m + len(bits) + 8 * len(before)

    def at(self, positions: np.ndarray) -> np.ndarray:
        """Ids at any positions of the segment."""
        pos = np.asarray(positions, np.int64)
        if len(pos) and (pos.min() < 0 or pos.max() >= self.n):
            raise IndexError("token position")
        out, who, shift = np.zeros(len(pos), np.uint32), np.arange(len(pos)), 0
        for chunks, bits, before in self.levels:
            out[who] |= chunks[pos].astype(np.uint32) << np.uint32(shift)
            go = ((bits[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1).astype(bool)
            who, pos, shift = who[go], pos[go], shift + 8
            if not len(pos):
                break
            pos = self._rank(bits, before, pos)
        return out

    @staticmethod
    def _rank(bits: np.ndarray, before: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Ones before each position: the directory, then the bytes of its block, then the bits of its byte."""
        block = pos // BLOCK
        padded = np.concatenate((bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)))
        lanes = padded.reshape(-1, BLOCK // 8)[block]
        inside = pos[:, None] - block[:, None] * BLOCK - 8 * np.arange(BLOCK // 8)
        mask = ((1 << np.clip(inside, 0, 8)) - 1).astype(np.uint8)
        return before[block].astype(np.int64) + np.bitwise_count(lanes & mask).sum(axis=1, dtype=np.int64)

    def all(self) -> np.ndarray:
        """Every id, deepest level first."""
        out = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            go = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            value[go] |= out << np.uint32(8)
            out = value
        return out


# ---------------------------------------------------------------- encoding

def splits_at_space(spec: dict) -> bool:
    """Does a tokenizer file's text part promise what ``WordTokenizer`` needs to encode run by run?

    Known to do so: Unicode composition, white space to one blank and lower-casing, then pre-tokens cut
    out by a pattern whose alternatives are contractions, letters, one digit and other signs, and their
    bytes as they are; no added token holds white space or is stripped around, and none but those with
    ``<`` in them is taken out of the text first.
    """
    normal = (spec.get("normalizer") or {}).get("normalizers") or []
    cut = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [n.get("type") for n in normal] != ["NFC", "Replace", "Lowercase"] or [c.get("type") for c in cut] != ["Split", "ByteLevel"]:
        return False
    spaces = normal[1].get("pattern") == {"Regex": r"\s+"} and normal[1].get("content") == " "
    split, level = cut
    pieces = (split.get("pattern") or {}).get("Regex") == RUN_PIECES and split.get("behavior") == "Removed" and split.get("invert") is True
    whole = level.get("add_prefix_space") is False and level.get("use_regex") is False
    added = all("<" in t["content"] and not t["lstrip"] and not t["rstrip"] and not any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens") or [])
    return spaces and pieces and whole and added


class WordTokenizer:
    """Whole texts by a tokenizer of the library, given as the bytes of its file.

    Where it lower-cases and its pre-tokens cross neither ASCII white space nor a letter and a sign
    (``by_runs``), the ids of a text are those of its white-space-free runs side by side, and a run that
    ends in a letter and ``SIGNS`` is the run before them and those signs; each distinct run is
    encoded once while it is remembered. New runs are encoded many to a text, with a control
    character between them whose id marks the cuts. Any other tokenizer gets the texts whole.
    """

    MARK = b"\x01"

    def __init__(self, blob: bytes, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(blob)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.end = np.array([end_id], "<u4").tobytes()
        self.by_runs = splits_at_space(json.loads(blob))
        if self.by_runs:
            marks = self.tokenizer.encode(self.MARK.decode(), add_special_tokens=False).ids
            self.by_runs, self.mark = len(marks) == 1, marks[0] if marks else None
        self.seen: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids with the end id, as little-endian 32-bit integers."""
        if not self.by_runs:
            done = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() + self.end for e in done]
        runs = [(t if b"<" in t else t.lower()).split() for t in texts]  # a special token keeps its case
        if len(self.seen) > CACHE:
            self.seen.clear()
        seen = self.seen
        new = set(filterfalse(seen.__contains__, chain.from_iterable(runs)))
        bare = {w: self._bare(w) for w in new}
        self._learn([w for w in set(chain.from_iterable(bare.values())) if w and w not in seen])
        for w, (stem, sign) in bare.items():
            if w is not stem:
                seen[w] = seen[stem] + seen[sign]
        return [b"".join(map(seen.__getitem__, r)) + self.end for r in runs]

    @staticmethod
    def _bare(run: bytes) -> tuple[bytes, bytes]:
        """The run (in small letters) without the signs after its last letter, and those signs."""
        if b"<" in run:
            return run, b""
        stem = run.rstrip(SIGNS)
        # U+00C0 to U+00FF are letters but for the signs of multiplication and division
        if len(stem) in (0, len(run)) or not (stem[-1:].isalpha() or stem[-2:-1] == b"\xc3" and stem[-1] not in b"\x97\xb7"):
            return run, b""
        return stem, run[len(stem):]

    def _learn(self, runs: list[bytes]) -> None:
        odd = [r for r in runs if self.MARK in r]
        plain = [r for r in runs if self.MARK not in r] if odd else runs
        groups = [plain[k:k + 256] for k in range(0, len(plain), 256)] + [[r] for r in odd]
        between = b" " + self.MARK + b" "
        for k in range(0, len(groups), 64):
            part = groups[k:k + 64]
            done = self.tokenizer.encode_batch_fast([between.join(g).decode() for g in part], add_special_tokens=False)
            for group, e in zip(part, done, strict=True):
                ids = np.array(e.ids, "<u4")
                cuts = np.flatnonzero(ids == self.mark) if len(group) > 1 else np.zeros(0, np.int64)
                blob = ids.tobytes()
                for r, a, z in zip(group, [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(blob)], strict=True):
                    self.seen[r] = blob[a:z]


@lru_cache(maxsize=4)
def word_tokenizer(blob: bytes, end_id: int) -> WordTokenizer:
    return WordTokenizer(blob, end_id)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 segment_tokens: int = 1 << 20) -> None:
    """Encode every row of ``docs`` and write the ids to ``path`` in ascending id order.

    Files are Parquet rows ``(part, seq, n_docs, n_tokens, payload)``, one per segment of about
    ``segment_tokens`` ids, its payload stored plainly; (part, seq) ascend with the id. The driver reads
    the tokenizer file and sends its bytes to the tasks. Null texts are empty (the end id
    alone); null ids come first; rows of equal id are ordered by text hash, repeated rows are
    written as often as they occur. Rows are dealt by ranges of (id, text hash, row), so equal
    ids do not have to meet in one task. An empty table writes no segment.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with open(tokenizer_path, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())  # one tokenizer file, a few MB whatever the input
    base = C.id_text(docs, id_col, text_col).withColumn("_h", F.xxhash64("_text"))
    ordered = base.repartitionByRange(parts, "_id", "_h", F.monotonically_increasing_id()).sortWithinPartitions("_id", "_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, seq = word_tokenizer(sent.value, end_id), TaskContext.get().partitionId(), 0
        ids: list[int] = []
        blobs: list[bytes] = []
        held = 0

        def segment() -> pa.RecordBatch:
            counts = np.array([len(x) // 4 for x in blobs], np.int64)
            payload = pack(np.array(ids, np.int64), counts, np.frombuffer(b"".join(blobs), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()),
                                               pa.array([held], pa.int64()), pa.array([payload], pa.large_binary())],
                                              names=["part", "seq", "n_docs", "n_tokens", "payload"]).cast(schema)

        for b in C.small_batches(batches):
            texts = [x or b"" for x in b.column(1).cast(pa.binary()).to_pylist()]
            for i, blob in zip(b.column(0).to_pylist(), tok.encode(texts), strict=True):
                ids.append(NULL_ID if i is None else i)
                blobs.append(blob)
                held += len(blob) // 4
                if held >= segment_tokens:
                    yield segment()
                    ids, blobs, held, seq = [], [], 0, seq + 1
        if ids:
            yield segment()

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])
    out = ordered.select("_id", "_text").mapInArrow(run, "part int, seq int, n_docs long, n_tokens long, payload binary")
    # the ids are coded already: a page that had to be unpacked first would not be directly addressable
    out.write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The segments ``(part, seq, payload)`` and ``(part, seq, at)``: the ids written before each.

    Starts come from the segments' counts alone (the payload column is not read for them): a
    running sum over parts, of which there are as many rows as write tasks, then within a part.
    """
    files = spark.read.parquet(path)
    part = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    part = part.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    inner = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    starts = files.select("part", "seq", inner.alias("inner")).join(part, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("at"))
    return files.select("part", "seq", "payload"), starts


def documents(segments: DataFrame, starts: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` decoded from the segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = Segment(payload)
                ids, ends = s.all().astype("<u4"), np.cumsum(s.counts)
                crc = [zlib.crc32(ids[a:z].data) for a, z in zip((ends - s.counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ends), pa.int32()), pa.array([seq] * len(ends), pa.int32()),
                     pa.array(s.doc_ids, mask=s.doc_ids == NULL_ID), pa.array(ends - s.counts), pa.array(s.counts), pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"])

    rows = segments.mapInArrow(run, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "seq"]).select("doc_id", (F.col("at") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_at(spark: SparkSession, path: str, positions: DataFrame, column: str = "position", span: int = 1 << 20) -> DataFrame:
    """``position, token``: the id at each distinct place of ``positions`` among all ids of the files.

    Segments and places meet by blocks of ``span`` ids (a segment is in the blocks it reaches into), from
    the segments' counts alone; a second join brings the payloads of the segments that were asked for to
    their places, where each is read by chunk, bit and rank. A null, negative or too great place gives a
    null token; repeated places give one row; without segments every token is null.
    """
    segments, starts = read_tokens(spark, path)
    want = positions.select(F.col(f"`{column}`").cast("long").alias("position")).distinct()
    sizes = spark.read.parquet(path).select("part", "seq", "n_tokens")
    held = starts.join(sizes, ["part", "seq"]).where(F.col("n_tokens") > 0)
    last = F.col("at") + F.col("n_tokens") - 1
    held = held.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / span), F.floor(last / span))))
    asked = want.where(F.col("position") >= 0).withColumn("block", F.floor(F.col("position") / span))
    local = F.col("position") - F.col("at")
    places = asked.join(held, "block").where((local >= 0) & (local < F.col("n_tokens"))).select("part", "seq", "position", local.alias("local"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"position": pa.array([], pa.int64()), "token": pa.array([], pa.int64())}
        if left.num_rows and right.num_rows:
            token = Segment(right["payload"][0].as_py()).at(left["local"].to_numpy())
            out = {"position": left["position"].combine_chunks(), "token": pa.array(token.astype(np.int64))}
        return pa.table(out)

    wanted = places.select(F.col("part").alias("p"), F.col("seq").alias("s")).distinct()
    own = segments.select(F.col("part").alias("p"), F.col("seq").alias("s"), "payload").join(wanted, ["p", "s"], "left_semi")
    got = places.groupBy("part", "seq").cogroup(own.groupBy("p", "s")).applyInArrow(run, "position long, token long")
    return want.join(got, "position", "left")
