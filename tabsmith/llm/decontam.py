"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and non-ASCII characters of the lower-cased text. One scan
counts in how many surroundings of training texts each run of ``SHORT`` words of the test items
occurs; the rare runs are seeds, and so is every run of ``GRAM`` words. A second scan cuts the
passages around the seeds. Seeds join passages to items; a distinct (passage, item) is aligned
once, and only if enough of the item's words occur in the passage to reach the limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm import common as C

#: Words of a seed, and of a seed that must be rare.
GRAM, SHORT = 4, 3
#: A short run is rare while the pairs of words around it are at most ``RARE``, or one to ``RARE_SHARE`` texts if
#: that is more (counted by HyperLogLog). Copies have equal surroundings, so many copies of an item leave it rare.
RARE, RARE_SHARE = 32, 1000
#: Alignment scores, the least share of an item's own score, and the least words matched (or all of a shorter item).
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE, LEAST_WORDS = 0.6, 8
#: Item n-grams looked up in one scan of the texts (16 bytes each in a broadcast); more take more scans.
BLOCK = 1 << 20
#: Up to so many flagged ids (8 bytes each) are broadcast when their documents are taken out.
BROADCAST_IDS = 1 << 20

WORD = np.zeros(256, bool)
WORD[ord("0"):ord("9") + 1] = WORD[ord("a"):ord("z") + 1] = WORD[128:] = True


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, at = C.spans(WORD[data], off)
    return starts, ends, at, C.SpanHash(data).of(starts, ends)


def _grams(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of runs of ``size`` words that lie in one text, and their hashes."""
    m = len(words) - size + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pos = np.flatnonzero(doc[:m] == doc[size - 1:])
    return pos, C.chain([words[pos + k] for k in range(size)])


def _item_grams(items: DataFrame) -> DataFrame:
    """``item_id, words, size, gram`` of the items of at least ``GRAM`` words (one row per run)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small_batches(batches):
            data, off = C.text_buffer(b.column(1))
            _, _, at, words = _words(data, off)
            for size in (SHORT, GRAM):
                pos, gram = _grams(words, at, size)
                doc = np.searchsorted(at, pos, side="right") - 1
                n = np.diff(at)[doc]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(n), pa.array(np.full(len(n), size)), pa.array(gram.view(np.int64))],
                                                 names=["item_id", "words", "size", "gram"]).filter(pa.array(n >= GRAM))

    return items.select("item_id", "text").mapInArrow(run, "item_id long, words long, size long, gram long")


def _tables(grams: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The runs of ``gram, words`` in blocks of about ``BLOCK``: sorted hashes, and the longest item of each."""
    distinct = grams.groupBy("gram").agg(F.max("words").alias("reach"))
    blocks = max(1, -(-distinct.count() // BLOCK))
    for k in range(blocks):
        part = distinct.where(F.pmod("gram", F.lit(blocks)) == k).toPandas()  # about BLOCK rows
        table, reach = part["gram"].to_numpy(np.int64).view(np.uint64), part["reach"].to_numpy(np.int64)
        order = np.argsort(table)
        if len(table):
            yield table[order], reach[order]


def _filter(table: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 22, bool)
    bits[(table & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
    return bits


def _known(words: np.ndarray, at: np.ndarray, size: int, table: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, hashes and places in ``table`` of the known runs of ``size`` words."""
    pos, gram = _grams(words, at, size)
    maybe = bits[(gram & np.uint64((1 << 22) - 1)).astype(np.int64)]
    pos, gram = pos[maybe], gram[maybe]
    k = np.minimum(np.searchsorted(table, gram), len(table) - 1)
    hit = table[k] == gram
    return pos[hit], gram[hit], k[hit]


def _surroundings(texts: DataFrame, grams: np.ndarray) -> DataFrame:
    """``gram, around``: the known short runs with a hash of the word before and the word after."""
    known = texts.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        bits = _filter(table)
        for b in C.small_batches(batches):
            data, off = C.text_buffer(b.column(1))
            _, _, at, words = _words(data, off)
            pos, gram, _ = _known(words, at, SHORT, table, bits)
            doc = np.searchsorted(at, pos, side="right") - 1
            beside = np.concatenate((words, np.zeros(1, np.uint64)))
            before = np.where(pos > at[doc], beside[pos - 1], np.uint64(0))
            after = np.where(pos + SHORT < at[doc + 1], beside[np.minimum(pos + SHORT, len(words))], np.uint64(0))
            pairs = np.unique(np.stack((gram, C.chain([before, after])), 1), axis=0) if len(pos) else np.zeros((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], names=["gram", "around"])

    return texts.mapInArrow(run, "gram long, around long")


def _seeds(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, words, gram``: every run of ``GRAM`` words of the items and their rare runs of ``SHORT`` words.

    A run that no text holds finds nothing and is left out.
    """
    grams = C.written(_item_grams(items), "decontam-grams")
    short = grams.where(F.col("size") == SHORT)
    found = None
    for table, _ in _tables(short):
        one = _surroundings(texts, table)
        found = one if found is None else found.unionAll(one)
    seeds = grams.where(F.col("size") == GRAM)
    if found is not None:
        ways = C.written(found.groupBy("gram").agg(F.approx_count_distinct("around").alias("ways")), "decontam-ways")
        limit = max(RARE, texts.count() // RARE_SHARE)
        seeds = seeds.unionByName(short.join(ways.where(F.col("ways") <= limit).select("gram"), "gram", "left_semi"))
    return C.written(seeds.select("item_id", "words", "gram").distinct(), "decontam-seeds")


def _passages(texts: DataFrame, grams: np.ndarray, reach: np.ndarray) -> DataFrame:
    """``doc_id, first_word, passage, grams`` around the seeds; passages of a text do not overlap."""
    known = texts.sparkSession.sparkContext.broadcast((grams, reach))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, far = known.value
        bits = _filter(table)
        for b in C.small_batches(batches):
            data, off = C.text_buffer(b.column(1))
            starts, ends, at, words = _words(data, off)
            runs = [_known(words, at, size, table, bits) for size in (SHORT, GRAM)]
            size = np.repeat((SHORT, GRAM), [len(r[0]) for r in runs])
            pos, gram, k = (np.concatenate(x) for x in zip(*runs, strict=True))
            if not len(pos):
                continue
            doc = np.searchsorted(at, pos, side="right") - 1
            low, high = np.maximum(pos - far[k], at[doc]), np.minimum(pos + size + far[k], at[doc + 1])
            order = np.lexsort((low, doc))
            pos, gram, doc, low, high = pos[order], gram[order], doc[order], low[order], high[order]
            far_end = np.maximum.accumulate(high + 0)
            new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (low[1:] > far_end[:-1])))
            first = np.flatnonzero(new)
            group_low, group_high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            ids = b.column(0)
            rows = [(ids[int(doc[f])].as_py(), int(a - at[doc[f]]), b" ".join(data[x:y].tobytes() for x, y in zip(starts[a:z].tolist(), ends[a:z].tolist(), strict=True)))
                    for f, a, z in zip(first.tolist(), group_low.tolist(), group_high.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].decode() for r in rows], pa.string()),
                 pa.ListArray.from_arrays(pa.array(np.append(first, len(gram)), pa.int32()), pa.array(gram.view(np.int64)))],
                names=["doc_id", "first_word", "passage", "grams"])

    return texts.mapInArrow(run, "doc_id long, first_word long, passage string, grams array<long>")


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of two word sequences and the place in ``passage`` after its last word.

    One row of the matrix per item word; gaps along the row are a running maximum.
    """
    ramp = -GAP * np.arange(len(passage) + 1)
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for w in item:
        step = np.maximum(row + GAP, 0)
        np.maximum(step[1:], row[:-1] + np.where(passage == w, MATCH, MISMATCH), out=step[1:])
        row = np.maximum.accumulate(step + ramp) - ramp
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _least(n: np.ndarray) -> np.ndarray:
    """The least score that counts, for items of ``n`` words."""
    return np.maximum(LEAST_SCORE * MATCH * n, MATCH * np.minimum(LEAST_WORDS, n))


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in C.small_batches(batches, text=3):
        (a_data, a_off), (p_data, p_off) = C.text_buffer(b.column(2)), C.text_buffer(b.column(3))
        (_, _, a_at, a), (_, _, p_at, p) = _words(a_data, a_off), _words(p_data, p_off)
        n = np.diff(a_at)
        got = []
        for i, j, k, m, least in zip(a_at[:-1], a_at[1:], p_at[:-1], p_at[1:], _least(n), strict=True):
            # each item word that the passage has adds one match at most
            top = MATCH * int(np.isin(a[i:j], p[k:m]).sum())
            got.append(align(a[i:j], p[k:m]) if top >= least else (0, 0))
        raw = np.array([g[0] for g in got], np.int64).reshape(-1)
        good = (raw >= _least(n)) & (n > 0)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(raw / np.maximum(MATCH * n, 1)), pa.array([g[1] for g in got], pa.int64())],
            names=["h", "item_id", "score", "end"]).filter(pa.array(good))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, score, end_word``: the test items that a text holds, copied or edited.

    ``score`` is the alignment score over the item's score with itself (at least ``LEAST_SCORE``, and
    ``LEAST_WORDS`` words' worth or the whole of a shorter item); ``end_word`` is where the aligned words
    end in the text. Items of equal words count as the one of smallest id; an item of under ``GRAM``
    words cannot be told from chance and is not searched. Null and empty texts and items match
    nothing; null ids are kept; repeated rows give one row; either table empty gives none.
    Texts are scanned whole, twice per ``BLOCK`` runs of the items; only places that hold a seed
    are shuffled, and equal passages are aligned once, however many documents hold them.
    A copy is found if it keeps ``GRAM`` words in a row, or ``SHORT`` words that are rare (``RARE``).
    """
    text = lambda c: F.lower(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))
    raw = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), text(item_text).alias("text"))
    norm = F.trim(F.regexp_replace("text", r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " "))
    unique = raw.select("item_id", norm.alias("text")).where(F.length("text") > 0).groupBy("text").agg(F.min("item_id").alias("item_id"))
    unique = C.written(unique, "decontam-items")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text(text_col).alias("text"))
    seeds = _seeds(texts, unique)
    found = None
    for table, reach in _tables(seeds):
        one = _passages(texts, table, reach)
        found = one if found is None else found.unionAll(one)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, end_word long")
    found = C.written(found.withColumn("h", F.xxhash64("passage")), "decontam-passages")
    seeds = seeds.select("item_id", "gram")
    # equal passages count once, with the n-grams of all scans; one has few n-grams, so a hot one does not gather rows
    held = found.select("h", F.explode("grams").alias("gram")).distinct()
    distinct_passages = found.groupBy("h").agg(F.first("passage").alias("passage"))
    pairs = held.join(seeds, "gram").select("h", "item_id").distinct()
    sides = pairs.join(unique, "item_id").join(distinct_passages, "h").select("h", "item_id", "text", "passage")
    aligned = sides.mapInArrow(_align, "h long, item_id long, score double, end long")
    out = found.select("doc_id", "first_word", "h").join(aligned, "h")
    best = F.max(F.struct("score", (F.col("first_word") + F.col("end")).alias("end_word"))).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.score", "b.end_word")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the ids that hold a test item (columns as in ``docs``; a null id counts as one id)."""
    bad, key = C.free_name(docs, "_leak"), F.col(f"`{id_col}`")
    ids = C.written(leaks(docs, items, id_col, text_col).select(F.col("doc_id").alias(bad)).distinct(), "decontam-ids")
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, key.eqNullSafe(F.col(bad)), "left_anti")
