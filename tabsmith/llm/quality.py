"""Compression-band quality rules (zstandard ratios of whole texts and of fixed chunks).

A text that repeats itself compresses far better than prose of its length, random
characters compress hardly at all. Short texts compress less than long ones, so each
length class has its own band; chunks all have one length and one band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tabsmith.llm import common as C

#: (texts of at least so many bytes, least ratio, greatest ratio) of raw to compressed bytes.
BANDS = ((0, 0.30, 2.2), (128, 0.75, 2.9), (512, 1.10, 3.4), (2048, 1.40, 4.0), (8192, 1.60, 4.8), (32768, 1.70, 6.0))
#: The same for one chunk (the last one of a text overlaps the one before), and the share of chunks that may lie outside.
CHUNK_BYTES, CHUNK_BAND, CHUNK_SHARE = 4096, (1.40, 4.5), 0.25
LEVEL = 3
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
          " ratio double, n_chunks long, n_bad_chunks long, base_failed boolean, in_band boolean, kept boolean")


def _sums(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def _repeats(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does its (doc, key) occur twice or more; is it a later one of equal items?"""
    order = np.lexsort((np.arange(len(key)), key, doc))
    k, d = key[order], doc[order]
    same = np.zeros(len(k), bool)
    if len(k) > 1:
        same[1:] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    twice = same.copy()
    twice[:-1] |= same[1:]
    many, later = np.empty(len(k), bool), np.empty(len(k), bool)
    many[order], later[order] = twice, same
    return many, later


def _counts(data: np.ndarray, off: np.ndarray, window: int) -> dict[str, np.ndarray]:
    n = len(off) - 1
    space = C.SPACE[data]
    starts, ends, at = C.spans(~space, off)
    words = np.diff(at)
    doc = np.repeat(np.arange(n), words)
    hashes = C.SpanHash(data)
    out = {"n_words": words, "word_chars": _sums(~space & ((data & 0xC0) != 0x80), off), "n_symbols": _sums(SYMBOLS[data], off)}
    # lines with a word that are equal to an earlier line of the text
    cut = data == 10
    l_start, l_end, l_at = C.spans(~cut, off)
    l_doc = np.repeat(np.arange(n), np.diff(l_at))
    worded = np.searchsorted(starts, l_end) > np.searchsorted(starts, l_start)
    _, later = _repeats(hashes.of(l_start[worded], l_end[worded]), l_doc[worded])
    out["n_dup_lines"] = np.bincount(l_doc[worded][later], minlength=n)
    # words covered by a window of words that the text has twice or more
    covered = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= window:
        w = hashes.of(starts, ends)
        m = len(w) - window + 1
        inside = doc[:m] == doc[window - 1:]
        pos = np.flatnonzero(inside)
        many, _ = _repeats(C.chain([w[pos + k] for k in range(window)]), doc[pos])
        np.add.at(covered, pos[many], 1)
        np.add.at(covered, pos[many] + window, -1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(covered)[:-1] > 0], minlength=n)
    return out


def _ratio(press: zstandard.ZstdCompressor, piece: memoryview) -> float:
    return len(piece) / len(press.compress(piece))


def _compression(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    press = zstandard.ZstdCompressor(level=LEVEL)
    n, view = len(off) - 1, memoryview(np.ascontiguousarray(data)).cast("B") if len(data) else memoryview(b"")
    ratio, chunks, bad, inside = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    floors = np.array([b[0] for b in BANDS])
    for i in range(n):
        a, b = int(off[i]), int(off[i + 1])
        if a == b:
            continue
        ratio[i] = r = _ratio(press, view[a:b])
        _, low, high = BANDS[int(np.searchsorted(floors, b - a, side="right")) - 1]
        inside[i] = low <= r <= high
        at = list(range(a, b - CHUNK_BYTES + 1, CHUNK_BYTES))
        if at and at[-1] + CHUNK_BYTES < b:
            at.append(b - CHUNK_BYTES)
        chunks[i] = len(at)
        rs = [r] if b - a == CHUNK_BYTES else [_ratio(press, view[k:k + CHUNK_BYTES]) for k in at]
        bad[i] = sum(not CHUNK_BAND[0] <= x <= CHUNK_BAND[1] for x in rs)
    inside &= bad <= CHUNK_SHARE * chunks
    return {"ratio": ratio, "n_chunks": chunks, "n_bad_chunks": bad, "in_band": inside}


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 5, least_words: int = 10,
            repeat_percent: int = 20) -> DataFrame:
    """One row per row of ``docs``: word, symbol, repeat counts and the compression verdict.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``base_failed``: under ``least_words`` words, or more than
    ``repeat_percent`` % of the words in ``window``-word windows that the text has twice or more.
    ``in_band``: the whole text's ratio lies in the band of its length and at most a quarter of its
    chunks lie outside the chunk band; chunks follow each other from the start, and the last one
    ends where the text ends (texts shorter than a chunk have none). ``kept``: not base_failed and in_band.
    Null and empty texts: zero counts, ratio 0, base_failed. Repeated rows give repeated rows; an
    empty table gives none; a null id stays null; other columns are not read. No shuffle: each
    text is judged where it is read, in batches of a few MB (or one text).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small_batches(batches):
            data, off = C.text_buffer(b.column(1))
            x = _counts(data, off, window) | _compression(data, off)
            failed = (x["n_words"] < least_words) | (100 * x["n_repeat_words"] > repeat_percent * x["n_words"])
            longs = [pa.array(x[k].astype(np.int64)) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *longs, pa.array(x["ratio"]), pa.array(x["n_chunks"]), pa.array(x["n_bad_chunks"]),
                 pa.array(failed), pa.array(x["in_band"]), pa.array(~failed & x["in_band"])],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "n_chunks",
                       "n_bad_chunks", "base_failed", "in_band", "kept"])

    return C.id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
