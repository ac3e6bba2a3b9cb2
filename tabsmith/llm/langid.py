"""Language identification with a byte convolutional network trained in numpy.

Filters of several widths run over the raw bytes of fixed-length windows, each filter is
max-pooled over its window, and a softmax layer scores the languages. A filter of width w on
one-hot bytes is a sum of w table rows, so scoring a text is table lookups: the tables of two
neighbouring bytes are added once into a table by byte pair.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm import common as C
from tabsmith.operators.topk import top_k_per_group

WIDTHS = (2, 3, 4)
FILTERS = 8
WINDOW = 256
#: Bytes of text scored at a time, a multiple of the window.
PIECE = 1 << 17
PAD = 0x20
UNKNOWN = "und"


@dataclass
class Model:
    """``langs``; per width a (width, 256, filters) table and a bias; softmax weights and bias."""

    langs: list[str]
    tables: list[np.ndarray]
    bias: list[np.ndarray]
    weight: np.ndarray
    offset: np.ndarray

    def pairs(self) -> list[list[np.ndarray]]:
        """Per width the tables by byte pair (and by last byte, for an odd width)."""
        out = []
        for t in self.tables:
            own = [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, len(t) - 1, 2)]
            out.append(own + ([t[-1]] if len(t) % 2 else []))
        return out

    def features(self, windows: np.ndarray, pairs: list[list[np.ndarray]]) -> np.ndarray:
        """(n, WINDOW) bytes to (n, widths * filters) pooled activations."""
        n, size = windows.shape
        pair = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        out = []
        for t, p, b in zip(self.tables, pairs, self.bias, strict=True):
            width, m = len(t), size - len(t) + 1
            x = p[0].take(pair[:, :m], axis=0)
            for k, table in enumerate(p[1:], 1):
                x += table.take(pair[:, 2 * k:2 * k + m] if len(table) == 65536 else windows[:, width - 1:width - 1 + m], axis=0)
            half = m
            while half > 8:  # pool in halves: long rows add faster than a strided maximum
                low, half = half // 2, half - half // 2
                np.maximum(x[:, :low], x[:, half:half + low], out=x[:, :low])
            out.append(np.maximum(x[:, :half].max(axis=1) + b, 0))
        return np.concatenate(out, axis=1)

    def logits(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weight + self.offset


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def windows_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: ``(windows, text of each, bytes of the text in each)``; the last is padded."""
    size = np.diff(off)
    per = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = off[doc] + nth * WINDOW
    length = np.minimum(WINDOW, off[doc + 1] - start)
    padded = np.concatenate((data, np.full(WINDOW, PAD, np.uint8)))
    out = padded[start[:, None] + np.arange(WINDOW)]
    out[np.arange(WINDOW) >= length[:, None]] = PAD
    return out, doc, length


def train(texts: list[bytes], langs: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.02, seed: int = 7) -> Model:
    """Fit by Adam on all windows, each by its share of bytes; a filter's gradient reaches only the window position that won the pool."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    x, doc, length = windows_of(np.frombuffer(b"".join(texts), np.uint8), off)
    y = np.array([names.index(n) for n in langs])[doc]
    tables = [rng.normal(0, 0.3 / w, (w, 256, FILTERS)) for w in WIDTHS]
    bias = [np.zeros(FILTERS) for _ in WIDTHS]
    weight, offset = rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(names))), np.zeros(len(names))
    params = [*tables, *bias, weight, offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    balance = len(y) / (len(names) * np.maximum(np.bincount(y, minlength=len(names)), 1))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(order), batch):
            rows = order[k:k + batch]
            win, lab = x[rows].astype(np.int64), y[rows]
            feats, wins, acts = [], [], []
            for t, b in zip(tables, bias, strict=True):
                m = WINDOW - len(t) + 1
                conv = sum(t[j][win[:, j:j + m]] for j in range(len(t)))
                best = conv.argmax(axis=1)
                a = np.take_along_axis(conv, best[:, None, :], axis=1)[:, 0] + b
                wins.append(best)
                acts.append(a > 0)
                feats.append(np.maximum(a, 0))
            f = np.concatenate(feats, axis=1)
            grad = np.exp(_log_softmax(f @ weight + offset))
            grad[np.arange(len(lab)), lab] -= 1
            grad *= (balance[lab] * length[rows] / WINDOW)[:, None] / len(lab)
            back = grad @ weight.T
            grads: list[np.ndarray] = []
            g_bias = []
            for i, t in enumerate(tables):
                g = back[:, i * FILTERS:(i + 1) * FILTERS] * acts[i]
                gt = np.zeros_like(t)
                r, c = np.meshgrid(np.arange(len(lab)), np.arange(FILTERS), indexing="ij")
                for j in range(len(t)):
                    np.add.at(gt[j], (win[r, wins[i] + j], c), g)
                grads.append(gt)
                g_bias.append(g.sum(axis=0))
            grads += [*g_bias, f.T @ grad, grad.sum(axis=0)]
            step += 1
            lr = rate * (1 - epoch / epochs)
            for p, g, m1, m2 in zip(params, grads, first, second, strict=True):
                m1 *= 0.9
                m1 += 0.1 * g
                m2 *= 0.999
                m2 += 0.001 * g * g
                p -= lr * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return Model(names, [t.astype(np.float32) for t in tables], [b.astype(np.float32) for b in bias],
                 weight.astype(np.float32), offset.astype(np.float32))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
        held_out: int = 0, per_lang: int = 600, max_langs: int = 400, spots: int = 3) -> Model | None:
    """A model learned from labelled rows whose ``crc32(id as text) mod folds`` is not ``held_out``.

    Bounded sample: of each language the ``per_lang`` rows of smallest id hash, and of each row
    ``spots`` runs of ``WINDOW`` characters at hashed places anywhere in the text (a text of that length
    or less whole); over ``max_langs`` labels raise. Null labels, null and empty texts are not learned
    from. None if nothing is left.
    """
    text = F.col(f"`{text_col}`")
    own = docs.where(F.col(f"`{lang_col}`").isNotNull() & text.isNotNull() & (F.length(F.trim(text)) > 0))
    own = own.where(C.fold_of(F.col(f"`{id_col}`"), folds) != held_out)
    own = own.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.xxhash64(F.col(f"`{id_col}`"), F.length(text)).alias("h"), text.alias("text"))
    size = {r["lang"]: r["count"] for r in own.groupBy("lang").count().limit(max_langs + 1).collect()}
    if len(size) > max_langs:
        raise ValueError(f"more than {max_langs} labels in {lang_col}")
    places = [F.pmod(F.xxhash64("h", F.lit(k)), F.length("text") - WINDOW + 1).cast("int") + 1 for k in range(spots)]
    parts = F.concat_ws(" ", *[F.substring("text", p, F.lit(WINDOW)) for p in places])
    part = F.when(F.length("text") <= spots * WINDOW, F.col("text")).otherwise(parts)

    def first(rows: DataFrame) -> list:
        best = top_k_per_group(rows.select("lang", "h", part.alias("part")), ["lang"], [F.col("h"), F.col("part")], per_lang, F.col("h"))
        return best.select("lang", "part").orderBy("lang", "rank").collect()  # at most per_lang * max_langs short texts

    # hashes spread evenly, so the smallest ones of a language lie below a bound that its row count gives
    bound = {lang: int(min(1.0, 8 * per_lang / n) * (1 << 64)) - (1 << 63) - 1 for lang, n in size.items()}
    table = docs.sparkSession.createDataFrame(list(bound.items()), "lang string, bound long")  # at most max_langs rows
    rows = first(own.join(F.broadcast(table), "lang").where(F.col("h") <= F.col("bound"))) if size else []
    got = Counter(r.lang for r in rows)
    short = [lang for lang, n in size.items() if got[lang] < min(per_lang, n)]
    if short:  # uneven hashes, as of equal ids: all rows of these languages
        rows = [r for r in rows if r.lang not in short] + first(own.where(F.col("lang").isin(short)))
    rows.sort(key=lambda r: r.lang)
    return train([r.part.encode() for r in rows], [r.lang for r in rows]) if rows else None


def predict(text: Column, model: Model | None) -> Column:
    """``struct<lang_pred string, score double>`` of a text: the mean of its windows' log-probabilities.

    Every window of the whole text counts, by its bytes. ``und`` and 0 for a null text, a text
    without a letter, or without a model.
    """
    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def of(col: pa.Array) -> pa.Array:
        data, off = C.text_buffer(col)
        n, pairs = len(col), model.pairs()
        total = np.zeros((n, len(model.langs)))
        at = 0
        while at < n:  # texts of about 128 KB at a time, a longer text in pieces of whole windows
            to = max(at + 1, int(np.searchsorted(off, off[at] + PIECE, side="right")) - 1)
            for start in range(off[at], max(off[to], off[at] + 1), PIECE):
                end = min(off[to], start + PIECE)
                win, doc, length = windows_of(data[start:end], np.clip(off[at:to + 1], start, end) - start)
                for k in range(0, len(win), 256):
                    logp = _log_softmax(model.logits(model.features(win[k:k + 256], pairs)))
                    np.add.at(total, at + doc[k:k + 256], logp * length[k:k + 256, None])
            at = to
        p = np.exp(_log_softmax(total / np.maximum(np.diff(off), 1)[:, None]))
        best = p.argmax(axis=1)
        return pa.StructArray.from_arrays([pa.array([model.langs[b] for b in best], pa.string()), pa.array(p[np.arange(n), best])],
                                          names=["lang_pred", "score"])

    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return none
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), of(text)).otherwise(none)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
             held_out: int = 0, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    Learns from the folds that are not held out (or uses ``model``). Null texts and texts without
    a letter are ``und`` with score 0; repeated rows give repeated rows; a null id is kept and
    counts as the empty text for its fold; an empty table gives none.
    """
    model = model or fit(docs, id_col, text_col, lang_col, folds, held_out)
    got = predict(F.col(f"`{text_col}`").cast("string"), model)
    out = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), got.alias("p"))
    return out.select("doc_id", (C.fold_of(F.col("doc_id"), folds) == held_out).alias("held_out"), "p.lang_pred", "p.score")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or scored under ``least``.

    With no labelled row to learn from, every row with a letter stays.
    """
    model = fit(docs, id_col, text_col, lang_col)
    text = F.col(f"`{text_col}`").cast("string")
    if model is None:
        return docs.where(text.rlike(r"\p{L}"))
    got = C.free_name(docs, "_lang")
    out = docs.withColumn(got, predict(text, model))
    return out.where((F.col(f"{got}.lang_pred") != UNKNOWN) & (F.col(f"{got}.score") >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
