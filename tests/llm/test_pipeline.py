"""The whole pipeline against the same stages in plain Python, on the smallest tables."""

import base64
import collections
import hashlib

import corpus_pipeline
import numpy as np
import tiktoken
from cases import SF, empty, messy
from test_copy_operators import closure, decontam_words, simhash_of

from tabsmith.llm import langid, line_dedup, queries


def within_band(a, b, tau):
    """Is the edit distance at most ``tau``? Dynamic programming inside the band."""
    if abs(len(a) - len(b)) > tau:
        return False
    row = {j: j for j in range(tau + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - tau), min(len(b), i + tau) + 1):
            new[j] = i if j == 0 else min(row.get(j, 99) + 1, new.get(j - 1, 99) + 1, row.get(j - 1, 99) + (x != b[j - 1]))
        row = new
        if min(row.values()) > tau:
            return False
    return row[len(b)] <= tau


def without_lines(docs):
    lines = [(i, p, x) for i, t in sorted(docs.items()) for p, x in enumerate(t.split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    texts = sorted({x for _, _, x in lines}, key=lambda x: (len(x), x))
    links = []
    for n, a in enumerate(texts):
        for m in range(n + 1, len(texts)):
            if len(texts[m]) > len(a) + line_dedup.TAU:
                break
            if len(a) >= line_dedup.LEAST_CHARS and within_band(a, texts[m], line_dedup.TAU):
                links.append((n, m))
    label = dict(zip(texts, closure(len(texts), links), strict=True))
    seen, gone = set(), collections.defaultdict(set)
    for i, p, x in lines:
        if label[x] in seen:
            gone[i].add(p)
        seen.add(label[x])
    out = {}
    for i, t in docs.items():
        new = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i])
        if not gone[i] or new.strip(" \t\n\x0b\x0c\r"):
            out[i] = new
    return out


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = {r.doc_id for r in langid.identify(docs).collect() if r.lang_pred != "und" and r.score >= 0.3}
    texts = without_lines({r.doc_id: r.text for r in docs.collect() if r.doc_id in known})
    ids = sorted(texts)
    prints = [simhash_of(texts[i]) for i in ids]
    label = closure(len(ids), [(a, b) for a in range(len(ids)) for b in range(a + 1, len(ids)) if (prints[a] ^ prints[b]).bit_count() <= 4])
    texts = {i: texts[i] for n, i in enumerate(ids) if label[n] == n}
    words = lambda t: " " + " ".join(decontam_words(t)) + " "
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {i: t for i, t in texts.items() if not any(x in words(t) for x in items)}
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for i, t in texts.items():
        e = library.encode_ordinary(t)
        want.add((i, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 20 < len(want) < docs.count()


def test_stages_keep_the_columns(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "tokenise"]
    for docs in (messy(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
