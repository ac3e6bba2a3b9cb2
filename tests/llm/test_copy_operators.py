"""Near-duplicates, repeated strings, lines, leaks and language-model scores against brute force."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from cases import SF, empty, messy
from pyspark.sql import functions as F

from tabsmith.llm import bitsim, ctw, decontam, line_dedup, suffix_dedup
from tabsmith.llm import common as C

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text):
    return (text or "").encode().translate(LOW).split()


def closure(n, links):
    label = list(range(n))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# ---------------------------------------------------------------- simhash

def simhash_of(text):
    w = tokens(text)
    runs = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    docs = messy(spark).select("doc_id", "text").unionAll(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 100", "text"))
    rows = docs.collect()
    prints = [simhash_of(r.text) for r in rows]
    label = closure(len(rows), [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = collections.defaultdict(list)
    for r, k in zip(rows, label, strict=True):
        least[k].append(r.doc_id)
    want = collections.Counter((r.doc_id, f"{p:016x}", min((x for x in least[k] if x is not None), default=None)) for r, p, k in zip(rows, prints, label, strict=True))
    assert collections.Counter(map(tuple, bitsim.near_duplicates(docs).collect())) == want
    kept = bitsim.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(least)
    assert bitsim.near_duplicates(empty(spark)).count() == 0 and bitsim.one_of_each(messy(spark)).columns == messy(spark).columns


@pytest.mark.parametrize("shard,bucket", [(8192, 2048), (16, 1)])
def test_bit_sliced_links(spark, monkeypatch, shard, bucket):
    monkeypatch.setattr(bitsim, "SHARD", shard)
    monkeypatch.setattr(bitsim, "BUCKET", bucket)
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(7))) for b in base for _ in range(12)} | {base[0] ^ (k << 20) for k in range(70)})
    label = closure(len(fps), [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4])
    df = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "doc_id long, f long")
    got = {int(np.int64(r.fp).view(np.uint64)): r.component_id for r in bitsim.components(df, "f", "doc_id", 4).collect()}
    assert [got[f] for f in fps] == label


def test_near_lanes():
    rng = np.random.default_rng(0)
    block = rng.integers(0, 1 << 63, 128, dtype=np.uint64)
    query = block[:50] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64)) ^ np.uint64(6)
    for radius in range(8):
        for b in range(2):
            at, word = bitsim.near_lanes(query, np.full(50, b), bitsim.planes(block), np.full(50, 0xFFFFFFFFFFFFFFFF, np.uint64), radius)
            got = np.zeros(50, np.uint64)
            got[at] = word
            want = np.bitwise_count(query[:, None] ^ block[None, 64 * b:64 * b + 64]) <= radius
            assert (np.unpackbits(got.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool) == want).all()


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.component for r in C.min_components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    label = closure(200, links)
    assert got == {i: label[i] for i in {x for p in links if p[0] != p[1] for x in p}}


# ---------------------------------------------------------------- repeated strings

def repeats_of(texts, length):
    blobs = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + length] for b in blobs for i in range(len(b) - length + 1))
    out = []
    for b in blobs:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("hot,seed", [(4096, 1), (1, 2)])
def test_repeated_strings(spark, monkeypatch, hot, seed):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6)))
    pool, texts = [" ".join(word() for _ in range(60)) for _ in range(9)], [None, ""]
    for _ in range(90):
        t = ""
        for _ in range(rng.randrange(6)):
            p, k = rng.choice(pool), rng.random()
            i, j = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            t += p[i:j] if k < 0.4 else rng.choice(("ab ", "x", "Le la ")) * rng.randrange(1, 60) if k < 0.6 else " ".join(word() for _ in range(rng.randrange(1, 30)))
        texts.append(t)
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(docs, length=70).collect()
    want = collections.Counter((i // 2, *x) for i, x in enumerate(repeats_of(texts, 70)))
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want


def test_repeated_strings_edges(spark):
    rows = messy(spark).collect()
    got = suffix_dedup.remove_repeats(messy(spark), length=60).collect()
    want = collections.Counter((r.doc_id, *x) for r, x in zip(rows, repeats_of([r.text for r in rows], 60), strict=True))
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_loser_tree():
    rng = random.Random(3)
    for k in (0, 1, 2, 5, 8):
        runs = [sorted((bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))), bytes(rng.choice(b"xy") for _ in range(rng.randrange(6))), b"r%d" % i)
                       for i in range(rng.randrange(20))) for _ in range(k)]
        got = list(suffix_dedup.merge([suffix_dedup.read_run(suffix_dedup.front_code(r)) for r in runs]))
        assert sorted(g[1:] for g in got) == sorted(x for r in runs for x in r)
        assert [g[1] for g in got] == sorted(g[1] for g in got)
        for a, b in itertools.pairwise(got):
            assert b[0] == suffix_dedup.common(a[1], b[1], 0)


# ---------------------------------------------------------------- lines

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def varied(rng, text, most):
    b = list(text)
    for _ in range(rng.randrange(most + 1)):
        i, k = rng.randrange(len(b)), rng.randrange(3)
        b[i:i + (k > 0)] = [rng.choice("abc")] if k < 2 or len(b) == 1 else []
    return "".join(b)


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_banded_bits(spark, tau):
    rng = random.Random(tau)
    pairs = [(a, varied(rng, a, 5)) for a in ("".join(rng.choice("abé") for _ in range(rng.randrange(1, 14))) for _ in range(250))]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.within(F.split("a", ""), F.split("b", ""), tau).alias("w")).collect()
    assert all(r.w == (edits(r.a, r.b) <= tau) for r in got)


@pytest.mark.parametrize("tau", [1, 2])
def test_line_dedup(spark, tau):
    rng = random.Random(5 + tau)
    base = ["".join(rng.choice("ab ") for _ in range(rng.randrange(9, 17))) for _ in range(25)]
    docs = [(i, "\n".join(varied(rng, rng.choice(base), 3) for _ in range(rng.randrange(4))) if i % 9 else None) for i in range(60)]
    docs += [docs[7], (61, "\n \n"), (None, base[0])]
    lines = [(i, t, p, x) for i, t in dict.fromkeys(docs) for p, x in enumerate((t or "").split("\n")) if x.strip()]
    order = {k: n for n, k in enumerate(sorted(range(len(lines)), key=lambda k: (lines[k][0] is not None, lines[k][0], lines[k][2])))}
    near = lambda a, b: a == b or (len(a) >= 8 and len(b) >= 8 and edits(a, b) <= tau)
    texts = sorted({x[3] for x in lines})
    label = dict(zip(texts, closure(len(texts), [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if near(texts[i], texts[j])]), strict=True))
    first = {}
    for k in sorted(range(len(lines)), key=order.get):
        first.setdefault(label[lines[k][3]], k)
    gone = collections.defaultdict(list)
    for k, (i, t, p, x) in enumerate(lines):
        if first[label[x]] != k:
            gone[i, t].append(p)
    degree = {x: sum(x != y and near(x, y) for y in texts) for x in texts}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_id", F.lit(1))
    got = line_dedup.dedup_lines(df, tau=tau, least_chars=8).collect()
    own = lambda i, t: [x for x in (t or "").split("\n") if x.strip()]
    want = collections.Counter((i, len(own(i, t)), tuple(gone[i, t]), sum(degree[x] for x in own(i, t))) for i, t in docs)
    assert collections.Counter((r.doc_id, r.n_lines, tuple(r.removed_lines), r.n_links) for r in got) == want
    kept = line_dedup.without_lines(df.withColumn("n_chars", F.length("text")), tau=tau, least_chars=8)
    expect = collections.Counter()
    for i, t in docs:
        new = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i, t])
        if not gone[i, t] or new.strip():
            expect[i, new, None if new is None else len(new)] += 1
    assert collections.Counter((r.doc_id, r.text, r.n_chars) for r in kept.collect()) == expect


def test_line_limits_grow(spark):
    rng = random.Random(8)
    base = []
    for n in (18, 19, 20, 30, 39, 40, 41, 119, 160, 170, 200, 205, 400, 810):
        for gap in (5, 30):  # words of 5 or 30 letters; some lines have long blanks
            x = "".join(" " if k % (gap + 1) == gap else rng.choice("abcdefgé漢\U0001f600") for k in range(n))
            base.append(x.replace(" ", " " * 12)[:n] if gap == 30 else x)
    texts = set(base)
    for x in base:
        limit = max(2, len(x) // 40 - 1)
        for _ in range(5):
            b, many = list(x), limit + rng.randrange(-1, 2)
            step = len(b) // (many + 1)
            for k in range(many, 0, -1):  # evenly spread, so that the equal runs are as short as can be
                kind = rng.randrange(3)
                b[k * step:k * step + (kind > 0)] = [rng.choice("xyz")] if kind < 2 else []
            texts.add("".join(b))
        texts.add(x[:3] + "Q" + x[4:])
    texts = sorted(x for x in texts if x.strip())
    most = lambda n: 0 if n < 20 else 1 if n < 40 else max(2, n // 40 - 1)
    near = lambda a, b: abs(len(a) - len(b)) <= most(min(len(a), len(b))) and edits(a, b) <= most(min(len(a), len(b)))
    want = {frozenset((a, b)) for a, b in itertools.combinations(texts, 2) if near(a, b)}
    lines = line_dedup.lines_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text")
    name = {r.h1: r.line for r in lines.select("h1", "line").collect()}
    got = {frozenset((name[r.a], name[r.b])) for r in line_dedup.growing_links(lines).collect()}
    assert got == want and sum(min(map(len, p)) >= 160 for p in want) > 40 and any(min(map(len, p)) < 40 for p in want)
    docs = spark.createDataFrame([(1, base[-1]), (2, base[-1][:400] + "another" + base[-1][404:])], "doc_id long, text string")
    assert sorted(r.n_removed for r in line_dedup.dedup_lines(docs).collect()) == [0, 1]


def test_long_lines_meet_in_few_pairs(spark, monkeypatch):
    """Long lines with grams that very many have: all links, and few pairs to compare, by longer grams and length classes."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = [f"{text(15 + k % 60)}, as everybody says, {text(20)}" for k in range(80)]
    for stem in (text(40), text(20) + " " * 30 + text(15), "漢\U0001f600" * 60 + text(20)):
        for _ in range(14):
            t = list(stem)
            for _ in range(rng.randint(0, len(t) // 30)):
                t[rng.randrange(len(t))] = rng.choice("klm")
            rows.append("".join(t))
    rows = sorted(set(rows))
    lines = line_dedup.lines_of(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), "doc_id", "text")
    name, at = {r.h1: r.line for r in lines.select("h1", "line").collect()}, {}
    written = line_dedup.C.written

    def counted(df, what):
        out = written(df, what)
        at[what] = at.get(what, 0) + out.count()
        return out

    most = lambda n: max(2, n // 40 - 1)
    near = lambda a, b: abs(len(a) - len(b)) <= most(min(len(a), len(b))) and edits(a, b) <= most(min(len(a), len(b)))
    want = {frozenset((a, b)) for a, b in itertools.combinations([x for x in rows if len(x) >= 160], 2) if near(a, b)}
    monkeypatch.setattr(line_dedup.C, "written", counted)
    monkeypatch.setattr(line_dedup, "HOT", 8)
    got = line_dedup._long_links(line_dedup._distinct(lines)).collect()
    assert {frozenset((name[r.a], name[r.b])) for r in got} == want and len(got) == len(want) > 40
    assert at["line-crowd"] > 60 and at["line-long-pairs"] < len(want) + 500


def test_letters_apart_is_short(spark):
    """Equal to loops, and few steps: a join condition of thousands is not compiled and took 30 times as long."""
    rng = random.Random(6)
    rows = [(rng.getrandbits(64) - (1 << 63), rng.getrandbits(64) - (1 << 63)) for _ in range(500)] + [(0, -1), (-1, -1), (1 << 62, -1 << 63)]
    nibbles = lambda x: [x >> 4 * k & 15 for k in range(16)]
    want = [sum(min(abs(x - y), 16 - abs(x - y)) for x, y in zip(nibbles(a), nibbles(b), strict=True)) for a, b in rows]
    apart = line_dedup.letters_apart(F.col("a"), F.col("b"))
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a long, b long").select("i", apart.alias("d")).collect()
    assert [r.d for r in sorted(got)] == want and str(apart).count("(") < 150


def test_line_dedup_edges(spark):
    got = line_dedup.dedup_lines(messy(spark)).collect()
    assert len(got) == 11 and {r.doc_id: r.n_removed for r in got}[6] == 1
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    assert line_dedup.without_lines(messy(spark)).columns == messy(spark).columns and line_dedup.without_lines(empty(spark)).count() == 0


def test_one_of_each_settles_equal_ids_by_text(spark):
    words = " ".join(f"word{i}" for i in range(400))
    rows = [(1, words + x, x) for x in ("", " ", "\n", "  ")] + [(2, words, "later"), (None, None, "n"), (None, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_row` string")
    least = docs.where("doc_id = 1").orderBy(F.xxhash64("text")).first()
    for parts in (1, 5):
        got = bitsim.one_of_each(docs.repartition(parts)).collect()
        assert [tuple(r) for r in got if r.doc_id is not None] == [tuple(least)] and len(got) == 2


# ---------------------------------------------------------------- leaks

def test_alignment():
    rng = random.Random(1)
    for _ in range(60):
        a, p = ([rng.randrange(4) for _ in range(rng.randrange(1, 9))] for _ in range(2))
        h = np.zeros((len(a) + 1, len(p) + 1), int)
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(p) + 1)):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == p[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontam.align(np.array(a, np.uint64), np.array(p, np.uint64))[0] == h.max()


def test_leaks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    plain = [r.text for r in docs.orderBy("doc_id").limit(40).collect()]
    rng, planted = random.Random(9), []
    for k, r in enumerate(items.orderBy("item_id").limit(30).collect()):
        w = r.text.split()
        if len(w) >= 15:
            edited = [x if rng.random() > 0.1 else "zq" + x for x in w]
            planted.append((10_000 + k, plain[k][:200] + " " + " ".join(edited).upper() + " " + plain[k + 1][:200], r.item_id))
    more = spark.createDataFrame([p[:2] for p in planted], "doc_id long, text string").unionAll(messy(spark).selectExpr("doc_id + 20000", "text"))
    got = decontam.leaks(docs.unionAll(more), items).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert sum((p[0], p[2]) in pairs for p in planted) >= 0.95 * len(planted)
    words = lambda t: " " + " ".join(decontam_words(t)) + " "
    held = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if words(i.text) in words(d.text)}
    assert {p for p in pairs if p[0] < 10_000} == held
    out = decontam.without_leaks(docs.unionAll(more), items)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.unionAll(more).collect()} - {p[0] for p in pairs}


def decontam_words(text):
    import re
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def test_leaks_edges(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 5)  # several scans
    items = spark.createDataFrame([(1, "the cat sat on the mat and looked at the dog"), (2, "The cat sat on the mat, and looked at the dog!"), (3, None), (4, ""), (5, "a b c"), (None, "x")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.score) for r in decontam.leaks(messy(spark), items).collect()}
    assert got == {(1, 1, 1.0), (6, 1, 1.0)}
    assert decontam.leaks(empty(spark), items).count() == 0 and decontam.leaks(messy(spark), items.limit(0)).count() == 0
    assert decontam.without_leaks(messy(spark), items).count() == 8


def spaced_copy(rng, words, step):
    """``words`` with every ``step``-th changed."""
    return [f"zq{rng.randrange(10**6)}" if k % step == step - 1 else w for k, w in enumerate(words)]


def test_leaks_short_runs(spark):
    rng = random.Random(4)
    item = {i: [f"w{rng.randrange(10**5)}" for _ in range(rng.randrange(24, 40))] for i in range(24)}
    docs, want = [], set()
    for i, w in item.items():
        lead = [f"x{rng.randrange(10**5)}" for _ in range(30)]
        docs.append((i, " ".join(lead + spaced_copy(rng, w, 5 + i % 3) + lead[::-1])))
        want.add((i, i))
        # another document has one rarer n-gram right beside the run that many copies have
        docs += [(100 + 10 * i + k, " ".join([f"y{i}_{k}", *w[:4], "q", *w[5:9], *lead[:k], *w[10:]])) for k in range(3)] + [(1000 + i, " ".join(w[1:5]))]
        want |= {(100 + 10 * i + k, i) for k in range(3)}
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in item.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == want


def test_leaks_every_fourth_word_changed(spark):
    """Runs of three words are left; other texts hold some of an item's runs, and one is copied very often."""
    rng = random.Random(14)
    item = {i: [f"w{rng.randrange(2000)}" for _ in range(rng.randrange(24, 40))] for i in range(36)}
    docs, want = [], set()
    for i, w in item.items():
        lead = [f"x{rng.randrange(10**5)}" for _ in range(30)]
        docs.append((i, " ".join(lead + spaced_copy(rng, w, 4) + lead[::-1])))
        want.add((i, i))
    docs += [(1000 + k, " ".join(item[0])) for k in range(300)]
    want |= {(1000 + k, 0) for k in range(300)}
    docs += [(2000 + k, f"y{k} " + " ".join(item[1][:3]) + f" z{k}") for k in range(300)]  # one run that is not rare
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in item.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == want


def test_leaks_equal_aligning_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    codes = {}
    coded = lambda t: np.array([codes.setdefault(w, len(codes)) for w in decontam_words(t)], np.uint64)
    all_items, want = {}, set()
    for r in items.orderBy("item_id").collect():
        all_items.setdefault(" ".join(decontam_words(r.text)), (r.item_id, coded(r.text)))
    for d in docs.collect():
        text = coded(d.text)
        for i, w in all_items.values():
            least = max(1.2 * len(w), 2 * min(8, len(w)))
            if len(w) >= decontam.GRAM and 2 * np.isin(w, text).sum() >= least and decontam.align(w, text)[0] >= least:
                want.add((d.doc_id, i))
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} == want and want


def test_leaks_many_scans(spark, monkeypatch):
    rng = random.Random(6)
    item = [[f"w{rng.randrange(10**5)}" for _ in range(16)] for _ in range(30)]
    # two items to a short document, each with one run of 4 words in its middle: every scan cuts out the whole text
    copy = lambda w: [*w[:4], "zq", w[5], w[6], "zq", w[8], w[9], w[10], "zq", w[12], w[13], w[14], "zq"]
    docs = spark.createDataFrame([(i, " ".join([*copy(item[i][::-1])[::-1], *copy(item[(i + 1) % 30])])) for i in range(30)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(item)], "item_id long, text string")
    want = {(i, j % 30) for i in range(30) for j in (i, i + 1)}
    one = set(map(tuple, decontam.leaks(docs, items).collect()))
    assert {r[:2] for r in one} == want
    monkeypatch.setattr(decontam, "BLOCK", 100)
    assert set(map(tuple, decontam.leaks(docs, items).collect())) == one


# ---------------------------------------------------------------- context trees

def tree_score(train, text):
    """The same weighted trees, node by node in dictionaries."""
    d = ctw.DEPTH
    nodes = collections.defaultdict(lambda: [0, 0])
    walk = lambda t: [(b"\n" * d + t)[i:i + d + 1] for i in range(len(t))]

    def decisions(gram):
        for bit in range(8):
            yield (gram[-1] | 256) >> (8 - bit), gram[-1] >> (7 - bit) & 1
    for t in train:
        for g in walk(t):
            for prefix, one in decisions(g):
                for k in range(d + 1):
                    nodes[prefix, g[d - k:d]][one] += 1
    kt = lambda z, o: math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)
    children = collections.defaultdict(list)
    for prefix, c in nodes:
        if c:
            children[prefix, c[1:]].append((prefix, c))
    weight = {}
    for key in sorted(nodes, key=lambda k: -len(k[1])):
        own = kt(*nodes[key])
        if len(key[1]) == d:
            weight[key] = (own, math.inf)
        else:
            below = sum(weight[c][0] for c in children[key])
            weight[key] = (np.logaddexp(own, below) - math.log(2), own - below)
    total = 0.0
    for g in walk(text):
        for prefix, one in decisions(g):
            p = None
            for k in range(d, -1, -1):
                key = (prefix, g[d - k:d])
                if key in nodes:
                    z, o = nodes[key]
                    own, odds = ((o if one else z) + 0.5) / (z + o + 1), weight[key][1]
                    w = 1.0 if odds == math.inf else 1 / (1 + math.exp(-max(-700, min(700, odds))))
                    p = own if p is None else w * own + (1 - w) * p
            total += math.log10(0.5 if p is None else p)
    return total


def test_context_tree(spark):
    docs = messy(spark).select("doc_id", "text").where("doc_id is null or doc_id <> 5").unionAll(
        spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 100", "substring(text, 1, 150)").limit(40))
    rows = docs.collect()
    stream = [b" ".join(tokens(r.text)) + b"\n" for r in rows]
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 1 for r in rows]
    train = [s for s, h in zip(stream, held, strict=True) if not h]
    count = collections.Counter(w for r, h in zip(rows, held, strict=True) if not h for w in [*tokens(r.text), None])
    n, v = sum(count.values()), len(count)
    got = sorted(map(tuple, ctw.score(docs, block_bytes=1000).drop("code_bits_per_byte").collect()), key=str)
    want = []
    for r, s, h in zip(rows, stream, held, strict=True):
        t = [*tokens(r.text), None]
        want.append((r.doc_id, h, len(t), sum(x in count for x in t), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), tree_score(train, s)))
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-5)
    assert ctw.score(empty(spark)).count() == 0
    assert ctw.score(messy(spark)).count() == 11


def test_crowded_keys_lose_no_link(spark, monkeypatch):
    """Crowded keys: clusters around several originals, and template lines that differ in three letters."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    stem = "the same beginning of a line that very many lines have, and then "
    rows = []
    for end in ("one end of it for these", "and here is quite another end", "third one"):
        for _ in range(60):
            t = list(stem + end)
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = rng.choice(letters)
            rows.append("".join(t))
    rows += [stem + "".join(rng.choices("abcdefgh", k=3)) + " in a template" for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    lines = line_dedup.lines_of(docs, "doc_id", "text")
    full = {tuple(r) for r in line_dedup.links(lines).collect()}
    monkeypatch.setattr(line_dedup, "HOT", 6)
    index, _ = line_dedup._keyed(lines, 2, 40)
    assert index.groupBy("key").count().where("count > 6").count() > 3
    assert {tuple(r) for r in line_dedup.links(lines).collect()} == full and len(full) > 500
