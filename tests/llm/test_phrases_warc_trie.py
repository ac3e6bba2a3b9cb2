"""Phrases, WARC archives and the prefix trie against brute force and exact round trips."""

import base64
import collections
import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import empty, messy
from pyspark.sql import functions as F

from tabsmith.llm import collocations, queries, trie, warc
from tabsmith.llm import common as C

# ---------------------------------------------------------------- phrases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases_of(rows, least, longest=5, keep=2000):
    total, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = set()
    for lang, counts in f.items():
        found = []
        often = {p: a for p, a in counts.items() if a >= least}
        for p, a in often.items():
            if len(p) == 1 or any(len(q) > len(p) and often[q] >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q in often):
                continue
            cuts = [(1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:keep], 1):
            out.add((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return out


def noise(rng, n):
    words = ["the", "The", "new", "york", "of", "a", "é", "漢字", "x" * 300, *(f"w{i}" for i in range(300))]
    weights = [40, 20, 10, 10, 8, 8, 5, 5, 1, *([.3] * 300)]
    for i in range(n):
        text = " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))
        for mark in (". ", ",", "\n", "\t", "  ", "\x0b"):
            text = text.replace(" w1", mark + "w1", 1)
        yield (rng.choice(["en", "en", "en", "de", None]), text + (" in the city of new york is it " * rng.randint(0, 3)))


def test_phrases(spark):
    rows = [*noise(random.Random(3), 300), (None, None), ("de", ""), ("fr", "... !\n\t "), ("es", "uno dos"), *[("und", "same old text here now again")] * 12]
    # a hot passage: a third of the rows in one language
    rows += [("en", "hot passage that all of them share word for word")] * 300
    df = spark.createDataFrame([(t, lg, 1, "x") for lg, t in rows], "text string, lang string, word int, block string").repartition(7)
    want = phrases_of(rows, 10)
    got = list(map(tuple, collocations.collocations(df, least=10).collect()))
    assert set(got) == want and len(got) == len(want) > 100
    assert {r[0] for r in got} >= {"en", "und"}
    # the way without a broadcast, lists added up in a tree, and a short list kept
    few = phrases_of(rows, 10, keep=5)
    assert set(map(tuple, collocations.collocations(df.repartition(90), least=10, keep=5, broadcast=0).collect())) == few


def test_phrase_edges(spark):
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(messy(spark)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = collocations.collocations(messy(spark), least=2).collect()
    rows = [(r.lang, r.text) for r in messy(spark).collect()]
    assert set(map(tuple, got)) == phrases_of(rows, 2)


def test_tiles_add_up():
    rng = np.random.default_rng(1)
    for top in (200, 300, 20000):  # one dense tile, a few, mostly bins
        left, right = (rng.integers(1, top + 1, 60000) for _ in range(2))
        keys = left.astype(np.int64) << 32 | right
        lists = []
        for part in np.array_split(keys, 9):
            u, c = np.unique(part, return_counts=True)
            lists += [b for b in collocations._deal(u, c, 16, 0)]
        rows = sorted((r["tile"], r["cells"], r["counts"]) for b in lists for r in b.to_pylist())
        tiles = {}
        for t, cells, counts in rows:
            tiles.setdefault(t, collocations._Tile(t)).add(cells, counts)
        got = {int(k): int(v) for t in tiles.values() for k, v in zip(*t.pairs(), strict=True)}
        assert got == collections.Counter(keys.tolist())
        assert any(t.dense is not None for t in tiles.values()) == (top < 5000) and (min(tiles) < 0) == (top > 5000)


def test_lists_are_packed():
    rng = np.random.default_rng(2)
    for a in (np.zeros(0, np.int64), np.zeros(5, np.int32), rng.integers(0, 70000, 999).astype(np.int32), np.array([1 << 62, 0, 255, 256])):
        data = collocations._packed(a)
        assert np.array_equal(collocations._unpacked(data, a.dtype), a) and len(data) == 1 + len(a) * data[0]
    # a cell of a tile takes two bytes and a small count one
    left, right = (rng.integers(1, 257, 30000) for _ in range(2))
    keys, counts = np.unique(left << 32 | right, return_counts=True)
    lists = [r for b in collocations._deal(keys, counts, 16, 0) for r in b.to_pylist()]
    assert sum(len(r["cells"]) + len(r["counts"]) for r in lists) == 3 * len(keys) + 2 * len(lists)


def test_sequences_keep_what_longer_phrases_need():
    rng = np.random.default_rng(4)
    words = rng.choice(7, 9000, p=[.1, .3, .2, .1, .1, .1, .1]).astype(np.int32)
    w = h = words
    for k in (2, 3, 4, 5):
        grams = collections.Counter(tuple(words[i:i + k].tolist()) for i in range(len(words) - k + 1) if words[i:i + k].all())
        pairs, counts = np.unique(collocations._pairs(w, h, k)[1], return_counts=True)
        # a phrase that counts 20 or more is counted in full, whatever was set to 0 before
        often = counts >= 20
        assert sorted(counts[often]) == sorted(n for n in grams.values() if n >= 20) and 0 < often.sum() < len(often) + (k < 3)
        pairs = pairs[often]
        w2, h2 = (collocations._unpacked(x, np.int32) for x in collocations._relabel(w, h, k, pairs, np.arange(1, len(pairs) + 1, dtype=np.int32)))
        assert (w2 == 0).sum() > (w == 0).sum()
        w, h = w2, h2


def test_arrow_batches_are_small_for_blocks_only(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    fat = spark.range(0, 12, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    with C.arrow_batches(spark, collocations.BLOCK):
        assert max(r.n for r in fat.mapInArrow(rows, "n long").collect()) <= 6
    assert spark.conf.get(name) == before


# ---------------------------------------------------------------- WARC

def test_warc_round_trip(spark):
    rng = random.Random(5)
    rows = [(i, f"http://a/{i}", f"page {rng.randint(0, 40)} é 漢") for i in range(300)] + [(i, None, None) for i in range(300, 310)]
    rows += [(7, "http://a/7", rows[7][2])] * 3 + [(None, "http://none", "page 1 é 漢"), (400, "http://x\r\nWARC-Type: fake", "WARC/1.1\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n"),
                                                   (401, "u", ""), (402, "u", "only one"), (403, "", "x" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).repartition(6)
    for least in (0, 9):
        path = warc.write_warc(warc.records_of(df, least=least), C.scratch(spark, "archive"))
        first = {}
        for i, u, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
            first.setdefault(t or "", i)
        want, seen = collections.Counter(), set()
        for i, u, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
            data = (t or "").encode()
            again = len(data) >= least and (t or "") in seen
            seen.add(t or "")
            want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first[t or ""] if again else None] += 1
        assert collections.Counter(map(tuple, warc.pages_in(spark, path).collect())) == want


def test_warc_predicates_and_files(spark, tmp_path):
    rows = [(i, f"http://a/{i % 3}", f"t{i}" if i % 5 else "same") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    path = warc.write_warc(warc.records_of(df), C.scratch(spark, "archive"))
    every = warc.read_warc(spark, path)
    held = every.collect()
    for condition in ("record_type = 'revisit'", "target_uri = 'http://a/1' and record_type = 'response'", "record_type in ('revisit', 'warcinfo')",
                      "record_type not in ('revisit')", "refers_to is null", "refers_to is not null", "target_uri like 'http://a%'", "target_uri like '%2'",
                      "target_uri like '%/a/%'", "not target_uri like '%2'", "record_type <> 'response'", "target_uri <=> null", "payload_length > 2"):
        got = warc.read_warc(spark, path).where(condition).select("record_id", "target_uri").collect()
        # a condition on what was collected: nothing is pushed down
        plain = spark.createDataFrame(held, every.schema).where(condition).select("record_id", "target_uri").collect()
        assert collections.Counter(got) == collections.Counter(plain), condition
    plan = warc.read_warc(spark, path).where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")
    heads = warc.read_warc(spark, path, "record_id, payload_length, headers")
    assert heads.where("record_id is not null and payload_length >= 0").count() == 60
    # more is added, then all is replaced
    warc.write_warc(warc.records_of(df), path)
    assert warc.pages_in(spark, path).count() == 120
    warc.write_warc(warc.records_of(df.limit(2)), path, overwrite=True)
    assert warc.pages_in(spark, path).count() == 2
    # an archive of other making: no index, gzip members, no HTTP, folded header lines, and a damaged digest
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:1>\r\nX-Long: a\r\n b\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    with open(tmp_path / "a.warc.gz", "wb") as f:
        f.write(gzip.compress(record) + gzip.compress(record.replace(b"resource", b"metadata")))
    got = warc.read_warc(spark, str(tmp_path)).where("record_type = 'metadata'").collect()
    assert [(r.payload, r.payload_length, r.headers["x-long"]) for r in got] == [(b"hello", 5, "a b")]
    bad = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "b.warc").write_bytes(bad)
    assert warc.read_warc(spark, str(tmp_path / "b.warc")).count() == 1
    with pytest.raises(Exception, match="digest"):
        warc.read_warc(spark, str(tmp_path / "b.warc"), verify=True).collect()


def test_warc_edges(spark):
    pages = messy(spark).withColumnRenamed("doc_id", "page_id").withColumn("url", F.lit("u")).withColumnRenamed("text", "html")
    path = warc.write_warc(warc.records_of(pages), C.scratch(spark, "archive"))
    got = warc.pages_in(spark, path)
    assert got.count() == pages.count() and got.where("record_type = 'response'").count() == pages.select(F.coalesce("html", F.lit(""))).distinct().count()
    path = warc.write_warc(warc.records_of(pages.limit(0)), C.scratch(spark, "archive"))
    assert warc.pages_in(spark, path).count() == 0


# ---------------------------------------------------------------- trie

def trie_of(convs):
    """Brute force over ``{id: [(role, text), ...]}``; a key of None is a conversation without an id."""
    members, at_end = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        at_end[tuple(turns)].append(c)
    least = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = collections.Counter()
    for p, m in members.items():
        ids = ",".join(str(c) for c in sorted(c for c in at_end[p] if c is not None))
        out[least[p], len(p), least[p[:-1]] if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ids.encode()).hexdigest()] += 1
    return out


def conversations(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def some_conversations(rng):
    rows = []
    for c in [*range(-150, 400), None]:
        n = rng.randint(1, 7)
        rows += [(c, rng.choice([None, 0, t, t]), rng.choice(["user", "assistant", None]), rng.choice(["hi", "é漢", "ok", "", None])) for t in range(n)]
    # a third of all conversations says the same, one goes on for very long
    rows += [(c, t, "user", f"hot {t}") for c in range(1000, 2300) for t in range(3)]
    rows += [(5000, t, "user", f"long {t}") for t in range(150)]
    return rows + rows[:3]


def test_trie(spark):
    rows = some_conversations(random.Random(2))
    df = spark.createDataFrame([(*r, b"x", 1) for r in rows], "conv_id long, turn long, role string, text string, key binary, depth int")
    want = trie_of(conversations(rows))
    for turns in (trie.SHARD_TURNS, 300):  # a few shards, many shards
        got = trie.conversation_trie(df, turns).drop("node")
        assert collections.Counter(map(tuple, got.collect())) == want


def test_trie_with_shared_openings(spark):
    rows = [r for r in some_conversations(random.Random(4)) if r[0] != 5000]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = conversations(rows)
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(b"" if c is None else str(c).encode()) % 6
        head = [] if c is None else convs.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        rebuilt[c] = head[:h] + own[h:]
    got = trie.prefix_trie(queries.rebuilt_paths(df)).drop("node")
    assert collections.Counter(map(tuple, got.collect())) == trie_of(rebuilt)


def test_trie_edges(spark, monkeypatch):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.conversation_trie(rows).count() == 0
    one = spark.createDataFrame([(None, None, None, None)], rows.schema)
    got = sorted(map(tuple, trie.conversation_trie(one).drop("node").collect()), key=lambda r: r[1])
    assert [r[:7] for r in got] == [(None, 0, None, 1, 1, 1, 0), (None, 1, None, 1, 0, 1, 0)]
    monkeypatch.setattr(trie, "BROADCAST_ROWS", 0)  # the way without a broadcast
    rows = some_conversations(random.Random(6))[:2000]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert collections.Counter(map(tuple, trie.conversation_trie(df, 300).drop("node").collect())) == trie_of(conversations(rows))


def test_queue_spills():
    rng = random.Random(1)
    queue, held = trie.SpillingQueue(50), []
    for _ in range(5000):
        if held and rng.random() < 0.4:
            held.sort()
            assert queue.head() == held[0]
            assert queue.pop() == held.pop(0)
        else:
            item = (rng.randint(0, 9), rng.random(), None)
            held.append(item)
            queue.push(item)
    assert queue.made > 20
    assert [queue.pop() for _ in held] == sorted(held) and queue.head() is None
