"""Quality, BPE, token files, language and chat formatting against plain Python."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from cases import SF, empty, messy
from pyspark.sql import functions as F

from tabsmith.llm import bpe, chat, dac, langid, quality, queries
from tabsmith.llm import common as C


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality_of(text):
    w = words_of(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words_of(line):
            dup += line in seen
            seen.add(line)
    at = collections.defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_quality_counts(spark):
    docs = messy(spark).select("doc_id", "text").unionAll(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    rows = quality.quality(docs.withColumn("_id", F.lit(1))).collect()
    want = collections.Counter((r.doc_id, *quality_of(r.text)) for r in docs.collect())
    assert collections.Counter(tuple(r)[:6] for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.in_band)


def test_quality_bands(spark):
    rng = random.Random(1)
    noise = "".join(chr(rng.randrange(33, 127)) for _ in range(9000))
    noise = " ".join(noise[i:i + 7] for i in range(0, 9000, 7))
    prose = " ".join(rng.choice(("the", "a", "of")) + " " + "".join(rng.choice(("an", "er", "ti", "on", "th", "es", "ou", "ri")) for _ in range(rng.randrange(1, 4))) for _ in range(900))
    same = "".join(f"line {i} of the same words again and again. " for i in range(2000))
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame([(1, noise), (2, prose), (3, same)], "doc_id long, text string")).collect()}
    assert not got[1].in_band and got[2].in_band and not got[3].in_band
    assert got[2].ratio == pytest.approx(len(prose) / len(zstandard.ZstdCompressor(level=3).compress(prose.encode())))
    assert quality.quality(empty(spark)).count() == 0


def test_quality_last_chunk(spark):
    rng = random.Random(2)
    prose = lambda n: "".join(rng.choice(("the", "a", "of")) + " " + "".join(rng.choice(("an", "er", "ti", "on", "th", "es", "ou", "ri")) for _ in range(rng.randrange(1, 4))) + " " for _ in range(n))[:n]
    texts = [prose(4096) + "ab " * 1000, prose(7096), prose(4095), prose(4096), prose(4097), prose(8192)]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].n_chunks for i in range(6)] == [2, 2, 0, 1, 2, 2]
    assert [got[i].n_bad_chunks for i in range(6)] == [1, 0, 0, 0, 0, 0]
    assert not got[0].in_band and all(got[i].in_band for i in range(1, 6))


@pytest.fixture(scope="module")
def library():
    import base64
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(spark, library):
    docs = messy(spark).unionByName(spark.read.parquet(f"{SF}/documents.parquet"), allowMissingColumns=True)
    got = bpe.encode(docs, queries.RANKS, queries.PATTERN, chunk_chars=256, overlap=32, decoded=True).collect()
    want = collections.Counter((r.doc_id, np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes(), (r.text or "").encode()) for r in docs.collect())
    assert collections.Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want


def test_bpe_pieces_longer_than_the_overlap(spark, library):
    rng = random.Random(4)
    texts = ["x" * 300, " " * 100 + "a" + " " * 50, "it's we'll they're " * 20, "!" * 200 + "é" * 90 + "1" * 77, "a\U00018da7b " * 40]
    for _ in range(60):
        texts.append("".join(rng.choice(("a", "bc", " ", "\n", "  ", "'", "'s", "'ll", "7", "!", "é", "漢", "x" * 30)) for _ in range(rng.randrange(200))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.encode(docs, queries.RANKS, queries.PATTERN, chunk_chars=17, overlap=9)
    for r in got.collect():
        assert bytes(r.ids) == np.array(library.encode_ordinary(texts[r.doc_id]), "<u4").tobytes(), repr(texts[r.doc_id])
    assert bpe.encode(empty(spark), queries.RANKS, queries.PATTERN).count() == 0
    back = got.select("doc_id", bpe.decode(F.col("ids"), queries.RANKS, queries.PATTERN).alias("b")).collect()
    assert all(bytes(r.b) == texts[r.doc_id].encode() for r in back)


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_dac_segment(n):
    rng = np.random.default_rng(n)
    ids = (rng.integers(0, 1 << 31, n) >> rng.integers(0, 31, n)).astype(np.uint32)
    s = dac.Segment(dac.pack(np.array([4, 9]), np.array([n, 0]), ids))
    assert (s.all() == ids).all() and s.doc_ids.tolist() == [4, 9]
    at = rng.permutation(n)
    assert (s.at(at) == ids[at]).all()
    with pytest.raises(IndexError):
        s.at(np.array([n]))


def test_token_files(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.WORDS)
    docs = messy(spark).select("doc_id", "text").unionAll(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 100", "text"))
    path = C.scratch(spark, "test-tokens")
    dac.write_tokens(docs, path, queries.WORDS, 1, segment_tokens=2000)
    got = sorted(dac.documents(*dac.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in docs.collect()], key=lambda i: (i is not None, i))
    want = collections.Counter()
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [1]
        want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    every = [i for r in sorted(got, key=lambda r: r.start) for i in [None] * r.n_tokens]
    for part, seq, at in dac.read_tokens(spark, path)[1].collect():
        payload = spark.read.parquet(path).where((F.col("part") == part) & (F.col("seq") == seq)).first().payload
        ids = dac.Segment(bytes(payload)).all()
        every[at:at + len(ids)] = ids.tolist()
    rng = random.Random(3)
    places = [0, len(every) - 1, len(every), -1, None, 1999, 2000, 2000, 2001] + [rng.randrange(len(every)) for _ in range(300)]
    frame = spark.createDataFrame([(p,) for p in places], "position long")
    for span in (1 << 20, 700):
        tokens = dac.token_at(spark, path, frame, span=span).collect()
        assert len(tokens) == len(set(places))
        assert all(r.token == (every[r.position] if r.position is not None and 0 <= r.position < len(every) else None) for r in tokens)
    path = C.scratch(spark, "test-tokens")
    dac.write_tokens(empty(spark), path, queries.WORDS, 1)
    assert dac.documents(*dac.read_tokens(spark, path)).count() == 0
    assert dac.token_at(spark, path, frame).where("token is not null").count() == 0


def test_token_files_are_plain(spark):
    import pyarrow.parquet as pq
    path = C.scratch(spark, "test-tokens")
    dac.write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), path, queries.WORDS, 1)
    import glob
    for name in glob.glob(path.removeprefix("file:") + "/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            column = [meta.row_group(g).column(k) for k in range(meta.num_columns)][-1]
            assert column.path_in_schema == "payload" and column.compression == "UNCOMPRESSED" and not column.has_dictionary_page


def test_runs_equal_library():
    from tokenizers import Tokenizer
    rng = random.Random(5)
    bits = ["a", "Bc", " ", "\n", ".", ",", ")", '"', "!", "?", "é", "×", "÷", "<", "|", ">", "'s", "'", "9", "漢", "ı", "İ", "]", ";", "%%", "<|endoftext|>", "e\u0301", "=\u0338", "’"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(4000)]
    with open(queries.WORDS, "rb") as f:
        tok, own = dac.WordTokenizer(f.read(), 1), Tokenizer.from_file(queries.WORDS)
    assert tok.by_runs
    for text, blob in zip(texts, tok.encode([t.encode() for t in texts])):
        assert blob == np.array(own.encode(text, add_special_tokens=False).ids + [1], "<u4").tobytes(), repr(text)


def test_other_tokenizers_get_whole_texts():
    import json
    from tokenizers import Tokenizer
    with open(queries.WORDS, "rb") as f:
        spec = json.load(f)
    texts = ["Hello, WORLD. It's 3pm", "a  b\n\nc", "", "x<|endoftext|>Y, z."]
    same = json.dumps(spec).encode()
    keeps_case = json.dumps(spec | {"normalizer": None}).encode()
    one_piece = json.dumps(spec | {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}).encode()
    cut = json.dumps(spec | {"truncation": {"direction": "Right", "max_length": 2, "strategy": "LongestFirst", "stride": 0}}).encode()
    for blob, by_runs in ((same, True), (keeps_case, False), (one_piece, False), (cut, True)):
        tok, own = dac.WordTokenizer(blob, 1), Tokenizer.from_str(blob.decode())
        own.no_truncation()
        assert tok.by_runs == by_runs
        want = [np.array(own.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes() for t in texts]
        assert tok.encode([t.encode() for t in texts]) == want


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 150 and sum(r.lang == r.lang_pred for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id % 1 == 0 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in out} == {True}


def test_language_edges(spark):
    model = langid.train([b"the cat and the dog " * 20, "le chat où déjà ".encode() * 20], ["en", "fr"], epochs=4)
    got = langid.identify(messy(spark), model=model).collect()
    assert len(got) == 11
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (2, 3, 4, 7) or (r.doc_id is None and r.score == 0))
    assert langid.identify(empty(spark)).count() == 0
    none = messy(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(none).collect()} == {"und"}
    assert {r.doc_id for r in langid.keep_known(none).collect()} == {1, 5, 6, 8, None}


def forward(model, text):
    """The network by plain loops: every window, every filter, every place."""
    data, total = text.encode(), np.zeros(len(model.langs))
    for start in range(0, len(data), langid.WINDOW):
        window = data[start:start + langid.WINDOW]
        padded = window + bytes([langid.PAD]) * (langid.WINDOW - len(window))
        pooled = []
        for table, bias in zip(model.tables, model.bias):
            for f in range(langid.FILTERS):
                conv = [sum(float(table[j][padded[p + j]][f]) for j in range(len(table))) for p in range(langid.WINDOW - len(table) + 1)]
                pooled.append(max(0.0, max(conv) + float(bias[f])))
        z = [sum(x * float(w) for x, w in zip(pooled, model.weight[:, c])) + float(model.offset[c]) for c in range(len(model.langs))]
        high = max(z)
        total += (np.array(z) - high - np.log(sum(np.exp(v - high) for v in z))) * len(window)
    p = np.exp(total / len(data))
    return p / p.sum()


def test_language_equals_plain_loops(spark):
    model = langid.train([b"the cat and the dog " * 20, "le chat où déjà ".encode() * 20, b"der hund und die katze " * 3], ["en", "fr", "de"], epochs=3)
    texts = ["the dog", "a" * 255 + "é", "où " * 400, "katze und " * 100 + "the cat", "x", "le chat and the hund " * 13]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model=model).collect()}
    for i, t in enumerate(texts):
        p = forward(model, t)
        assert got[i].score == pytest.approx(p.max(), abs=1e-4) and got[i].lang_pred == model.langs[int(p.argmax())]


def test_language_of_long_texts_in_pieces(spark, monkeypatch):
    model = langid.train([b"the cat and the dog " * 20, "le chat où déjà ".encode() * 20], ["en", "fr"], epochs=3)
    texts = ["the cat " * 700, "", "où déjà " * 300, None, "the " * 64, "le chat and " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: (r.lang_pred, pytest.approx(r.score, abs=1e-6)) for r in langid.identify(docs, model=model).collect()}
    monkeypatch.setattr(langid, "PIECE", 512)  # goes to the tasks with the function
    small = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model=model).collect()}
    assert small == want


def test_language_sample_of_equal_hashes(spark):
    """Rows of one id share a hash: no bound by row counts finds them, and the fit still takes them."""
    rows = [(1, ("the cat and dog " if k % 2 else "le chat et chien ") * 5 + "x" * (k % 2), "en" if k % 2 else "fr") for k in range(400)]
    assert zlib.crc32(b"1") % 5 != 0
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=5)
    assert model.langs == ["en", "fr"]


def parts_frame(spark, rows):
    return spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>, t string, formatted string")


def part(kind, text=None, ref=None, w=None, h=None, s=None, p=None):
    return (kind, text, ref, w, h, s, p)


def test_chat_parts_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\<s>", "\\\\[INST]\\", "<|end|>\n<|turn|> user <|body|> x", " <|image|> ", "plain\\", ""]
    rows = [(1, 0, "user", [part("text", "See "), part("image", ref="a.png", w=28, h=15), part("text", nasty[0])], "", ""),
            (1, 1, "assistant", [part("audio", ref="b.wav", s=1.5), part("document", ref="c.pdf", p=2), part("text", nasty[2])], "", "")]
    rows += [(2, i, "assistant" if i % 2 else "us<s>er", [part("text", t)], "", "") for i, t in enumerate(nasty)]
    rows += [(3, None, None, None, "", ""), (3, 1, "assistant", [None, part("text", None), part("image", ref="z")], "", ""), (None, 0, "user", [], "", "")]
    rows += [(4, 0, "user", [part("text", "same")], "", "")] * 2
    out = chat.format_chat(parts_frame(spark, rows))
    got = {r.conv_id: r for r in out.withColumn("back", chat.parse(F.col("formatted"))).collect()}
    assert [(x.type, x.ref, x.tokens, x.turn) for x in got[1].attachments] == [("image", "a.png", 4, 0), ("audio", "b.wav", 38, 1), ("document", "c.pdf", 1024, 1)]
    assert got[1].expanded_tokens == 4 + 38 + 1024 and got[1].formatted.count(" <|image|> ") == 1
    assert [(x.role, x.text) for x in got[1].back] == [("user", "See " + nasty[0]), ("assistant", nasty[2])]
    assert [x.text for x in got[2].back] == nasty and got[2].back[0].role == "us<s>er"
    assert [(x.role, x.text) for x in got[3].back] == [("", ""), ("assistant", "")] and got[None].n_turns == 1
    assert got[4].n_turns == 2
    for r in got.values():
        spans = [r.formatted[s.start:s.start + s.length] for s in r.loss_spans]
        assert len(spans) == sum(r.loss_mask)
        for body in spans:
            assert f" <|body|> {body} <|end|>\n" in r.formatted
    assert chat.format_chat(parts_frame(spark, [])).count() == 0


def test_chat_digests(spark):
    got = {r.conv_id: r for r in queries.chat_format(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.conv_id].append((r.turn, r.role, r.text))
    by[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        said = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_public_files_are_parameters():
    assert queries.WORDS == public_tokenizers.path("word_bpe_49k.json")
