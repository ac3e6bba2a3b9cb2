"""One query per operator over its whole table, as the driver registers them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm import bitsim, bpe, chat, collocations, ctw, dac, decontam, langid, line_dedup, oracles, quality, suffix_dedup, trie, warc
from tabsmith.llm import common as C

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.scratch(spark, "tokens")
    dac.write_tokens(_table(spark, sf_dir, "documents"), path, WORDS, end_id=1)
    return dac.documents(*dac.read_tokens(spark, path))


def line_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(_table(spark, sf_dir, "documents"), held_out=1)


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    rows = rows.unionByName(extra)
    return chat.round_trip(rows.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts")))


#: Each control string in a text costs one backslash; the template costs 28 characters a turn.
CHAT_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length(role) + length(text) + 28
    + len(regexp_extract_all(role, '<\|(?:turn|body|end|image|audio|document)\|>|</?s>|\[/?INST\]'))
    + len(regexp_extract_all(text, '<\|(?:turn|body|end|image|audio|document)\|>|</?s>|\[/?INST\]')) as chars from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsim.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, radius=4)


def suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ids and of the bytes decoded from them."""
    ids = bpe.encode(docs, RANKS, PATTERN, decoded=True)
    return ids.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), held_out=0)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), least=100, longest=5, keep=2000)


def warc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_warc(warc.records_of(_table(spark, sf_dir, "pages"), least=0), C.scratch(spark, "archives"))
    return warc.pages_in(spark, path)


def rebuilt_paths(rows: DataFrame) -> DataFrame:
    """Paths whose first ``crc32(id) mod 6`` turns are those of conversation ``id - id % 100``."""
    return trie.with_openings(trie.paths_of(rows), 100, C.fold_of(F.col("conv_id"), 6), 5)


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(rebuilt_paths(_table(spark, sf_dir, "conversations"))).drop("node")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontamination,
    "op2_token_output": token_output,
    "op3_line_edits": line_edits,
    "op4_context_tree": context_tree,
    "op5_chat_format": chat_format,
    "op6_simhash": simhash,
    "op7_suffix_repeats": suffix_repeats,
    "op8_compression_bands": compression_bands,
    "op9_byte_bpe": byte_bpe,
    "op10_language": language,
    "op11_collocations": phrases,
    "op12_warc": warc_pages,
    "op13_prefix_trie": prefix_trie,
}
ORACLES: dict[str, str] = {"op5_chat_format": CHAT_SQL, "op11_collocations": oracles.PHRASES_SQL, "op12_warc": oracles.WARC_SQL, "op13_prefix_trie": oracles.TRIE_SQL}
