"""The operators' queries, for the driver contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import bpe, chat, counts, decontaminate, nearest, pii, shards, simhash, simple8b, toxicity
from lamina.llm.shared import table

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    trick = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(trick).alias("text"))
    return chat.digests(chat.formatted(chat.chain(told.unionByName(extra)), unique=True))


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=1).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(table(spark, sf_dir, "documents"), 40)


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_bpe_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    return counts.edited_counts(counts.standard_edits(counts.plant(table(spark, sf_dir, "documents"), path)), path)


def op8_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_simhash_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op10_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (op1_chat_formatting, op2_token_blocks, op3_hash_tree_shards, op4_benchmark_leaks, op5_bpe_backtracking, op6_weak_supervision_pii, op7_edit_aware_counts, op8_hilbert_neighbours, op9_simhash_vp_trees, op10_subword_toxicity)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


_CONTROL = r"([<\[])(/?s>|/?INST\]|</?SYS>>|/?SYS\]|\|[A-Za-z0-9_]+\|>)"


def _escaped_length(text: str) -> str:
    return rf"length(regexp_replace(replace({text}, '\', '\\'), '{_CONTROL}', '\1\\\2', 'g'))"


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": f"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum({_escaped_length("role")} + {_escaped_length("text")} + 8)::BIGINT AS formatted_chars
FROM told GROUP BY conv_id""",
    }
