"""Registered queries of this subpackage: name -> callable(spark, sf_dir).

Each applies one operator, with production parameters, to its whole table
and derives the contract's digest columns from the operator's output.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm import (
    chat,
    conversation_repair,
    ctw,
    licenses,
    merkle,
    mixing,
    quality,
    sentencepiece_dropout,
    simhash,
    spelling,
    substring_dedup,
    token_files,
    url_filter,
)
from clickscope.session import checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op2_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_dropout.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = sentencepiece_dropout.encode_documents(_table(spark, sf_dir, "documents"), model)
    return encoded.select("doc_id", "n_tokens", "decoded_sha256", "lossless",
                          F.xxhash64("token_ids").alias("ids_hash"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(_table(spark, sf_dir, "documents"), keep=("doc_id",)).select("doc_id", "quality.*")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


def op5_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        tokenizer = f.read()
    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, tokenizer, end_id=2)
    return token_files.read_token_files(spark, manifest).withColumnRenamed("id", "doc_id")


def op6_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw.score_corpus(_table(spark, sf_dir, "documents"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "bits_per_byte")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.sample(_table(spark, sf_dir, "documents"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


# the contract's additional conversation
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], turns.schema)
    chats = chat.format_conversations(chat.linear_messages(turns.unionByName(probe)))
    back = chats.select("conv", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                        chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("conv").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(told, 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


def op9_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_fingerprints(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeated(_table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.count_words(_table(spark, sf_dir, "documents")))


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """The report on damaged ``turns`` (conv_id, turn, role, text), one row per conversation id they had before."""
    report = conversation_repair.repair_report(conversation_repair.damaged(turns))
    every = turns.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (every.join(report, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_sentencepiece_dropout": op2_sentencepiece_dropout,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_token_id_files": op5_token_id_files,
    "op6_ctw_scoring": op6_ctw_scoring,
    "op7_source_mixing": op7_source_mixing,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_merkle_fingerprints": op9_merkle_fingerprints,
    "op10_license_scan": op10_license_scan,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}
