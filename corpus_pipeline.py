"""Corpus pipeline: documents -> quality rules -> near-dedup -> mixing -> token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``. Every stage takes
an empty table (its result is empty), null texts (they count as empty), null
ids, sources and languages, repeated rows, and columns of any further names,
which it hands on. Results do not depend on the order of the rows or on how
they are partitioned; what a stage does with ties is said there.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickscope.llm import mixing, quality, sentencepiece_dropout, simhash
from clickscope.session import checkpoint_dir

# Per Python worker. Workers keep this cache beside the heap that the other stages' sorts and text functions fill.
CACHE_UNITS = 200_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    References are those of ``docs``. Repeated rows are judged alike; a null
    or blank text has too few words and goes; a null language has no reference,
    so only the base rule applies.
    """
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id.

    A null id stays only where its group has no other. Of rows that share that
    id, the one with the smallest text hash, then the smallest hash of all
    columns stays. Texts without words are one group.
    """
    return simhash.keep_representatives(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them: not at all, once, or repeated.

    A null source is a source of its own. Repeated rows draw each for
    themselves. A document without words comes as often as its source's
    complete epochs.
    """
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with a proof that they decode losslessly.

    The mix repeats documents, and each copy draws its own dropout: copies of
    one id and text are numbered from 1 by source, then language, nulls first.
    Rows equal in all four are interchangeable. A null text has no ids; a null
    id draws like an empty one.
    """
    model = sentencepiece_dropout.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    like = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.col("source").asc_nulls_first(), F.col("lang").asc_nulls_first())
    numbered = docs.select("doc_id", "text", "source", "lang").withColumn("copy", F.row_number().over(like))
    return sentencepiece_dropout.encode_documents(numbered, model, keep=("source", "lang"), copy_col="copy",
                                                  cache_units=CACHE_UNITS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("encoding", encoding),
]

# SimHash bits, keyed sampling and BPE merges are beyond SQL; tests/llm checks
# every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet
    under the shared checkpoint folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
