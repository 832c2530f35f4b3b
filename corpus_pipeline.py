"""From raw documents to token ids: the stages of a training corpus, each written and read again.

1. Quality rules: documents that the repetition or divergence rules reject go.
2. Near duplicates at a similarity of 0.8 on five-word shingles: one row of each group stays, that of
   the least id. Unlike texts that share an id all stay; rows without an id are judged like others.
3. Personal data: matches that hold are replaced by their kind; ``n_chars`` follows the text.
4. Mixing: sources by temperature, each document at least once and its source twice at most.
5. Byte-level BPE: the token ids of each row.

All but the last return the columns they are given. Null texts count as empty ones and go with the
quality rules.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorflow.llm import bpe, minhash, mixing, pii, quality
from mirrorflow.llm.batches import bounded_batches
from mirrorflow.sources.scratch import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    ids = bpe.encode(
        F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    coded = docs.select("doc_id", "source", ids.alias("ids"))
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

#: Token ids are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
