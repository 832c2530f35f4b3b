"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorflow.llm import bpe, chat, covertree, merkle, minhash, mixing, pii, pulearn, quality, shards, toxicity, warc, whitening
from mirrorflow.llm import oracles as O
from mirrorflow.llm.batches import bounded_batches
from mirrorflow.sources.scratch import materialise, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@register("op7_minhash_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, percent=85)


@register("op4_quality_divergence", O.QUALITY)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


@register("op8_personal_data", O.PERSONAL_DATA)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = [k.name for k in pii.KINDS if k.base]
    return found.select(
        "doc_id",
        *[number(k) for k in base],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@register("op2_chat_windows", O.CHAT)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = chat.read_back(chat.chat_windows(turns.unionByName(extra)))
    return found.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@register("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    rank_file, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.encode(F.col("text"), rank_file, pattern).alias("ids"))
    raw = coded.select("doc_id", "ids", bpe.decode(F.col("ids"), rank_file, pattern).alias("raw"))
    return raw.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


@register("op10_temperature_mix", O.MIX)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_blocks(read(spark, sf_dir, "documents"))


@register("op9_hilbert_shards", O.SHARDS)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "lang",
        "source",
    )
    # quarters of a power of two
    bits = "4 * length(bin(size)) + (shiftright(size, length(bin(size)) - 3) & 3)"
    rows = materialise(rows.withColumn("length_class", F.expr(bits)), "shard_rows")
    placed = shards.hilbert_shards(rows, ["source", "lang", "length_class"], "doc_id", 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


@register("op6_warc_dictionary", O.WARC)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    path = scratch_path(spark, "warc")
    warc.archive_pages(read(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).drop("payload")


@register("op3_ordinal_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_severity(docs, read(spark, sf_dir, "labels"))
    return toxicity.severity(docs, model)


@register("op1_cover_tree_dedup", O.VECTORS)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.vector_duplicates(read(spark, sf_dir, "embeddings"))


@register("op11_positive_unlabelled")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pulearn.quality_scores(docs, read(spark, sf_dir, "labels"))


@register("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(read(spark, sf_dir, "embeddings"))
    # null beyond a long: the sum of squares grows with the square of the number of vectors
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@register("op13_merkle_manifest", O.MERKLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked_documents(read(spark, sf_dir, "documents"))
