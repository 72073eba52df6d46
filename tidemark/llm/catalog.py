"""The registered queries of this subpackage: thin digests of its operators over whole tables."""

from __future__ import annotations

import uuid

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversations, decontamination, language_id, line_dedup, merkle, mixing, near_dedup, packing, pitman_yor, quality_rules, sharding, token_counts, token_file
from tidemark.llm.text import LOWER, UPPER
from tidemark.llm.workers import ship
from tidemark.session import checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.score_texts(table(spark, folder, "documents"))


def op2_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"), shards=24, overhead=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"), least=0.8)


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.predict_languages(table(spark, folder, "documents"))


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), k=2, percent=80)


def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), weights=(1, 2, 3), max_repeats=3)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_token_file(spark: SparkSession, folder: str) -> DataFrame:
    out = f"{checkpoint_dir(spark)}/token-file-{uuid.uuid4().hex}"
    return token_file.stored_digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), out)


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, folder, "pages")).select(
        "page_id", "host", "host_pages", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_stop_words", "n_letters", "broken_rules")


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    text = F.coalesce("text", space)
    given = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"),
                        (F.crc32(key.cast("binary")) % 20).alias("way"))
    damaged = given.where("way <> 0").select(
        "conv_id", "turn", F.when(F.col("way") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("way") == 1, F.lit("")).when(F.col("way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    found = conversations.repair(damaged).withColumnRenamed("conv_id", "found")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    plain = [docs[c] for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0      # null ids are left alone
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest(*plain, docs["text"]).alias("digest"), F.when(
        tampered, merkle.leaf_digest(*plain, F.translate(docs["text"], UPPER, LOWER))).alias("tampered"))
    manifest = merkle.build(leaves, tree="lang", order=["doc_id"])
    root = F.lit(manifest.root)
    return merkle.proofs(manifest).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (op1_pitman_yor, op2_shards, op3_decontamination, op4_language_id, op5_near_dedup, op6_mix, op7_token_counts, op8_token_file, op9_line_dedup, op10_quality,
                                   op11_conversations, op12_merkle, op13_packing, pipeline)}
