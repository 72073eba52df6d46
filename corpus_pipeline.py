"""From raw documents to a token file: language ID, near-dedup, decontamination, mixing, token ids."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, mixing, near_dedup, token_file
from tidemark.llm.workers import ship
from tidemark.session import checkpoint_dir
from tidemark.sources.store import settle

TOKENIZER = "word_bpe_49k.json"
LEAST_COSINE = 0.03     # one standard deviation of the cosine of unrelated vectors with 1024 dimensions


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those of some words that are like no language learned from the labelled ones."""
    ship(spark)
    return language_id.recognised(docs, language_id.learn(docs), LEAST_COSINE)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the row with the smallest id stays, null ids first.

    Rows are told apart by id and place, so of rows with equal ids and texts one stays too; documents without words
    have no duplicates.
    """
    ship(spark)
    key = "key_" + "_".join(docs.columns)       # equal to no column's name
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row")))
    groups = near_dedup.near_duplicates(keyed, k=5, percent=80, id_col=key)
    gone = groups.where(~F.col("kept")).select(F.col("doc_id").alias("gone"))
    return keyed.join(gone, F.col(key) == F.col("gone"), "left_anti").drop(key)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage like a benchmark item go."""
    ship(spark)
    return decontamination.without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=0.8)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, or up to three times."""
    return mixing.mixed(docs, weights=(1, 2, 3), max_repeats=3)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file of all documents, and of each the start, length and checksum that reading it back gives."""
    ship(spark)
    folder = f"{checkpoint_dir(spark)}/token-file-{uuid.uuid4().hex}"
    return token_file.stored_digests(docs, public_tokenizers.path(TOKENIZER), folder)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token_file", token_ids),
]

ORACLE_SQL = None       # profiles, MinHash groups and byte-pair ids are beyond SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
