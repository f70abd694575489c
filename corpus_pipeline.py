"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.ranks import ranked
from corpusmill.llm import near_dedup, packing, quality_filter, secrets, substring_dedup
from corpusmill.llm.tables import Scratch


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but the key and the text under names that no operator uses."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"_column{i}")
                         for i, c in enumerate(docs.columns)])


def _restored(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``found``, made from ``_aside(docs)``, with the columns of ``docs``."""
    return found.select(*[F.col(c if c in ("doc_id", "text") else f"_column{i}").alias(c) for i, c in enumerate(docs.columns)])


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_key``: the id, or for rows without one a number beyond all ids."""
    own = docs.withColumn("_key", F.col("doc_id").cast("long"))
    none = docs.where("doc_id IS NULL")
    if none.isEmpty():
        return own
    largest = F.coalesce(F.max(F.col("doc_id").cast("long")), F.lit(0))
    beyond = ranked(none, "text", "_key").crossJoin(F.broadcast(docs.agg(largest.alias("_largest"))))
    return own.where("doc_id IS NOT NULL").unionByName(
        beyond.withColumn("_key", F.col("_key") + F.col("_largest") + 1).drop("_largest"))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _restored(quality_filter.resample(_aside(docs), labels).where("kept"), docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, a row without an id only if none has one.

    Rows that repeat an id are one document and stay or go together.
    """
    rows = _keyed(_aside(docs))
    groups = near_dedup.near_duplicates(rows, key="_key")
    return _restored(rows.join(groups.where("not kept").select("_key"), "_key", "left_anti"), docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; ``n_chars`` follows the text."""
    return _measured(substring_dedup.without_passages(docs))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked; ``n_chars`` follows the text."""
    found = secrets.find_secrets(_aside(docs))
    return _measured(_restored(found.withColumn("text", secrets.masked(F.col("text"), F.col("secrets"))), docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality classifier", good_documents),
    ("near-duplicate removal", distinct_documents),
    ("substring dedup", without_repeats),
    ("secret scan", without_secrets),
    ("packing", packed),
]

# Tokens, likelihoods and random draws are beyond SQL; tests/llm checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage returns is written, and read again by the next one."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
