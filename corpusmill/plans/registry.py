"""Registered queries, each with the SQL that another engine runs to check it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import SPACE_CHARS
from corpusmill.sources.landed import normalise, spread

QUERIES: dict = {}
ORACLES: dict = {}

COLLECTED_AT = "2024-01-01T00:00:00Z"

# Stems that occur in the test corpus.
LEXICON = {"pos": ("tion", "ment", "the", "para", "ing "), "neg": ("eau", "ung", "sch", "ción", "wh")}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for work that reads every character of every text."""
    return spread(table(spark, sf, "documents"), "doc_id")


def corpus(spark: SparkSession, sf: str, extra=()) -> DataFrame:
    """Documents with their labels as unified records keyed by ``row_id``."""
    quality = F.col("quality")
    raw = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("row_id"), "text", F.col("source").alias("_source"),
        F.when(quality == 1, "pos").when(quality == 0, "neg").alias("label"), *extra)
    return normalise(raw, "", COLLECTED_AT, keep=["row_id", "_source", *extra]).withColumn(
        "source", F.col("_source")).drop("_source")


CORPUS = f"""corpus AS (
  SELECT d.doc_id AS row_id, nullif(trim(d.text, '{SPACE_CHARS}'), '') AS text,
         CAST(NULL AS VARCHAR) AS audio, CAST(NULL AS VARCHAR) AS image,
         CASE l.quality WHEN 1 THEN 'pos' WHEN 0 THEN 'neg' END AS label,
         d.source, '{COLLECTED_AT}' AS collected_at, d.n_chars, l.toxic
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

UNIFIED = "row_id, text, audio, image, label, source, collected_at"


def _hits(stems, column: str) -> str:
    return " + ".join(f"CAST(contains({column}, '{s}') AS INT)" for s in stems)


LABELLED = f"""hits AS (
  SELECT *, lower(coalesce(text, '')) AS lowered, {_hits(LEXICON['pos'], "lower(coalesce(text, ''))")} AS p,
         {_hits(LEXICON['neg'], "lower(coalesce(text, ''))")} AS g FROM corpus),
labelled AS (
  SELECT * EXCLUDE (lowered, p, g),
         CASE WHEN p + g = 0 THEN CASE WHEN length(lowered) > 300 THEN 'neg' ELSE 'pos' END
              WHEN p >= g THEN 'pos' ELSE 'neg' END AS auto_label,
         CASE WHEN p + g = 0 THEN 0.51
              ELSE round(0.5 + CAST(greatest(p, g) AS DOUBLE) / (p + g) * 0.49, 4) END AS confidence,
         '{COLLECTED_AT}' AS auto_label_at
  FROM hits)"""
