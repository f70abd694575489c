"""TF-IDF over words and word pairs: sublinear counts, smooth idf, unit rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.durable import written
from corpusmill.functions.grams import COUNTS, count_pairs, count_words, tfidf_cells

MIN_DF = 2
MAX_PAIRED = 50_000         # words, beyond those kept, that travel to tasks to choose pairs


def _lowered(text: str) -> Column:
    return F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _added_up(df: DataFrame, text: str, count) -> DataFrame:
    """``(term, ctf, df)``: occurrences, and rows a term occurs in, from one shuffle.

    Every task adds up the terms of some megabytes of text before they travel. A row is in one task,
    so no exchange by row is needed to count rows.
    """
    counts = df.select(_lowered(text).alias("text")).mapInArrow(count, COUNTS)
    return counts.groupBy("term").agg(F.sum("ctf").alias("ctf"), F.sum("df").alias("df"))


def _most_frequent(counts: DataFrame, max_features: int) -> DataFrame:
    return counts.orderBy(F.desc("ctf"), F.asc("term")).limit(max_features)


def vocabulary(df: DataFrame, max_features: int, text: str = "text",
               min_df: int = MIN_DF) -> DataFrame:
    """``(term, idx, ctf, df, idf)`` of the most frequent terms, indexed in term order.

    Ties in frequency go to the term that sorts first. Words are counted first. A pair occurs no more often than each of
    its words, so once there are ``max_features`` words, only pairs of words as frequent as the last of them can be
    among the most frequent terms, and other pairs don't travel.
    """
    words = written(_added_up(df, text, count_words).where(F.col("df") >= min_df), "words")
    best = _most_frequent(words, max_features)
    last = best.agg(F.count("*").alias("n"), F.min("ctf").alias("ctf")).head()
    often = None
    if last["n"] == max_features:
        often = [r.term for r in words.where(F.col("ctf") >= last["ctf"]).select("term").limit(MAX_PAIRED + max_features + 1).collect()]
    pairs = count_pairs(often if often is not None and len(often) <= MAX_PAIRED + max_features else None)
    kept = _most_frequent(best.unionByName(_added_up(df, text, pairs).where(F.col("df") >= min_df)), max_features)
    n = df.agg(F.count("*").alias("_n"))
    idf = F.log((1.0 + F.col("_n")) / (1.0 + F.col("df"))) + 1.0
    # The window sees at most max_features rows.
    return kept.crossJoin(F.broadcast(n)).select(
        "term", (F.row_number().over(Window.orderBy("term")) - 1).alias("idx"),
        "ctf", "df", idf.alias("idf"))


@dataclass(frozen=True)
class TfidfModel:
    """A fixed vocabulary of at most ``max_features`` terms with their idf weights."""

    terms: tuple
    idf: tuple

    @staticmethod
    def fit(df: DataFrame, max_features: int, text: str = "text", min_df: int = MIN_DF) -> "TfidfModel":
        rows = vocabulary(df, max_features, text, min_df).orderBy("idx").collect()   # bounded
        return TfidfModel(tuple(r.term for r in rows), tuple(r.idf for r in rows))

    def _weights(self, df: DataFrame, text: str) -> DataFrame:
        """Add ``_w``: ``{indices, values}`` with unit norm. Row-local: no shuffle."""
        return df.select(*[f"`{c}`" for c in df.columns], tfidf_cells(_lowered(text), self.terms, self.idf).alias("_w"))

    def transform(self, df: DataFrame, text: str = "text", into: str = "features") -> DataFrame:
        """Add sparse rows ``{indices, values}``; a row without any vocabulary term has none."""
        if not self.terms:
            raise ValueError("the vocabulary is empty: no term occurs in enough rows")
        return self._weights(df, text).withColumnRenamed("_w", into)

    def long_form(self, df: DataFrame, key: str, text: str = "text") -> DataFrame:
        """``(key, term, weight)``; rows without a term do not appear."""
        if not self.terms:
            return df.select(key, F.lit("").alias("term"), F.lit(0.0).alias("weight")).limit(0)
        names = df.sparkSession.createDataFrame(
            list(enumerate(self.terms)), "idx int, term string")        # at most max_features
        pairs = F.explode_outer(F.arrays_zip("_w.indices", "_w.values"))
        cells = self._weights(df.select(key, text), text).select(key, pairs.alias("p"))
        return (cells.select(key, F.col("p.indices").alias("idx"), F.col("p.values").alias("weight"))
                     .join(F.broadcast(names), "idx").select(key, "term", "weight"))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(i, t, w) for i, (t, w) in enumerate(zip(self.terms, self.idf))],
            "idx int, term string, idf double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TfidfModel":
        rows = spark.read.parquet(path).orderBy("idx").collect()
        return TfidfModel(tuple(r.term for r in rows), tuple(r.idf for r in rows))


def tfidf(df: DataFrame, key: str, max_features: int, text: str = "text") -> DataFrame:
    return TfidfModel.fit(df, max_features, text).long_form(df, key, text)
