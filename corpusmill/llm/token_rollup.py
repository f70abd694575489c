"""Token counts by source, language and tokenizer version, maintained by signed changes.

A change adds a document, takes one away, or revises its count. Every batch is reduced to one signed
row per group and written to a folder named after the batch. A batch counts once it is
complete: committing it again does nothing, and what a failed try left behind is overwritten.
Totals are the sums over all complete batches, so neither order nor retries matter, and nothing
that was counted is read again.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.tokens import Encoder

GROUP = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, documents long, tokens long"


def counted(text: Column, encoders: dict[str, tuple]) -> Column:
    """Map of tokenizer version to number of tokens; ``encoders`` has (ranks, special, pattern)."""
    state: dict = {}

    @F.arrow_udf("map<string, bigint>")
    def count(column: pa.Array) -> pa.Array:
        if not state:
            state.update({v: Encoder(*e) for v, e in encoders.items()})
        rows = []
        for x in column:
            body = x.as_py()
            rows.append([(v, len(e.encode(body)) if body else 0) for v, e in state.items()])
        return pa.array(rows, pa.map_(pa.string(), pa.int64()))
    return count(F.coalesce(text.cast("string"), F.lit("")))


def inserts(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Changes that add documents; ``docs`` has the group columns and the counts."""
    return _changes(docs, F.lit(1), F.col(f"`{tokens}`"))


def deletes(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Changes that take documents away, with the counts that they were added with."""
    return _changes(docs, F.lit(-1), -F.col(f"`{tokens}`"))


def revisions(docs: DataFrame, before: str = "before", after: str = "after") -> DataFrame:
    """Changes that replace counts; the documents stay."""
    return _changes(docs, F.lit(0), F.coalesce(F.col(f"`{after}`"), F.lit(0)) - F.coalesce(F.col(f"`{before}`"), F.lit(0)))


def _changes(docs: DataFrame, documents: Column, tokens: Column) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in GROUP],
                       documents.cast("long").alias("documents"),
                       F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"))


class Rollup:
    """Totals in ``folder``, which the driver and all executors reach.

    Null sources, languages and versions are groups of their own; a null count counts as zero.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._path = lambda *parts: path("/".join((self.folder, *parts)))
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Names of the complete batches."""
        if not self._fs.exists(self._path()):
            return []
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path()))
        return [n for n in names if self._complete(n)]

    def _complete(self, batch: str) -> bool:
        return self._fs.exists(self._path(batch, "_SUCCESS"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes; false if that batch was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9-]*", batch):
            raise ValueError(f"batch names are letters, digits and hyphens: {batch!r}")
        if self._complete(batch):
            return False
        sums = changes.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        sums.select(*[F.col(c).cast(t) for c, t in (x.split() for x in SCHEMA.split(", "))]).write.mode(
            "overwrite").parquet(f"{self.folder}/{batch}")
        return True

    def totals(self) -> DataFrame:
        """Documents and tokens of every group that has any."""
        paths = [f"{self.folder}/{b}" for b in self.committed()]
        rows = (self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA))
        sums = rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0 or tokens <> 0")
