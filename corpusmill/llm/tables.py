"""Intermediate tables of a run, in the folder that the cluster names for them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusmill.durable import shared_folder


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


class Scratch:
    """Tables that one run writes and reads again; ``drop`` removes what is no longer read.

    Written tables cut the lineage: a lost executor costs reading a table again.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/corpusmill/{name}-{uuid.uuid4().hex}"
        self.names: list[str] = []
        self.tables: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_by(self, df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
        """A table that is dealt out by ``column``: joins on it leave its rows where they are.

        ``df`` should be dealt out in the same way, else every task writes a file for every bucket.
        """
        table = f"corpusmill_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, column).option("path", f"{self.folder}/{name}").saveAsTable(table, format="parquet")
        self.names.append(name)
        self.tables[name] = table
        return self.spark.table(table)

    def keep_only(self, *names: str) -> None:
        """Remove all other tables of the run."""
        for name in [n for n in self.names if n not in names]:
            self.drop(name)

    def drop(self, name: str) -> None:
        if name not in self.names:
            return
        self.names.remove(name)
        if name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(name)}")
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
