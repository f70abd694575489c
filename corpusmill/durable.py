"""Cutting lineage through the shared folder the cluster names."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="corpusmill-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


ROW_GROUP_BYTES = 16 << 20       # a file can be read by as many tasks as it has row groups


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Later stages then scan a table, with column pruning, and a lost executor costs a
    re-read and not a recomputation of everything before. Row groups are small: tasks that do work on
    each text then get equal parts, however few files there are.
    """
    path = f"{shared_folder(df.sparkSession)}/corpusmill/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
