"""The package's own table of queries and of the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
