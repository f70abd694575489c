"""Result writers. Every sink writes in parallel, one file per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def export(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """CSV or Parquet; nested columns become JSON text in CSV."""
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
        return path
    if fmt != "csv":
        raise ValueError(f"unsupported format {fmt!r}; use 'csv' or 'parquet'")
    flat = [F.to_json(c).alias(c)
            if isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType)) else c
            for c in df.columns]
    return write_csv(df.select(flat), path, mode)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines: task documents, issue reports and metric tables."""
    df.write.mode(mode).json(path)
    return path
