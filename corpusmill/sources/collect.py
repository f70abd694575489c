"""Collect from a list of source specifications into one unified table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources import landed
from corpusmill.sources.html import scrape
from corpusmill.sources.sinks import write_csv

# Source types, and the loaders or kinds each accepts (default first).
KINDS = {"hf_dataset": ("loader", ("hub_csv", "datasets_server")),
         "api": ("api_kind", ("json_flat", "csv_http", "csv_http_concat")),
         "scrape": (None, ())}


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def kind_of(spec: dict) -> str:
    """Validated kind of one specification, so errors surface before any job starts."""
    if spec.get("type") not in KINDS:
        raise ValueError(f"unknown source type {spec.get('type')!r}")
    option, allowed = KINDS[spec["type"]]
    kind = spec.get(option, allowed[0]) if option else "scrape"
    if option and kind not in allowed:
        raise ValueError(f"unknown {option} {kind!r}; use one of {allowed}")
    need = {"csv_http_concat": "paths"}.get(kind, "path")
    if need not in spec:
        raise ValueError(f"{spec['type']}/{kind} needs {need!r}, where the data was landed")
    return kind


def _record(text: str, label: str) -> T.StructType:
    return T.StructType([T.StructField(text, T.StringType()), T.StructField(label, T.StringType())])


def load(spark: SparkSession, spec: dict, collected_at: str) -> DataFrame:
    """One landed source as unified records.

    ``path``/``paths`` name landed CSV files, a table of JSON bodies (``page`` or
    ``offset``, and ``payload``) or a table of pages (``page_id, url, html``). ``max_rows`` caps
    the rows of the source; without it all rows are read.
    """
    kind = kind_of(spec)
    if kind == "scrape":
        return scrape(spark.read.parquet(spec["path"]), spec.get("selector", "body"), collected_at)
    cap = int(spec["max_rows"]) if spec.get("max_rows") is not None else None
    text = spec.get("text_column" if kind == "hub_csv" else "text_field", "text")
    label = spec.get("label_column" if kind == "hub_csv" else "label_field", "label")
    name = spec.get("name", spec.get("path"))
    default_id = {"hub_csv": f"hf:{name}", "datasets_server": f"api:hf-rows:{name}",
                  "csv_http": "api:csv", "csv_http_concat": "api:csv-concat",
                  "json_flat": "api:json"}[kind]
    if kind in ("hub_csv", "csv_http", "csv_http_concat"):
        paths = spec["paths"] if kind == "csv_http_concat" else [spec["path"]]
        rows = landed.capped_concat(landed.read_csv_in_order(spark, paths), cap)
    elif kind == "json_flat":
        rows = landed.paged_records(
            spark.read.parquet(spec["path"]), _record(text, label), cap,
            spec.get("params", {}).get("page_size"), spec.get("records_path"))
    else:
        bodies, order = spark.read.parquet(spec["path"]), ["offset", "pos"]
        allowed = spec.get("label_allow")
        reach = landed.ALLOW_LOOKAHEAD * cap if allowed and cap is not None else cap
        rows = landed.envelope_rows(bodies, _record(text, label), reach)
        if allowed:
            rows = landed.allow_listed(rows, label, allowed, cap, order)
    return landed.normalise(rows, spec.get("source_id", default_id), collected_at, text, label,
                            spec.get("label_map"))


def collect(spark: SparkSession, specs, collected_at: str | None = None,
            out_path: str | None = None) -> DataFrame:
    """All sources merged, with one timestamp per run; saved as CSV when asked."""
    specs = list(specs)
    for spec in specs:
        kind_of(spec)
    at = collected_at or utc_now()
    unified = landed.merge([load(spark, s, at) for s in specs], spark=spark)
    if out_path:
        write_csv(unified, out_path)
    return unified


def summary(df: DataFrame) -> DataFrame:
    """Total rows, rows per label and rows per source, from one scan."""
    g = df.groupingSets([["label"], ["source"], []], "label", "source").agg(
        F.count("*").alias("n"), F.grouping_id().alias("_g"))
    section = F.when(F.col("_g") == 1, "label").when(F.col("_g") == 2, "source").otherwise("total")
    value = F.when(F.col("_g") == 1, F.col("label")).when(F.col("_g") == 2, F.col("source"))
    return g.select(section.alias("section"), value.alias("value"), "n")
