"""Repair a table: missing values, then duplicates, then outliers."""

from __future__ import annotations

import json
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.keys import keep_first, require_unique
from corpusmill.functions.quantiles import exact_quantiles
from corpusmill.operators.quality import (
    TEXT_LEN, fences, outlier_candidates, outside, with_text_length)
from corpusmill.schema import nan_to_null, numeric_columns, role_columns, text_role, with_fraction

# Named strategies and the text that stands for a missing text.
PRESETS = {
    "aggressive": {"missing": "drop", "duplicates": "drop", "outliers": "drop"},
    "conservative": {"missing": "fill", "duplicates": "keep_first", "outliers": "keep"},
    "balanced": {"missing": "drop", "duplicates": "keep_first", "outliers": "clip_iqr"},
}
MISSING_TEXT = "[missing]"
SMALL_RESULT = 100
Z_LIMIT = 3.0
Z_EPSILON = 1e-9


def strategy_of(strategy) -> dict:
    """A preset name, a JSON object or a dict -> a dict."""
    if isinstance(strategy, dict):
        return strategy
    return PRESETS[strategy] if strategy in PRESETS else json.loads(strategy)


def fill_missing(df: DataFrame, key: str) -> DataFrame:
    """Missing text becomes ``[missing]``, missing numbers their column's median.

    A median may lie between two values: integer and decimal columns get one decimal place more, exactly,
    and floating columns are double, whether anything is missing or not.
    """
    text, numeric = text_role(df), numeric_columns(df, exclude={key})
    out = df.fillna({text: MISSING_TEXT}) if text else df
    if not numeric:
        return out
    medians = exact_quantiles(df, numeric, (0.5,), exact=True)

    def filled(c):
        kind = with_fraction(df.schema[c].dataType, 1)
        return F.coalesce(F.col(f"`{c}`").cast(kind), F.lit(medians[c].values[0]).cast(kind)).alias(c)
    return out.select(*[filled(c) if c in numeric else F.col(f"`{c}`") for c in df.columns])


def fix_missing(df: DataFrame, how: str, key: str) -> DataFrame:
    if how == "drop":
        return df.dropna(how="any",
                         subset=role_columns(df) or [c for c in df.columns if c != key])
    return fill_missing(df, key) if how in ("fill", "median") else df


def fix_duplicates(df: DataFrame, how: str, key: str) -> DataFrame:
    """One row of each group, the one with the smallest key; a key that is null or repeats is an error."""
    if how not in ("drop", "keep_first"):
        return df
    require_unique(df.select(F.col(f"`{key}`")), key)
    return keep_first(df, role_columns(df) or [c for c in df.columns if c != key], key)


def fix_outliers(df: DataFrame, how: str, key: str) -> DataFrame:
    """Clip numbers to the fences, or drop rows outside fences or far by z-score.

    Text length is only ever a reason to drop a row: clipping does not cut text.
    Every column's bounds come from the same, unfiltered table; null is kept. A fence may be a fraction:
    clipped integer and decimal columns get three decimal places more, exactly, and floating ones are
    double, whether anything is clipped or not.
    """
    if how not in ("clip_iqr", "drop", "zscore_drop"):
        return df
    work = with_text_length(df)
    cols = outlier_candidates(work, key)
    if how == "clip_iqr":
        cols = [c for c in cols if c != TEXT_LEN]
    if not cols:
        return df
    # Several passes over a few numbers per row, after work that is worth doing once.
    narrow = work.select([F.col(f"`{c}`") for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bounds = fences(narrow, cols, exact=how == "clip_iqr")
        if not bounds and how != "clip_iqr":
            return df
        stats = narrow.agg(*[a for i, c in enumerate(bounds) for a in (
            F.avg(f"`{c}`").alias(f"mean{i}"), F.stddev_samp(f"`{c}`").alias(f"std{i}"))]).head() \
            if how == "zscore_drop" else None
    finally:
        narrow.unpersist()
    if how == "clip_iqr":
        def clipped(c):
            kind = with_fraction(df.schema[c].dataType, 3)
            x = F.col(f"`{c}`").cast(kind)
            if c in bounds:
                low, high = (F.lit(v).cast(kind) for v in bounds[c])
                x = F.when(x < low, low).when(x > high, high).otherwise(x)
            return x.alias(c)
        return df.select(*[clipped(c) if c in cols else F.col(f"`{c}`") for c in df.columns])
    keep = []
    for i, (c, b) in enumerate(bounds.items()):
        if how == "drop":
            out = outside(c, b)
        else:
            z = (F.col(f"`{c}`") - F.lit(stats[f"mean{i}"])) / F.lit(stats[f"std{i}"] + Z_EPSILON)
            out = ~(F.abs(z) <= Z_LIMIT)
        keep.append(~F.coalesce(out, F.lit(False)))
    return work.where(reduce(lambda a, b: a & b, keep)).select(*df.columns)


def fix(df: DataFrame, strategy="balanced", key: str = "row_id") -> DataFrame:
    """Cleaned table. ``key`` is the unique row key that defines "first"."""
    plan = strategy_of(strategy)
    out = fix_missing(nan_to_null(df), plan.get("missing", "drop"), key)
    out = fix_duplicates(out, plan.get("duplicates", "keep_first"), key)
    return fix_outliers(out, plan.get("outliers", "clip_iqr"), key)


def fix_report(before: DataFrame, strategy="balanced", key: str = "row_id") -> DataFrame:
    """``(step, rows, removed, small_result)`` after each repair step."""
    plan = strategy_of(strategy)
    base = nan_to_null(before)
    filled = fix_missing(base, plan.get("missing", "drop"), key)
    unique = fix_duplicates(filled, plan.get("duplicates", "keep_first"), key)
    final = fix_outliers(unique, plan.get("outliers", "clip_iqr"), key)
    steps = [("input", base), ("missing", filled), ("duplicates", unique), ("outliers", final)]
    counts = [d.agg(F.lit(name).alias("step"), F.count("*").alias("rows"),
                    F.lit(i).alias("_i")) for i, (name, d) in enumerate(steps)]
    table = reduce(DataFrame.unionByName, counts)             # four rows
    prior = table.select((F.col("_i") + 1).alias("_i"), F.col("rows").alias("_prior"))
    return table.join(F.broadcast(prior), "_i", "left").select(
        "step", "rows", F.coalesce(F.col("_prior") - F.col("rows"), F.lit(0)).alias("removed"),
        (F.col("rows") < SMALL_RESULT).alias("small_result"))
