"""Align modality tables on a key and describe the aligned table."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.keys import first_per_group, require_unique
from corpusmill.operators.quality import _stack, value_counts
from corpusmill.schema import is_missing, nan_to_null, numeric_columns

# Feature columns a modality may carry, and the shared columns.
MODALITY_FEATURES = {
    "text": ["text_len", "word_count", "avg_word_len"],
    "image": ["img_mean_r", "img_mean_g", "img_mean_b", "img_std", "img_brightness",
              "img_contrast"],
    "audio": [f"mfcc_{i}" for i in range(1, 14)] + ["zcr", "spectral_centroid",
                                                    "spectral_bandwidth", "rms_energy"],
}
SHARED = ("label", "source", "collected_at")
MIN_CORRELATED = 10
ROUNDING = 1e-13             # share of the squares below which a spread is no spread


@dataclass(frozen=True)
class Modality:
    df: DataFrame
    kind: str
    path: str = ""

    @property
    def features(self) -> list[str]:
        return [c for c in MODALITY_FEATURES.get(self.kind, []) if c in self.df.columns]


def load_modality(spark: SparkSession, path: str, kind: str, fmt: str = "csv") -> Modality:
    """A modality table; known feature columns become doubles. It must have ``id``."""
    df = (spark.read.option("header", True).csv(path) if fmt == "csv"
          else spark.read.format(fmt).load(path))
    if "id" not in df.columns:
        raise ValueError(f"modality table {path!r} has no 'id' column")
    numeric = set(MODALITY_FEATURES.get(kind, []))
    return Modality(df.select([F.col(c).cast("double").alias(c) if c in numeric else F.col(c)
                               for c in df.columns]), kind, path)


def prefixed(df: DataFrame, name: str, key: str = "id") -> DataFrame:
    return df.select([F.col(f"`{c}`") if c in (key, *SHARED)
                      else F.col(f"`{c}`").alias(f"{name}__{c}") for c in df.columns])


def align(modalities: dict, key: str = "id", how: str = "inner",
          coalesce_shared: bool = False, repeated_keys: str = "error") -> DataFrame:
    """Join modalities on ``key`` in the given order (inner, outer, left or right).

    A shared column already on the left is dropped from the right, so rows that only
    the right has get null there unless ``coalesce_shared``. A key that is null or repeats within
    a modality is an error, found by counting keys first; with ``repeated_keys="multiply"`` nothing is
    checked, and rows of equal keys meet in all combinations.
    """
    if repeated_keys not in ("error", "multiply"):
        raise ValueError("repeated_keys is 'error' or 'multiply'")
    tables = {n: m.df if isinstance(m, Modality) else m for n, m in modalities.items()}
    if repeated_keys == "error":
        for df in tables.values():
            require_unique(df.select(F.col(f"`{key}`")), key)
    frames = [prefixed(df, n, key) for n, df in tables.items()]
    out = frames[0]
    for right in frames[1:]:
        both = [c for c in SHARED if c in right.columns and c in out.columns]
        if coalesce_shared:
            right = right.withColumnsRenamed({c: f"_right_{c}" for c in both})
            out = out.join(right, key, how)
            out = out.withColumns({c: F.coalesce(c, f"_right_{c}") for c in both}).drop(
                *[f"_right_{c}" for c in both])
        else:
            out = out.join(right.drop(*both), key, how)
    return out


def prefixes(df: DataFrame) -> list[str]:
    return list(dict.fromkeys(c.split("__")[0] for c in df.columns if "__" in c))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in numeric_columns(df) if "__" in c]


def coverage(df: DataFrame) -> DataFrame:
    """``(modality, coverage_pct)``: rows with every column of the modality present."""
    names = prefixes(df)
    whole = {p: reduce(lambda a, b: a & b, [~is_missing(df, c) for c in df.columns
                                            if c.startswith(f"{p}__")]) for p in names}
    row = df.agg(*[F.round(100 * F.avg(whole[p].cast("int")), 1).alias(f"c{i}")
                   for i, p in enumerate(names)])
    return _stack(row, [(F.lit(p), F.col(f"c{i}")) for i, p in enumerate(names)],
                  ("modality", "coverage_pct"))


def modality_stats(df: DataFrame) -> DataFrame:
    """``(modality, feature, mean, std, missing_pct)`` of numeric features, one scan."""
    work = nan_to_null(df)
    cols = feature_columns(work)
    row = work.agg(F.count("*").alias("_rows"), *[a for i, c in enumerate(cols) for a in (
        F.avg(f"`{c}`").alias(f"mean{i}"), F.stddev_samp(f"`{c}`").alias(f"std{i}"),
        F.count(f"`{c}`").alias(f"n{i}"))])
    missing = lambda i: F.try_divide(100.0 * (F.col("_rows") - F.col(f"n{i}")), F.col("_rows"))
    return _stack(row, [
        (F.lit(c.split("__", 1)[0]), F.lit(c.split("__", 1)[1]), F.round(f"mean{i}", 3),
         F.round(f"std{i}", 3), F.round(missing(i), 1))
        for i, c in enumerate(cols)], ("modality", "feature", "mean", "std", "missing_pct"))


def _pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are present; null when either is constant.

    ``corr`` raises on a constant column under ANSI rules, this does not.
    """
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def label_correlations(df: DataFrame, label: str = "label", positive: str = "pos",
                       top: int = 10) -> DataFrame:
    """``(feature, r)`` with the largest ``abs(r)`` against ``label == positive``."""
    work = nan_to_null(df)
    cols = feature_columns(work)
    y = F.coalesce((F.col(label) == positive).cast("int"), F.lit(0))
    row = work.select(y.alias("_y"), *[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(cols)])
    row = row.agg(*[a for i in range(len(cols)) for a in (
        F.count(f"x{i}").alias(f"n{i}"),
        _pearson(F.col(f"x{i}"), F.col("_y")).alias(f"r{i}"))])
    out = _stack(row, [(F.lit(c), F.when(F.col(f"n{i}") > MIN_CORRELATED, F.round(f"r{i}", 4)))
                       for i, c in enumerate(cols)], ("feature", "r"))
    return (out.where(F.col("r").isNotNull() & ~F.isnan("r"))
               .orderBy(F.desc(F.abs("r")), "feature").limit(top))


_MOMENTS = ("n", "x", "y", "xx", "yy", "xy")                   # of pairs where both are present


def _co_moments(width: int, shift: list[float]):
    """One row per task: for every pair of columns the sums of ``_MOMENTS`` over its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_MOMENTS), width, width))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) - shift
            there = ~np.isnan(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            total += np.stack([there.T @ there, x.T @ there, there.T @ x, (x * x).T @ there, there.T @ (x * x), x.T @ x])
        cells = total.reshape(len(_MOMENTS), width * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width), pa.int32()), *[pa.array(c) for c in cells]], ["cell", *_MOMENTS])
    return run


def correlation_matrix(df: DataFrame, columns=None, digits: int = 4) -> DataFrame:
    """``(f1, f2, r)`` for every pair of numeric features, pairwise complete.

    Both orders and the diagonal are present; r is null where a side is constant. Every task adds its rows
    up to one table of co-moments by matrix products, so a row of the input never becomes one row per
    pair. Values are taken relative to their column's mean, so sums of squares lose no digits.
    """
    work = nan_to_null(df)
    cols = list(columns) if columns else feature_columns(work)
    if not cols:
        return df.sparkSession.createDataFrame([], "f1 string, f2 string, r double")
    narrow = work.select([F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    means = narrow.agg(*[F.avg(c).alias(c) for c in narrow.columns]).head()
    shift = [m if m is not None and math.isfinite(m) else 0.0 for m in means]
    parts = narrow.mapInArrow(_co_moments(len(cols), shift), "cell int, " + ", ".join(f"{m} double" for m in _MOMENTS))
    sums = parts.groupBy("cell").agg(*[F.sum(m).alias(m) for m in _MOMENTS])

    def spread(squares: str, side: str) -> Column:
        """Squares around the mean; null if they are nothing but rounding."""
        around = F.col(squares) - F.try_divide(F.col(side) * F.col(side), F.col("n"))
        return F.when(around > F.col(squares) * ROUNDING, around)
    product = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n"))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(product, F.sqrt(spread("xx", "x") * spread("yy", "y")))))
    names = F.array(*map(F.lit, cols))
    name = lambda k: F.get(names, F.floor(k).cast("int"))
    spreads = spread("xx", "x").isNotNull() & spread("yy", "y").isNotNull()
    return sums.select(name(F.col("cell") / len(cols)).alias("f1"), name(F.col("cell") % len(cols)).alias("f2"),
                       F.when(spreads, F.round(r, digits)).alias("r"))


def describe_aligned(df: DataFrame) -> DataFrame:
    """The whole report as ``(section, name, metric, value)``."""
    names = ("section", "name", "metric", "value")
    none = F.lit(None).cast("string")
    parts = [
        _stack(df.agg(F.count("*").alias("n")),
               [(F.lit("n_rows"), none, none, F.col("n").cast("double"))], names),
        _stack(coverage(df), [(F.lit("coverage"), F.col("modality"), F.lit("pct"),
                               F.col("coverage_pct"))], names),
        _stack(modality_stats(df), [
            (F.lit("feature"), F.concat_ws("__", "modality", "feature"), F.lit(m), F.col(m))
            for m in ("mean", "std", "missing_pct")], names)]
    if "label" in df.columns:
        parts.append(_stack(value_counts(df, "label"), [
            (F.lit("label"), F.col("value"), F.lit("count"), F.col("n").cast("double")),
            (F.lit("label"), F.col("value"), F.lit("pct"), F.col("pct"))], names))
        parts.append(_stack(label_correlations(df), [
            (F.lit("label_correlation"), F.col("feature"), F.lit("r"), F.col("r"))], names))
    return reduce(DataFrame.unionByName, parts)


def example_rows(df: DataFrame, key: str = "id", n: int = 1, label: str = "label",
                 labels=None) -> DataFrame:
    """The first ``n`` rows of each class in key order."""
    rows = df.where(F.col(label).isin(list(labels)) if labels else F.col(label).isNotNull())
    return first_per_group(rows, n, label, [F.asc(key)])


def array_stats(df: DataFrame, array: str, key: str, channels: int = 3,
                value_range: float = 255.0, half_range: float = 128.0) -> DataFrame:
    """Channel means, population deviation, brightness and contrast of a numeric array.

    Values are interleaved by channel, as the pixels of an image are.
    """
    a = F.transform(F.col(array), lambda x: x.cast("double"))

    def mean(v: Column) -> Column:
        return F.try_divide(F.aggregate(v, F.lit(0.0), lambda s, x: s + x), F.size(v))

    work = df.select(key, a.alias("a")).select("*", mean(F.col("a")).alias("m"))
    work = work.select("*", F.sqrt(mean(F.transform(
        "a", lambda x: (x - F.col("m")) * (x - F.col("m"))))).alias("s"))

    def channel(c: int) -> Column:
        return F.filter("a", lambda x, i: i % channels == c)

    per_channel = [F.round(mean(channel(c)), 3).alias(f"mean_{c}") for c in range(channels)]
    return work.select(
        key, *per_channel, F.round("s", 3).alias("std"),
        F.round(F.col("m") / value_range, 4).alias("brightness"),
        F.round(F.col("s") / half_range, 4).alias("contrast"))


def signal_stats(df: DataFrame, array: str, key: str, leading: int = 13) -> DataFrame:
    """The audio features of a numeric array: its leading values, and measures of the whole of it.

    ``zcr`` is the share of neighbours with another sign, ``spectral_centroid`` the mean position weighted by size,
    ``spectral_bandwidth`` the spread around it, ``rms_energy`` the root of the mean square. All null for a null array;
    measures of an empty one, and the weighted ones of nothing but zeros, are null.
    """
    work = df.select(key, F.transform(F.col(array), lambda x: x.cast("double")).alias("a"))

    def total(v: Column) -> Column:
        return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    size, weight = F.size("a"), total(F.transform("a", F.abs))
    work = work.select("*", F.try_divide(total(F.transform("a", lambda x, i: i * F.abs(x))), weight).alias("c"))
    spread = total(F.transform("a", lambda x, i: (i - F.col("c")) * (i - F.col("c")) * F.abs(x)))
    turns = total(F.transform("a", lambda x, i: F.when((i > 0) & ((x < 0) != (F.get("a", i - 1) < 0)), 1.0).otherwise(0.0)))
    return work.select(
        key, *[F.get("a", F.lit(i)).alias(f"mfcc_{i + 1}") for i in range(leading)],
        F.try_divide(turns, size - 1).alias("zcr"), F.col("c").alias("spectral_centroid"),
        F.sqrt(F.try_divide(spread, weight)).alias("spectral_bandwidth"),
        F.sqrt(F.try_divide(total(F.transform("a", lambda x: x * x)), size)).alias("rms_energy"))
