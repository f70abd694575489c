"""Detect and measure data-quality problems: missing, duplicates, outliers, imbalance."""

from __future__ import annotations

from decimal import Decimal, localcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.durable import written
from corpusmill.functions.keys import fingerprint, require_unique, small_side
from corpusmill.functions.quantiles import exact_quantiles, group_quantiles
from corpusmill.schema import is_missing, label_role, nan_to_null, numeric_columns, text_role

TEXT_LEN = "_text_len"
MIN_VALUES = 4              # fewer values than this give no outlier bounds
FENCE = 1.5
HOT_MEMBERS = 1_000_000     # rows of a group of duplicates that one task may get


def _content(df: DataFrame, columns, key) -> list[str]:
    return list(columns) if columns else [c for c in df.columns if c != key]


def _stack(row: DataFrame, entries, names) -> DataFrame:
    """One aggregate row -> one row per entry."""
    structs = [F.struct(*[v.alias(n) for n, v in zip(names, e)]) for e in entries]
    return row.select(F.inline(F.array(*structs)))


# -- missing ---------------------------------------------------------------------

def missing_profile(df: DataFrame, columns=None, key: str | None = None, digits: int = 2,
                    only_missing: bool = False) -> DataFrame:
    """``(column, count, pct)`` of missing cells, one scan for all columns."""
    cols = _content(df, columns, key)
    row = df.agg(F.count("*").alias("_rows"),
                 *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    out = _stack(row, [
        (F.lit(c), F.col(f"m{i}"),
         F.round(F.try_divide(100.0 * F.col(f"m{i}"), F.col("_rows")), digits))
        for i, c in enumerate(cols)], ("column", "count", "pct"))
    return out.where(F.col("count") > 0) if only_missing else out


def missing_cells(df: DataFrame, columns=None, key: str | None = None) -> DataFrame:
    """Total number of missing cells."""
    cols = _content(df, columns, key)
    per_row = sum((is_missing(df, c).cast("long") for c in cols), F.lit(0).cast("long"))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("missing_cells"))


def rows_with_missing(df: DataFrame, columns=None, key: str | None = None) -> DataFrame:
    """Rows in all, complete rows, and rows with any missing cell."""
    cols = _content(df, columns, key)
    any_missing = reduce(lambda a, b: a | b, [is_missing(df, c) for c in cols])
    return df.agg(F.count("*").alias("rows"), F.count_if(~any_missing).alias("complete"),
                  F.count_if(any_missing).alias("with_missing"))


def missing_matrix(df: DataFrame, key: str, columns=None) -> DataFrame:
    """0/1 missing flag per cell."""
    return df.select(key, *[is_missing(df, c).cast("int").alias(c)
                            for c in _content(df, columns, key)])


# -- duplicates ------------------------------------------------------------------

def duplicate_rows(df: DataFrame, on=None, key: str | None = None) -> DataFrame:
    """Rows beyond the first of each group equal on ``on`` (default: all content columns)."""
    fp = fingerprint(df, _content(df, on, key))
    groups = df.groupBy(fp.alias("_fp")).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def duplicated_members(df: DataFrame, on, key: str) -> DataFrame:
    """Every row of every group with more than one member, with the group size.

    Members are found by key and fingerprint alone; rows then meet their group's size by the unique key. Groups
    beyond ``HOT_MEMBERS`` rows are few and are looked up where the keys are, all others meet their
    keys in a shuffle, so no task gets more than one smaller group. A key that is null or repeats is an error.
    """
    on = [on] if isinstance(on, str) else list(on)
    keys = written(df.select(F.col(f"`{key}`").alias("_key"), fingerprint(df, on).alias("_fp")), "fingerprints")
    require_unique(keys, "_key")
    groups = keys.groupBy("_fp").agg(F.count("*").alias("group_size")).where("group_size > 1")
    groups = written(groups, "groups")
    hot = F.col("group_size") > HOT_MEMBERS
    large, some, members = groups.where(hot), keys, None
    if not large.isEmpty():
        large = small_side(large)
        some = keys.join(large, "_fp", "left_anti")
        members = keys.join(large, "_fp").select("_key", "group_size")
    met = some.join(groups.where(~hot), "_fp").select("_key", "group_size")
    members = met.union(members) if members is not None else met
    return df.join(members.withColumnRenamed("_key", key), key).select(*[f"`{c}`" for c in df.columns], "group_size")


# -- outliers --------------------------------------------------------------------

def with_text_length(df: DataFrame) -> DataFrame:
    text = text_role(df)
    return df.withColumn(TEXT_LEN, F.length(F.col(f"`{text}`"))) if text else df


def outlier_candidates(df: DataFrame, key: str | None = None) -> list[str]:
    """Text length first, then the numeric columns."""
    head = [TEXT_LEN] if TEXT_LEN in df.columns else []
    return head + numeric_columns(df, exclude={key, TEXT_LEN})


def fences(df: DataFrame, columns, exact: bool = False) -> dict[str, tuple]:
    """``{column: (lower, upper)}`` for columns that have bounds.

    No bounds: fewer than 4 values, or an interquartile range of 0. With ``exact`` the bounds of
    integer and decimal columns are decimals without rounding.
    """
    out = {}
    for c, q in exact_quantiles(df, columns, (0.25, 0.75), narrow={TEXT_LEN}, exact=exact).items():
        if q.n >= MIN_VALUES and q.values[0] != q.values[1]:
            with localcontext(prec=80):
                spread = q.values[1] - q.values[0]
                reach = Decimal(FENCE) * spread if isinstance(spread, Decimal) else FENCE * spread
                out[c] = (q.values[0] - reach, q.values[1] + reach)
    return out


def outside(c: str, bounds) -> Column:
    x = F.col(f"`{c}`")
    return (x < F.lit(bounds[0])) | (x > F.lit(bounds[1]))


OUTLIER_SCHEMA = "column string, count long, lower double, upper double"


def iqr_outliers(df: DataFrame, columns=None, key: str | None = None,
                 only_found: bool = True) -> DataFrame:
    """``(column, count, lower, upper)``; strictly outside counts, bounds to 2 digits."""
    work = nan_to_null(with_text_length(df))
    cols = list(columns) if columns else outlier_candidates(work, key)
    narrow = work.select([F.col(f"`{c}`") for c in cols])
    bounds = fences(narrow, cols)
    if not bounds:
        return df.sparkSession.createDataFrame([], OUTLIER_SCHEMA)
    row = narrow.agg(*[F.count_if(outside(c, b)).alias(f"o{i}") for i, (c, b) in enumerate(bounds.items())])
    out = _stack(row, [(F.lit(c), F.col(f"o{i}"), F.round(F.lit(b[0]), 2), F.round(F.lit(b[1]), 2))
                       for i, (c, b) in enumerate(bounds.items())], ("column", "count", "lower", "upper"))
    return out.where(F.col("count") > 0) if only_found else out


def zscore_outliers(df: DataFrame, columns=None, key: str | None = None,
                    limit: float = 3.0) -> DataFrame:
    """``(column, count, mean, std)`` of values more than ``limit`` sample deviations away."""
    work = nan_to_null(with_text_length(df))
    cols = list(columns) if columns else outlier_candidates(work, key)
    narrow = work.select([F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    stats = narrow.agg(*[a for i, c in enumerate(cols) for a in (
        F.avg(f"`{c}`").alias(f"mean{i}"), F.stddev_samp(f"`{c}`").alias(f"std{i}"))])
    row = narrow.crossJoin(F.broadcast(stats)).agg(           # stats is one row
        *[F.count_if(F.abs(F.try_divide(F.col(f"`{c}`") - F.col(f"mean{i}"), F.col(f"std{i}")))
                     > limit).alias(f"o{i}") for i, c in enumerate(cols)],
        *[F.first(f"{s}{i}").alias(f"{s}{i}") for i in range(len(cols)) for s in ("mean", "std")])
    return _stack(row, [(F.lit(c), F.col(f"o{i}"), F.col(f"mean{i}"), F.col(f"std{i}"))
                        for i, c in enumerate(cols)], ("column", "count", "mean", "std"))


# -- classes ---------------------------------------------------------------------

def class_counts(df: DataFrame, label: str) -> DataFrame:
    return (df.where(F.col(f"`{label}`").isNotNull())
              .groupBy(F.col(f"`{label}`").cast("string").alias("label"))
              .agg(F.count("*").alias("n")))


def imbalance(df: DataFrame, label: str | None = None) -> DataFrame:
    """``(ratio, majority, minority, n_classes)``; no row with fewer than two classes.

    Ties: the majority is the first label in order, the minority the last.
    """
    counts = class_counts(df, label or label_role(df))
    ends = counts.agg(F.max("n").alias("most"), F.min("n").alias("least"),
                      F.count("*").alias("n_classes"))
    row = counts.crossJoin(F.broadcast(ends)).agg(            # ends is one row
        F.first("most").alias("most"), F.first("least").alias("least"),
        F.first("n_classes").alias("n_classes"),
        F.min(F.when(F.col("n") == F.col("most"), F.col("label"))).alias("majority"),
        F.max(F.when(F.col("n") == F.col("least"), F.col("label"))).alias("minority"))
    return row.where(F.col("n_classes") >= 2).select(
        F.round(F.col("most") / F.col("least"), 3).alias("ratio"),
        "majority", "minority", "n_classes")


def value_counts(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """``(value, n, pct)`` of non-null values; percentages are of all rows."""
    counts = df.groupBy(F.col(f"`{column}`").cast("string").alias("value")).agg(
        F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_rows"))
    return (counts.where(F.col("value").isNotNull()).crossJoin(F.broadcast(total))
                  .select("value", "n",
                          F.round(100.0 * F.col("n") / F.col("_rows"), digits).alias("pct")))


# -- reports ---------------------------------------------------------------------

def detect_issues(df: DataFrame, key: str | None = None, columns=None) -> DataFrame:
    """All findings as ``(issue, column, metric, value, name)`` rows."""
    cols = _content(df, columns, key)
    none = F.lit(None).cast("string")
    work = df.select([F.col(f"`{c}`") for c in cols])

    def rows(found: DataFrame, issue: str, metrics) -> DataFrame:
        return _stack(found, [
            (F.lit(issue), column, F.lit(metric), value.cast("double"), name)
            for column, metric, value, name in metrics],
            ("issue", "column", "metric", "value", "name"))

    parts = [
        rows(missing_profile(work, cols, only_missing=True), "missing",
             [(F.col("column"), m, F.col(m), none) for m in ("count", "pct")]),
        rows(duplicate_rows(work), "duplicates",
             [(none, "count", F.col("duplicates"), none)])]
    if outlier_candidates(with_text_length(work)):
        parts.append(rows(iqr_outliers(work), "outliers",
                          [(F.col("column"), m, F.col(m), none)
                           for m in ("count", "lower", "upper")]))
    label = label_role(work)
    if label:
        tag = F.lit(label)
        ratio = imbalance(work, label)
        parts.append(rows(ratio, "imbalance", [
            (tag, "ratio", F.col("ratio"), none),
            (tag, "majority", F.lit(None), F.col("majority")),
            (tag, "minority", F.lit(None), F.col("minority"))]))
        several = ratio.select("n_classes")                   # one row, or none below two classes
        parts.append(rows(class_counts(work, label).crossJoin(F.broadcast(several)), "imbalance",
                          [(tag, "count", F.col("n"), F.col("label"))]))
    return reduce(DataFrame.unionByName, parts)


def quality_stats(df: DataFrame, key: str | None = None, columns=None) -> DataFrame:
    """One row: rows, missing cells, duplicates, length outliers and imbalance.

    One scan: equal rows combine by fingerprint, distinct rows combine to one per label and
    length. Those are written; quartiles and sums read them.
    """
    cols = _content(df, columns, key)
    text, label = text_role(df.select([f"`{c}`" for c in cols])), label_role(df.select([f"`{c}`" for c in cols]))
    rows = df.select(
        fingerprint(df, cols).alias("fp"),
        sum((is_missing(df, c).cast("long") for c in cols), F.lit(0).cast("long")).alias("missing"),
        (F.length(F.col(f"`{text}`")) if text else F.lit(None).cast("int")).alias("len"),
        (F.col(f"`{label}`").cast("string") if label else F.lit(None).cast("string")).alias("label"))
    distinct = rows.groupBy("fp").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("missing", "len", "label")])
    cells = written(distinct.groupBy("label", "len").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("missing")).alias("missing"),
        F.sum(F.col("n") - 1).alias("repeats")), "quality-cells")
    zero = F.lit(0).cast("long")
    total = lambda c: F.coalesce(F.sum(c), zero)
    row = cells.agg(total("n").alias("rows"), total("missing").alias("missing_count"), total("repeats").alias("duplicates"))
    out = ["rows", "missing_count", "duplicates"]
    if text:
        q = group_quantiles(cells, [], "len", (0.25, 0.5, 0.75), weight="n").select("q")          # one row, or none
        spread = F.col("q")[2] - F.col("q")[0]
        beyond = (F.col("len") < F.col("q")[0] - FENCE * spread) | (F.col("len") > F.col("q")[2] + FENCE * spread)
        found = cells.where("len IS NOT NULL").crossJoin(F.broadcast(q)).agg(
            total(F.when(beyond & (spread > 0), F.col("n"))).alias("outlier_rows"),
            F.floor(F.max(F.col("q")[1])).cast("long").alias("median_text_len"),
            F.round(F.try_divide(F.sum(F.col("len") * F.col("n")), F.sum("n")), 1).alias("mean_text_len"))
        row = row.crossJoin(F.broadcast(found))
        out += ["outlier_rows", "median_text_len", "mean_text_len"]
    if label:
        classes = cells.where("label IS NOT NULL").groupBy("label").agg(F.sum("n").alias("n")).agg(
            F.round(F.max("n") / F.min("n"), 3).alias("ratio"), F.count("*").alias("k"))
        row = row.crossJoin(F.broadcast(classes))
        several = F.col("k") >= 2
        out += [F.when(several, F.col("ratio")).alias("imbalance_ratio"), F.when(several, F.col("k")).alias("n_classes")]
    return row.select(*out)


METRICS = ("rows", "missing_count", "duplicates", "outlier_rows", "imbalance_ratio", "n_classes",
           "median_text_len", "mean_text_len")


def _side_by_side(frames: dict, key, columns) -> tuple[DataFrame, list[str]]:
    """One row with ``<name>:<metric>`` for every frame."""
    rows = [quality_stats(df, key, columns).withColumn("_side", F.lit(name))
            for name, df in frames.items()]
    have = [m for m in METRICS if all(m in r.columns for r in rows)]
    stacked = reduce(DataFrame.unionByName, [r.select("_side", *have) for r in rows])
    return stacked.agg(*[
        F.max(F.when(F.col("_side") == name, F.col(m))).cast("double").alias(f"{name}:{m}")
        for name in frames for m in have]), have


def verdict(before: Column, after: Column) -> Column:
    return (F.when(after < before, "improved").when(after == before, "—")
             .when(after > before, "increased"))


def compare(before: DataFrame, after: DataFrame, key: str | None = None, columns=None) -> DataFrame:
    """``(metric, before, after, change)`` plus rows removed and their percentage."""
    row, have = _side_by_side({"before": before, "after": after}, key, columns)
    b, a = (lambda m: F.col(f"`before:{m}`")), (lambda m: F.col(f"`after:{m}`"))
    gone = b("rows") - a("rows")
    none, blank = F.lit(None).cast("double"), F.lit(None).cast("string")
    return _stack(row, [
        *[(F.lit(m), b(m), a(m), verdict(b(m), a(m))) for m in have],
        (F.lit("rows_removed"), none, gone, blank),
        (F.lit("rows_removed_pct"), none, F.round(F.try_divide(100.0 * gone, b("rows")), 1), blank)],
        ("metric", "before", "after", "change"))


def compare_strategies(before: DataFrame, cleaned: dict[str, DataFrame], key: str | None = None,
                       columns=None) -> DataFrame:
    """``(metric, before, <one column per strategy>)``."""
    names = ["before", *cleaned]
    row, have = _side_by_side({"before": before, **cleaned}, key, columns)
    return _stack(row, [(F.lit(m), *[F.col(f"`{n}:{m}`") for n in names]) for m in have],
                  ("metric", *names))


def profile(df: DataFrame, key: str | None = None, columns=None) -> DataFrame:
    """``(metric, name, value)``: shape, nulls, duplicates, length statistics, label counts."""
    cols = _content(df, columns, key)
    work = df.select([F.col(f"`{c}`") for c in cols])
    none = F.lit(None).cast("string")
    parts = [
        _stack(work.agg(F.count("*").alias("n")), [
            (F.lit("rows"), none, F.col("n").cast("double")),
            (F.lit("columns"), none, F.lit(float(len(cols))))], ("metric", "name", "value")),
        missing_profile(work, cols).select(
            F.lit("nulls").alias("metric"), F.col("column").alias("name"),
            F.col("count").cast("double").alias("value")),
        duplicate_rows(work).select(F.lit("duplicates").alias("metric"), none.alias("name"),
                                    F.col("duplicates").cast("double").alias("value"))]
    text, label = text_role(work), label_role(work)
    if text:
        n = F.length(F.col(f"`{text}`"))
        p95 = group_quantiles(work.select(n.alias("n")), [], "n", [0.95]).agg(F.max(F.col("q")[0]).alias("p95"))
        row = work.agg(F.min(n).alias("min"), F.avg(n).alias("mean"), F.max(n).alias("max")).crossJoin(F.broadcast(p95))
        parts.append(_stack(row, [
            (F.lit("text_len"), F.lit(m),
             (F.round(m, 0) if m in ("mean", "p95") else F.col(m)).cast("double"))
            for m in ("min", "mean", "max", "p95")], ("metric", "name", "value")))
    if label:
        parts.append(class_counts(work, label).select(
            F.lit("label").alias("metric"), F.col("label").alias("name"),
            F.col("n").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def describe(df: DataFrame, columns, digits: int = 1, narrow=()) -> DataFrame:
    """``(column, count, mean, std, min, q25, median, q75, max)`` with exact quartiles."""
    work = nan_to_null(df.select([F.col(f"`{c}`") for c in columns]))
    q = exact_quantiles(work, columns, (0.25, 0.5, 0.75), narrow=set(narrow))
    row = work.agg(*[a for i, c in enumerate(columns) for a in (
        F.count(f"`{c}`").alias(f"n{i}"), F.avg(f"`{c}`").alias(f"mean{i}"),
        F.stddev_samp(f"`{c}`").alias(f"std{i}"), F.min(f"`{c}`").alias(f"min{i}"),
        F.max(f"`{c}`").alias(f"max{i}"))])
    r = lambda c: F.round(c.cast("double"), digits)
    return _stack(row, [
        (F.lit(c), F.col(f"n{i}"), r(F.col(f"mean{i}")), r(F.col(f"std{i}")), r(F.col(f"min{i}")),
         *[r(F.lit(v)) for v in q[c].values], r(F.col(f"max{i}")))
        for i, c in enumerate(columns)],
        ("column", "count", "mean", "std", "min", "q25", "median", "q75", "max"))
