"""Exploratory aggregates: text features, histograms, box statistics, top words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.durable import written
from corpusmill.functions.keys import first_per_group, seeded_sample, small_side
from corpusmill.functions.quantiles import group_quantiles
from corpusmill.functions.text import (
    CYRILLIC_WORD, average_length, letter_words, punctuation_ratio, word_count)
from corpusmill.operators.quality import FENCE, _stack, missing_matrix

# Russian stop words left out of word counts.
STOP_WORDS = frozenset((
    "и", "в", "не", "на", "что", "с", "а", "но", "как", "это", "по", "из", "у", "да", "же", "был",
    "его", "её", "их", "за", "от", "так", "то", "все", "он", "она", "они", "мне", "нет", "ещё",
    "уже", "я", "ты", "мы", "вы", "для", "при", "до", "или", "если", "этот", "эта", "об", "бы",
    "ли", "ни", "к", "о", "со", "во", "чтобы", "когда", "есть", "быть", "была", "были", "будет",
    "тоже", "только", "можно"))


def text_features(df: DataFrame, key: str, text: str = "text", keep=()) -> DataFrame:
    """``text_len``, ``word_count``, ``avg_word_len`` and ``punct_ratio`` per row."""
    t = F.col(text)
    counted = df.select(key, *keep, F.length(t).alias("text_len"), word_count(t).alias("word_count"),
                        F.round(punctuation_ratio(t), 6).alias("punct_ratio"))
    return counted.select(key, *keep, "text_len", "word_count", average_length("text_len", "word_count").alias("avg_word_len"),
                          "punct_ratio")


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None) -> DataFrame:
    """``(by?, bin, lower, upper, count)`` over equal widths; empty bins count 0.

    The range is the group's own. The last bin is closed on the right; a constant
    column gets a range of one around its value.
    """
    x = F.col(value).cast("double")
    group = [F.col(by).cast("string").alias("grp")] if by else [F.lit("all").alias("grp")]
    data = df.select(*group, x.alias("x")).where(
        F.col("x").isNotNull() & ~F.isnan("x") & F.col("grp").isNotNull())
    span = data.groupBy("grp").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = small_side(span.select(
        "grp", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi")))
    step = (F.col("hi") - F.col("lo")) / bins
    slot = F.least(F.floor((F.col("x") - F.col("lo")) / step), F.lit(bins - 1)).cast("int")
    counts = (data.join(span, "grp").groupBy("grp", slot.alias("bin"))
                  .agg(F.count("*").alias("n")))
    frame = span.select("grp", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
                        "lo", step.alias("step"))
    out = frame.join(counts, ["grp", "bin"], "left").select(
        F.col("grp").alias(by or "grp"), "bin",
        F.round(F.col("lo") + F.col("bin") * F.col("step"), 4).alias("lower"),
        F.round(F.col("lo") + (F.col("bin") + 1) * F.col("step"), 4).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("count"))
    return out if by else out.drop("grp")


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, whiskers and outlier counts per group; ``position`` orders by median.

    ``value`` is a length or a count: rows first combine to one per group and value,
    and everything after works on those.
    """
    cells = written(df.where(F.col(value).isNotNull() & F.col(by).isNotNull())
                      .groupBy(F.col(by).cast("string").alias("grp"), F.col(value).alias("v"))
                      .agg(F.count("*").alias("n")), "box-cells")
    q = small_side(group_quantiles(cells, ["grp"], "v", (0.25, 0.5, 0.75), weight="n").withColumnRenamed("n", "n_rows"))
    spread = F.col("q")[2] - F.col("q")[0]
    low, high = F.col("q")[0] - FENCE * spread, F.col("q")[2] + FENCE * spread
    inside = F.col("v").between(low, high)
    out = cells.join(q, "grp").groupBy("grp").agg(
        F.first("n_rows").alias("count"), F.first("q").alias("q"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"))
    return out.select(
        F.col("grp").alias(by), F.row_number().over(Window.orderBy(F.col("q")[1], "grp")).alias("position"),
        "count", F.round(F.col("q")[0], 2).alias("q1"), F.round(F.col("q")[1], 2).alias("median"),
        F.round(F.col("q")[2], 2).alias("q3"), "whisker_low", "whisker_high", "outliers")


def top_words(df: DataFrame, by: str, n: int = 20, text: str = "text",
              pattern: str = CYRILLIC_WORD, stop_words=STOP_WORDS) -> DataFrame:
    """``(by, rank, word, freq)``: most frequent words per class, ties in word order."""
    words = (df.where(F.col(by).isNotNull())
               .select(by, F.explode_outer(letter_words(F.col(text), pattern)).alias("word"))
               .where(F.col("word").isNotNull()))
    if stop_words:
        words = words.where(~F.col("word").isin(sorted(stop_words)))
    freq = words.groupBy(by, "word").agg(F.count("*").alias("freq"))
    return first_per_group(freq, n, by, [F.desc("freq"), F.asc("word")]).select(
        by, "rank", "word", "freq")


def split_histograms(df: DataFrame, value: str, bins: int, is_outlier) -> DataFrame:
    """Histograms of normal and outlying rows apart, each over its own range."""
    tagged = df.withColumn("part", F.when(is_outlier, "outlier").otherwise("normal"))
    return histogram(tagged, value, bins, by="part")


def eda_summary(df: DataFrame, text: str = "text", label: str = "label",
                source: str = "source") -> DataFrame:
    """``(metric, name, value)``: rows, label and source counts, lengths, missing."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    none = F.lit(None).cast("string")
    names = ("metric", "name", "value")
    middle = group_quantiles(df.select(n.alias("n")), [], "n", [0.5]).agg(
        F.round(F.max(F.col("q")[0]), 1).alias("text_len_median"))
    row = df.agg(F.count("*").alias("total_rows"), F.round(F.avg(n), 1).alias("text_len_mean"),
                 F.count_if(F.col(text).isNull()).alias("missing_text"),
                 F.count_if(F.col(label).isNull()).alias("missing_label")).crossJoin(F.broadcast(middle))
    parts = [_stack(row, [(F.lit(m), none, F.col(m).cast("double")) for m in row.columns], names)]
    counts = df.groupingSets([[label], [source]], label, source).agg(
        F.count("*").alias("n"), F.grouping(label).alias("_g"))
    parts.append(counts.select(
        F.when(F.col("_g") == 0, "label_dist").otherwise("sources").alias("metric"),
        F.when(F.col("_g") == 0, F.col(label)).otherwise(F.col(source)).alias("name"),
        F.col("n").cast("double").alias("value")).where(F.col("name").isNotNull()))
    return reduce(DataFrame.unionByName, parts)


def missing_sample(df: DataFrame, key: str, n: int = 300, seed=42, columns=None) -> DataFrame:
    """Missing flags of a seeded sample, as a heat map shows them."""
    return missing_matrix(seeded_sample(df, n, key, seed), key, columns)
