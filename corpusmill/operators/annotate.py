"""Keyword-lexicon labelling, agreement metrics, annotation examples, task documents."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.keys import first_per_group
from corpusmill.functions.quantiles import exact_quantiles
from corpusmill.functions.stems import count_stems, stems_in
from corpusmill.functions.text import let, shorten
from corpusmill.operators.quality import _stack, value_counts
from corpusmill.schema import nan_to_null

# Default Russian sentiment stems.
POSITIVE_STEMS = (
    "хорош", "отличн", "прекрасн", "великолепн", "замечательн", "радост", "счасть", "счастлив",
    "победи", "победа", "успех", "позитивн", "добр", "любов", "красив", "лучш", "превосходн",
    "восхитительн", "улучшени", "достижени", "выигр", "доверя", "одобрени", "поддержк",
    "благодарн", "здоров", "надежд", "праздни", "прогресс", "развити", "спасен", "открыти",
    "достиг", "выиграл", "наград", "медал", "чемпион")
NEGATIVE_STEMS = (
    "плох", "ужасн", "негативн", "проблем", "кризис", "смерт", "убийств", "катастроф", "авари",
    "трагеди", "конфликт", "войн", "террор", "провал", "скандал", "коррупц", "незакон", "арест",
    "задержан", "обвинен", "потер", "разрушен", "ухудшен", "упадк", "недовольств", "злост",
    "ненавист", "страх", "горя", "боль", "несчастн", "жертв", "угроз", "опасност", "вред", "ущерб",
    "погиб", "ранен", "взрыв", "пожар", "наводнен", "землетрясени", "осужд", "приговор", "штраф",
    "санкц", "запрет")
DEFAULT_LEXICON = {"pos": POSITIVE_STEMS, "neg": NEGATIVE_STEMS}

# The confidence rule and the review threshold.
CONFIDENCE_FLOOR = 0.5
CONFIDENCE_SPAN = 0.49
NO_SIGNAL_CONFIDENCE = 0.51
NO_SIGNAL_LENGTH = 300
THRESHOLD = 0.55

BROADCAST_STEMS, BROADCAST_CHARS = 20_000, 1_000_000       # of a lexicon that every task gets

MODEL_VERSION = "lexicon-v1"
# Fixed values of the labelling-task format.
FROM_NAME, TO_NAME, RESULT_TYPE = "sentiment", "text", "choices"


def _lowered(text: str) -> Column:
    return F.lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def _with_decision(df: DataFrame, hits: Column, text: str, labelled_at: str | None) -> DataFrame:
    """Add label and confidence from ``hits``, a struct of counts ``pos`` and ``neg``."""
    def decide(h: Column) -> Column:
        total, best = h["pos"] + h["neg"], F.greatest(h["pos"], h["neg"])
        long_text = F.length(_lowered(text)) > NO_SIGNAL_LENGTH
        label = (F.when(total == 0, F.when(long_text, "neg").otherwise("pos"))
                  .when(h["pos"] >= h["neg"], "pos").otherwise("neg"))
        confidence = F.when(total == 0, F.lit(NO_SIGNAL_CONFIDENCE)).otherwise(
            F.round(CONFIDENCE_FLOOR + F.try_divide(best, total) * CONFIDENCE_SPAN, 4))
        return F.struct(label.alias("label"), confidence.alias("confidence"))

    at = F.lit(labelled_at or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f"))
    return (df.select("*", let(hits, decide).alias("_decision"))
              .select(*[f"`{c}`" for c in df.columns], F.col("_decision.label").alias("auto_label"),
                      F.col("_decision.confidence").alias("confidence"), at.alias("auto_label_at")))


def auto_label(df: DataFrame, lexicon: dict | None = None, text: str = "text",
               labelled_at: str | None = None, modality: str = "text") -> DataFrame:
    """Add ``auto_label``, ``confidence`` and ``auto_label_at``.

    A hit is a distinct stem contained in the lower-cased text. Stateless and
    shuffle-free, so it also runs unchanged on a streaming frame.
    """
    if modality != "text":
        raise NotImplementedError(f"modality {modality!r} is not supported; use 'text'")
    lexicon = lexicon or DEFAULT_LEXICON

    def count(body: Column, stems) -> Column:
        return sum((F.when(body.contains(s), 1).otherwise(0) for s in dict.fromkeys(stems)), F.lit(0))

    hits = let(_lowered(text), lambda body: F.struct(
        count(body, lexicon["pos"]).alias("pos"), count(body, lexicon["neg"]).alias("neg")))
    return _with_decision(df, hits, text, labelled_at)


def _small_lexicon(lexicon: DataFrame) -> dict[str, set] | None:
    """{stem: polarities} of a lexicon within the broadcast bounds; None for a larger one."""
    size = lexicon.agg(F.count("*").alias("n"), F.sum(F.length("stem")).alias("chars")).head()
    if size["n"] > BROADCAST_STEMS or (size["chars"] or 0) > BROADCAST_CHARS:
        return None
    found: dict[str, set] = {}
    for stem, polarity in lexicon.collect():
        found.setdefault(stem, set()).add(polarity)
    return dict(sorted(found.items()))


def _stems(lexicon: DataFrame) -> DataFrame:
    return lexicon.select(F.lower("stem").alias("stem"), "polarity").where(F.length("stem") > 0).distinct()


def lexicon_matches(df: DataFrame, lexicon: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, stem, polarity)`` for every table stem contained in a row's text.

    All stems of a lexicon of up to ``BROADCAST_STEMS`` stems and ``BROADCAST_CHARS`` characters are looked for in
    one pass over each text, where the text is. A larger lexicon is joined on the whole stem: a text
    offers its runs of each length that a stem has, so no key is shared by different stems.
    """
    stems = _stems(lexicon)
    small = _small_lexicon(stems)
    if small is None:
        return _joined_matches(df, stems, key, text)
    names = df.sparkSession.createDataFrame(                  # at most BROADCAST_STEMS
        [(i, s, p) for i, (s, ps) in enumerate(small.items()) for p in sorted(ps, key=str)], "_i int, stem string, polarity string")
    if not small:
        return df.select(key).join(names, F.lit(False)).select(key, "stem", "polarity")
    hits = df.select(key, F.explode(stems_in(_lowered(text), list(small))).alias("_i"))
    return hits.join(F.broadcast(names), "_i").select(key, "stem", "polarity").distinct()


def _joined_matches(df: DataFrame, stems: DataFrame, key: str, text: str) -> DataFrame:
    lengths = [r[0] for r in stems.select(F.length("stem")).distinct().collect()]       # a few
    runs = F.array_distinct(F.flatten(F.array(*[
        F.regexp_extract_all(_lowered(text), F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in sorted(lengths)])))
    return (df.select(key, F.explode(runs).alias("stem")).join(stems, "stem")
              .select(key, "stem", "polarity").distinct())


def auto_label_from_table(df: DataFrame, lexicon: DataFrame, key: str, text: str = "text",
                          labelled_at: str | None = None) -> DataFrame:
    """``auto_label`` with a lexicon held in a table ``(stem, polarity)`` of any size.

    Within the broadcast bounds rows are labelled where they are; ``key`` is needed beyond them only.
    """
    stems = _stems(lexicon)
    small = _small_lexicon(stems)
    if small is not None:
        none = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("neg"))
        found = count_stems(_lowered(text), small, ("pos", "neg")) if small else none
        out = _with_decision(df.select("*", found.alias("_hits")), F.col("_hits"), text, labelled_at)
    else:
        hits = _joined_matches(df, stems, key, text).groupBy(key).agg(
            F.count_if(F.col("polarity") == "pos").alias("_pos"),
            F.count_if(F.col("polarity") == "neg").alias("_neg"))
        found = F.struct(*[F.coalesce(f"_{side}", F.lit(0)).alias(side) for side in ("pos", "neg")])
        out = _with_decision(df.join(hits, key, "left"), found, text, labelled_at)
    return out.select(*[f"`{c}`" for c in df.columns], "auto_label", "confidence", "auto_label_at")


# -- splitting and metrics ---------------------------------------------------------

def flagged(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return df.where(F.col("confidence") < threshold)


def unflagged(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All other rows: confident ones, and those whose confidence is null or NaN."""
    return df.where(~F.coalesce(F.col("confidence") < threshold, F.lit(False)))


def confident(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return df.where(F.col("confidence") >= threshold)


def label_column(df: DataFrame, label: str = "label") -> str:
    return "auto_label" if "auto_label" in df.columns else label


def confidence_stats(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row: mean, median and number below the threshold."""
    c = F.col("confidence")
    median = exact_quantiles(nan_to_null(df.select("confidence")), ["confidence"], [0.5])["confidence"]
    return df.agg(
        F.round(F.avg(c), 4).alias("confidence_mean"),
        F.round(F.lit(median.values[0]).cast("double"), 4).alias("confidence_median"),
        F.count_if(c < threshold).alias("low_confidence_n"))


def contingency(df: DataFrame, reference: str, predicted: str) -> DataFrame:
    """``(ref, pred, n)`` over rows where both are present."""
    return (df.where(F.col(reference).isNotNull() & F.col(predicted).isNotNull())
              .groupBy(F.col(reference).cast("string").alias("ref"),
                       F.col(predicted).cast("string").alias("pred"))
              .agg(F.count("*").alias("n")))


def per_label(table: DataFrame) -> DataFrame:
    """Marginals of a contingency table: ``(label, support, predicted, hits)``."""
    zero = F.lit(0).cast("long")
    same = F.col("ref") == F.col("pred")
    sides = F.array(
        F.struct(F.col("ref").alias("label"), F.col("n").alias("support"),
                 zero.alias("predicted"), F.when(same, F.col("n")).otherwise(zero).alias("hits")),
        F.struct(F.col("pred").alias("label"), zero.alias("support"),
                 F.col("n").alias("predicted"), zero.alias("hits")))
    return table.select(F.inline(sides)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])


def agreement(df: DataFrame, reference: str, predicted: str = "auto_label") -> DataFrame:
    """One row: ``n``, Cohen's ``kappa`` and ``agreement_pct``; kappa null if undefined."""
    sums = per_label(contingency(df, reference, predicted)).agg(
        F.coalesce(F.sum("support"), F.lit(0)).alias("n"), F.sum("hits").alias("hits"),
        F.sum(F.col("support").cast("double") * F.col("predicted")).alias("chance"))
    observed = F.try_divide("hits", "n")
    expected = F.try_divide("chance", F.col("n").cast("double") * F.col("n"))
    return sums.select(
        "n", F.round(F.try_divide(observed - expected, 1 - expected), 4).alias("kappa"),
        F.round(100.0 * observed, 1).alias("agreement_pct"))


def check_quality(df: DataFrame, reference: str | None = None, threshold: float = THRESHOLD,
                  label: str = "label") -> DataFrame:
    """All annotation metrics as ``(metric, name, value)``."""
    none = F.lit(None)
    tag = label_column(df, label)
    names = ("metric", "name", "value")
    parts = [_stack(value_counts(df, tag), [
        (F.lit("label_dist"), F.col("value"), F.col("n").cast("double")),
        (F.lit("label_dist_pct"), F.col("value"), F.col("pct"))], names)]
    if "confidence" in df.columns:
        parts.append(_stack(confidence_stats(df, threshold), [
            (F.lit(m), none.cast("string"), F.col(m).cast("double"))
            for m in ("confidence_mean", "confidence_median", "low_confidence_n")], names))
    if reference and reference in df.columns:
        parts.append(_stack(agreement(df, reference, tag), [
            (F.lit(m), none.cast("string"), F.col(m)) for m in ("kappa", "agreement_pct")], names))
    return reduce(DataFrame.unionByName, parts)


def confusion(df: DataFrame, reference: str, predicted: str, labels) -> DataFrame:
    """One row per reference label, one ``pred_<label>`` column each, in the given order.

    Pairs outside ``labels`` drop out; absent pairs count 0.
    """
    labels = list(labels)
    cells = contingency(df, reference, predicted)
    row = cells.agg(*[
        F.coalesce(F.sum(F.when((F.col("ref") == a) & (F.col("pred") == b), F.col("n"))), F.lit(0))
         .alias(f"c{i}_{j}") for i, a in enumerate(labels) for j, b in enumerate(labels)])
    return _stack(row, [
        (F.lit(a), *[F.col(f"c{i}_{j}") for j in range(len(labels))])
        for i, a in enumerate(labels)], ("reference", *[f"pred_{b}" for b in labels]))


def match_counts(df: DataFrame, reference: str = "label", predicted: str = "auto_label") -> DataFrame:
    """One row: matches, mismatches (a missing side is a mismatch) and match percentage."""
    same = F.coalesce(F.col(reference) == F.col(predicted), F.lit(False))
    return df.agg(F.count_if(same).alias("matches"), F.count_if(~same).alias("mismatches"),
                  F.round(F.try_divide(100.0 * F.count_if(same), F.count("*")), 1).alias("match_pct"))


def accuracy_by_confidence(df: DataFrame, reference: str = "label", predicted: str = "auto_label",
                           threshold: float = THRESHOLD) -> DataFrame:
    """``(confidence_group, n, accuracy_pct)`` for confident and flagged rows; 0 when empty."""
    same = F.coalesce(F.col(reference) == F.col(predicted), F.lit(False))
    c = F.col("confidence")
    aggs = [a for name, rows in (("confident", c >= threshold), ("flagged", c < threshold))
            for a in (F.count_if(rows).alias(f"{name}_n"),
                      F.count_if(rows & same).alias(f"{name}_hits"))]
    return _stack(df.agg(*aggs), [
        (F.lit(g), F.col(f"{g}_n"),
         F.round(F.coalesce(F.try_divide(100.0 * F.col(f"{g}_hits"), F.col(f"{g}_n")), F.lit(0.0)), 1))
        for g in ("confident", "flagged")], ("confidence_group", "n", "accuracy_pct"))


def counts_side_by_side(df: DataFrame, columns, labels) -> DataFrame:
    """``(label, <count per column>)`` for a fixed list of labels, 0 when absent."""
    labels = list(labels)
    row = df.agg(*[F.count_if(F.col(c) == v).alias(f"n{i}_{j}")
                   for i, v in enumerate(labels) for j, c in enumerate(columns)])
    return _stack(row, [(F.lit(v), *[F.col(f"n{i}_{j}") for j in range(len(columns))])
                        for i, v in enumerate(labels)], ("label", *columns))


# -- specification data ------------------------------------------------------------

def class_examples(df: DataFrame, key: str, n: int = 3, text: str = "text",
                   label: str = "label") -> DataFrame:
    """The ``n`` most confident texts per class as ``(label, rank, row, text)``."""
    tag = label_column(df, label)
    order = ([F.desc("confidence")] if "confidence" in df.columns else []) + [F.asc(key)]
    rows = df.where(F.col(tag).isNotNull() & F.col(text).isNotNull())
    best = first_per_group(rows, n, tag, order)
    return best.select(F.col(tag).cast("string").alias("label"), "rank",
                       F.col(key).alias("row"), shorten(F.col(text)).alias("text"))


def edge_cases(df: DataFrame, key: str, n: int = 5, text: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The first ``n`` low-confidence texts in key order."""
    return (flagged(df, threshold).where(F.col(text).isNotNull()).orderBy(key).limit(n)
            .select(F.col(key).alias("row"), shorten(F.col(text)).alias("text")))


def specification(df: DataFrame, key: str, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Data of an annotation specification: ``(section, label, rank, text)``."""
    size = df.agg(F.lit("rows").alias("section"), F.lit(None).cast("string").alias("label"),
                  F.lit(0).alias("rank"), F.count("*").cast("string").alias("text"))
    shown = class_examples(df, key, text=text).select(
        F.lit("example").alias("section"), "label", "rank", "text")
    out = size.unionByName(shown)
    if "confidence" not in df.columns:
        return out
    edges = edge_cases(df, key, text=text, threshold=threshold)          # at most 5 rows
    ranked = edges.agg(F.array_sort(F.collect_list(F.struct("row", "text"))).alias("e")).select(
        F.posexplode("e").alias("i", "e"))
    return out.unionByName(ranked.select(
        F.lit("edge_case").alias("section"), F.lit(None).cast("string").alias("label"),
        (F.col("i") + 1).alias("rank"), F.col("e.text").alias("text")))


# -- task documents ------------------------------------------------------------------

def _uuid_of(salt: str, key: str) -> Column:
    """UUID-shaped id derived from the row key, so a retried task writes the same one."""
    h = F.md5(F.concat(F.lit(salt + ":"), F.col(key).cast("string")))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut])


def tasks(df: DataFrame, key: str, text: str = "text", threshold: float = THRESHOLD,
          flagged_only: bool = False, model_version: str = MODEL_VERSION) -> DataFrame:
    """One labelling task per row: ``id``, ``data``, ``meta``, ``predictions``.

    Absent source, confidence or label simply leave their fields null, which JSON
    writing omits.
    """
    rows = flagged(df, threshold) if flagged_only and "confidence" in df.columns else df
    data = [F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")]
    data += [F.col(c).cast("string").alias(c) for c in ("source", "collected_at") if c in df.columns]
    has_confidence = "confidence" in df.columns
    score = F.round(F.col("confidence").cast("double"), 4) if has_confidence else F.lit(1.0)
    none = F.lit(None)
    meta = F.struct(
        (score if has_confidence else none.cast("double")).alias("confidence"),
        (F.col("confidence") < threshold if has_confidence else none.cast("boolean")).alias("flagged"))
    cols = [_uuid_of("task", key).alias("id"), F.struct(*data).alias("data"), meta.alias("meta")]
    if "auto_label" in df.columns:
        result = F.struct(
            _uuid_of("result", key).alias("id"), F.lit(RESULT_TYPE).alias("type"),
            F.struct(F.array(F.col("auto_label").cast("string")).alias("choices")).alias("value"),
            F.lit(FROM_NAME).alias("from_name"), F.lit(TO_NAME).alias("to_name"))
        prediction = F.struct(F.lit(model_version).alias("model_version"), score.alias("score"),
                              F.array(result).alias("result"))
        cols.append(F.when(F.col("auto_label").isNotNull(), F.array(prediction)).alias("predictions"))
    return rows.select(cols)
