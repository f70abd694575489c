"""Stratified split, classifier training, scoring metrics and active learning."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.durable import written
from corpusmill.functions.keys import (
    before_cut, hash_cut, seeded_sample, small_side)
from corpusmill.functions.logistic import Classifier
from corpusmill.functions.quantiles import exact_quantiles
from corpusmill.functions.ranks import ranked
from corpusmill.operators.annotate import contingency, per_label
from corpusmill.operators.tfidf import TfidfModel
from corpusmill.schema import is_missing, nan_to_null

# Sizes and shares of the learning steps.
AL_FEATURES, TRAIN_FEATURES = 5_000, 10_000
AL_HOLDOUT, TRAIN_HOLDOUT = 0.25, 0.2
POOL_QUANTILE = 0.3
MIN_FOR_HOLDOUT = 40
MAX_CLASSES = 1_000


# -- splitting ---------------------------------------------------------------------

def stratified_split(df: DataFrame, label: str, key: str, test_share: float, seed=42, least: int = 0) -> DataFrame:
    """Add ``is_test``: exactly ``round(share * n)`` (or ``least``) rows of every label, reproducibly.

    The cut is one hash value per label, found from counts; rows are then compared with
    it where they are. No label's rows are ever sorted together. Rows that repeat a key
    go to one side, except where the cut falls into them: there a digest of the row decides.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("_l")).agg(
        F.greatest(F.floor(F.count("*") * F.lit(test_share) + 0.5), F.least(F.lit(least), F.count("*"))).alias("_k"))
    size = small_side(counts)
    rows = df.select(F.col(label).alias("_l"), F.col(key))
    cut = small_side(hash_cut(rows, size, key, seed, by=["_l"]))
    columns = [f"`{c}`" for c in df.columns]
    marked = df.join(cut.withColumnRenamed("_l", label).drop("_k"), label, "left")
    split = cut.where("_cut_take < _cut_n")
    if split.isEmpty():
        return marked.select(*columns, before_cut(seed, key).alias("is_test"))
    tied = F.coalesce((F.col("_cut_take") < F.col("_cut_n")) & (F.col(key) == F.col("_cut_key")), F.lit(False))
    whole = marked.where(~tied).select(*columns, before_cut(seed, key).alias("is_test"))
    placed = ranked(marked.where(tied), label, "_place")
    first = placed.groupBy(label).agg(F.min("_place").alias("_first"))
    some = placed.join(small_side(first), label).select(
        *columns, (F.col("_place") - F.col("_first") < F.col("_cut_take")).alias("is_test"))
    return whole.unionByName(some)


# -- fitting -----------------------------------------------------------------------

class OneClass(ValueError):
    """Training needs at least two classes."""


def fit_sample(train: DataFrame, label: str, key: str, max_rows: int | None = None, seed=42) -> tuple[DataFrame, list]:
    """Rows to fit on and their labels in order: all rows, or if a caller sets ``max_rows`` the same share of every class.

    Rows are then taken in hash order. A class keeps one row at least, and shares are rounded.
    """
    counts = train.groupBy(label).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counts) < 2:
        raise OneClass("training rows have fewer than two classes")
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label!r}")
    n = sum(r.n for r in counts)
    if max_rows is not None and n > max_rows:
        train = stratified_split(train, label, key, max_rows / n, seed, least=1).where("is_test").drop("is_test")
    return train, sorted(r[0] for r in counts)


def fit_classifier(train: DataFrame, label: str, key: str, width: int, c: float = 1.0, max_iter: int = 1000,
                   tol: float = 1e-6, features: str = "features", max_fit_rows: int | None = None, seed=42,
                   start: Classifier | None = None) -> Classifier:
    """L2 logistic regression with balanced class weights over sparse ``features`` of ``width`` columns.

    All rows are used, unless a caller sets ``max_fit_rows``. ``start`` is an earlier model whose coefficients the solver
    begins with.
    """
    rows, labels = fit_sample(train.select(key, label, features), label, key, max_fit_rows, seed)
    return Classifier.fit(rows.select(F.col(label).alias("label"), F.col(features).alias("features")), labels, width, c,
                          max_iter, tol, start)


def uncertainty(scored: DataFrame) -> DataFrame:
    """Add ``al_uncertainty``: one minus the largest class probability."""
    return scored.withColumn("al_uncertainty", 1.0 - F.array_max("probability"))


# -- metrics -----------------------------------------------------------------------

def _ratio(a, b):
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))


def class_report(predictions: DataFrame, label: str, predicted: str = "prediction_label") -> DataFrame:
    """``(label, precision, recall, f1, support)``: one row per class seen on either side.

    A zero denominator scores 0.
    """
    marg = per_label(contingency(predictions, label, predicted))
    return marg.select(
        "label", _ratio("hits", "predicted").alias("precision"),
        _ratio("hits", "support").alias("recall"),
        F.coalesce(F.try_divide(2.0 * F.col("hits"), F.col("support") + F.col("predicted")),
                   F.lit(0.0)).alias("f1"), "support", "hits")


def report_with_averages(predictions: DataFrame, label: str,
                         predicted: str = "prediction_label", digits: int = 4) -> DataFrame:
    """Class report plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    rep = class_report(predictions, label, predicted)
    n = F.sum("support")
    weighted = lambda m: F.try_divide(F.sum(F.col(m) * F.col("support")), n)
    acc = F.try_divide(F.sum("hits").cast("double"), n)
    parts = [
        rep.drop("hits"),
        rep.agg(F.lit("accuracy").alias("label"), acc.alias("precision"), acc.alias("recall"),
                acc.alias("f1"), n.alias("support")),
        rep.agg(F.lit("macro avg").alias("label"),
                *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")], n.alias("support")),
        rep.agg(F.lit("weighted avg").alias("label"),
                *[weighted(m).alias(m) for m in ("precision", "recall", "f1")], n.alias("support"))]
    out = reduce(DataFrame.unionByName, parts)
    return out.select("label", *[F.round(m, digits).alias(m) for m in ("precision", "recall", "f1")],
                      "support")


def scores(predictions: DataFrame, label: str, predicted: str = "prediction_label") -> dict:
    """Accuracy and macro F1, four digits."""
    row = class_report(predictions, label, predicted).agg(
        F.round(F.try_divide(F.sum("hits").cast("double"), F.sum("support")), 4).alias("accuracy"),
        F.round(F.avg("f1"), 4).alias("f1_macro")).head()
    return {"accuracy": row.accuracy, "f1_macro": row.f1_macro}


# -- training ----------------------------------------------------------------------

@dataclass
class Trained:
    model: Classifier
    vectoriser: TfidfModel
    predictions: DataFrame
    metrics: dict
    card: DataFrame = field(repr=False)

    def save(self, spark, path: str) -> None:
        self.model.save(spark, f"{path}/model")
        self.vectoriser.save(spark, f"{path}/vocabulary")


def trainable(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    return df.dropna(how="any", subset=[label, text])


def train_and_evaluate(df: DataFrame, key: str, text: str = "text", label: str = "label",
                       max_features: int = TRAIN_FEATURES, test_share: float = TRAIN_HOLDOUT,
                       seed=42, max_fit_rows: int | None = None) -> Trained:
    """80/20 stratified split, vectoriser and model fitted on the training part only, on all of it unless ``max_fit_rows`` is set."""
    rows = written(trainable(df, text, label).select(key, text, F.col(label).cast("string").alias(label)), "train-rows")
    split = stratified_split(rows, label, key, test_share, seed)
    vectoriser = TfidfModel.fit(split.where(~F.col("is_test")), max_features, text)
    data = written(vectoriser.transform(split, text).select(key, label, "is_test", "features"),
                   "train-features")
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    model = fit_classifier(train, label, key, len(vectoriser.terms), max_fit_rows=max_fit_rows, seed=seed)
    predictions = model.transform(test).select(key, label, "prediction_label", "probability")
    sizes = data.agg(F.count_if(~F.col("is_test")).alias("train_size"),
                     F.count_if("is_test").alias("test_size")).head()
    metrics = {**scores(predictions, label), "train_size": sizes.train_size,
               "test_size": sizes.test_size}
    spark = df.sparkSession
    entries = [("total_rows", None, float(sizes.train_size + sizes.test_size))]
    entries += [(m, None, float(v)) for m, v in metrics.items()]
    card = spark.createDataFrame(entries, "metric string, name string, value double").unionByName(
        data.groupBy(label).agg(F.count("*").alias("n")).select(
            F.lit("label_dist").alias("metric"), F.col(label).alias("name"),
            F.col("n").cast("double").alias("value")))
    return Trained(model, vectoriser, predictions, metrics, card)


# -- active learning ---------------------------------------------------------------

@dataclass
class ActiveLearningResult:
    selected: DataFrame         # key, al_uncertainty, al_iteration and the input columns
    iterations: DataFrame       # one row per round
    scores: DataFrame           # key, al_uncertainty for every row
    skipped: str | None = None


ROUND_SCHEMA = ("iteration int, labeled_size long, selected long, mean_uncertainty double, "
                "accuracy double, f1_macro double, fit_rows long, fit_steps int")


def has_label(label: str):
    return F.col(label).isNotNull() & (F.trim(F.col(label).cast("string")) != "")


def low_confidence_pool(df: DataFrame, confidence: str = "confidence",
                        share: float = POOL_QUANTILE) -> DataFrame:
    """Rows with a confidence up to its ``share`` quantile."""
    cut = exact_quantiles(nan_to_null(df.select(confidence)), [confidence], [share])[confidence]
    return df.where(F.col(confidence) <= F.lit(cut.values[0]))


def assign_roles(df: DataFrame, key: str, label: str, confidence: str | None, batch_size: int,
                 n_iterations: int, seed=42) -> DataFrame:
    """Add ``_role``: ``labeled``, ``pool``, or null for rows in neither.

    Unlabelled rows are the pool. If there are none, the low-confidence rows are; without
    a confidence column a seeded random quarter is (or as many as the rounds can use).
    """
    n, n_open = df.agg(F.count("*"), F.count_if(~has_label(label))).head()
    if n_open:
        return df.withColumn("_role", F.when(has_label(label), "labeled").otherwise("pool"))
    if confidence and confidence in df.columns:
        cut = exact_quantiles(nan_to_null(df.select(confidence)), [confidence],
                              [POOL_QUANTILE])[confidence].values[0]
        c = F.col(confidence)
        return df.withColumn("_role", F.when(c <= F.lit(cut), "pool").when(c > F.lit(cut), "labeled"))
    size = min(n, max(batch_size * n_iterations, n // 4))
    pool = seeded_sample(df.select(key), size, key, seed).withColumn("_in", F.lit(True))
    return df.join(pool, key, "left").select(
        *df.columns, F.when(F.col("_in"), "pool").otherwise("labeled").alias("_role"))


def run_cycle(df: DataFrame, key: str, label: str = "label", text: str = "text",
              confidence: str | None = "confidence", n_iterations: int = 3, batch_size: int = 50,
              min_labeled: int = 20, seed=42, max_features: int = AL_FEATURES,
              max_fit_rows: int | None = None) -> ActiveLearningResult:
    """Uncertainty sampling: fit, pick the least certain pool rows, add them, repeat.

    Features are computed once and written; a round reads them, fits one model (and one on a hold-out
    split) if the labelled rows have grown, and moves ``batch_size`` rows, known by key, from the pool
    to the labelled side. A fit uses all labelled rows, unless a caller sets ``max_fit_rows``, and starts from the
    coefficients of the round before (the first one on a hold-out split from those of the round's model).
    """
    spark = df.sparkSession
    roles = assign_roles(df, key, label, confidence, batch_size, n_iterations, seed)
    vectoriser = TfidfModel.fit(roles.where(F.col("_role").isNotNull()), max_features, text)
    table = written(
        vectoriser.transform(roles, text).select(
            key, F.when(has_label(label), F.col(label).cast("string")).alias("_label"), "_role",
            "features"), "al-features")
    key_type = table.schema[key].dataType.simpleString()
    picks_schema = f"`{key}` {key_type}, al_uncertainty double, al_iteration int"
    picked, rounds, model, judge, reason = [], [], None, None, None
    options = {"width": len(vectoriser.terms), "max_fit_rows": max_fit_rows, "seed": seed}
    for it in range(1, n_iterations + 1):
        chosen = F.broadcast(spark.createDataFrame(picked, picks_schema).select(
            key, F.lit(True).alias("_picked")))               # at most rounds * batch rows
        state = table.join(chosen, key, "left")
        labelled = state.where(((F.col("_role") == "labeled") | F.col("_picked"))
                               & F.col("_label").isNotNull()).select(key, "_label", "features")
        pool = state.where((F.col("_role") == "pool") & F.col("_picked").isNull())
        n_labelled, n_pool = state.agg(
            F.count_if(((F.col("_role") == "labeled") | F.col("_picked"))
                       & F.col("_label").isNotNull()),
            F.count_if((F.col("_role") == "pool") & F.col("_picked").isNull())).head()
        if n_labelled < min_labeled or n_pool == 0:
            reason = "too few labelled rows" if n_pool else "the pool is empty"
            break
        grown = not rounds or n_labelled > rounds[-1][1]      # picks without a label add nothing to fit
        if grown:
            try:
                model = fit_classifier(labelled, "_label", key, start=model, **options)
            except OneClass as exc:
                reason = str(exc)
                break
            held = {"accuracy": None, "f1_macro": None}
        if grown and n_labelled >= MIN_FOR_HOLDOUT:
            split = stratified_split(labelled, "_label", key, AL_HOLDOUT, seed)
            try:
                judge = fit_classifier(split.where(~F.col("is_test")), "_label", key, start=judge or model, **options)
                held = scores(judge.transform(split.where("is_test")), "_label")
            except OneClass:
                pass                                          # a one-row class fell to one side
        best = (uncertainty(model.transform(pool)).select(key, "al_uncertainty")
                .orderBy(F.desc("al_uncertainty"), key).limit(batch_size).collect())
        picked += [(r[0], r[1], it) for r in best]
        mean = round(sum(r[1] for r in best) / len(best), 4)
        rounds.append((it, n_labelled, len(best), mean, held["accuracy"], held["f1_macro"], model.rows, model.iterations))
    if model is None:
        selected = df.orderBy(key).limit(batch_size).withColumns({
            "al_uncertainty": F.lit(0.0), "al_iteration": F.lit(0)})
        zero = df.select(key, F.lit(0.0).alias("al_uncertainty"))
        return ActiveLearningResult(selected, spark.createDataFrame([], ROUND_SCHEMA), zero, reason)
    picks = spark.createDataFrame(picked, picks_schema)
    selected = df.join(F.broadcast(picks), key)               # at most rounds * batch rows
    all_scores = uncertainty(model.transform(table)).select(key, "al_uncertainty")
    return ActiveLearningResult(selected, spark.createDataFrame(rounds, ROUND_SCHEMA), all_scores, reason)


def score_uncertainty(df: DataFrame, key: str, label: str = "label", text: str = "text",
                      **options) -> DataFrame:
    """Only the per-row scores of a full cycle."""
    return run_cycle(df, key, label, text, **options).scores


def attach_scores(df: DataFrame, result: ActiveLearningResult, key: str) -> DataFrame:
    return df.join(result.scores, key, "left")


# -- several modalities ------------------------------------------------------------

def fuse_features(df: DataFrame, columns, into: str = "features", scale: dict | None = None) -> DataFrame:
    """Numeric columns as one sparse row ``{indices, values}``; rows with a missing one drop out.

    ``scale`` gives the mean and deviation of columns to be standardised; a constant column becomes 0.
    """
    def value(c: str):
        x = F.col(f"`{c}`").cast("double")
        if not scale:
            return x
        mean, spread = scale[c]
        return (x - F.lit(mean)) / F.lit(spread) if spread else x * 0.0
    whole = reduce(lambda a, b: a & b, [~is_missing(df, c) for c in columns])
    cells = F.struct(F.array(*[F.lit(i) for i in range(len(columns))]).alias("indices"),
                     F.array(*map(value, columns)).alias("values"))
    return df.where(whole).withColumn(into, cells)


def _scale(df: DataFrame, columns) -> dict:
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}"))]).head()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def compare_modalities(df: DataFrame, key: str, groups: dict, label: str = "label", test_share: float = TRAIN_HOLDOUT,
                       seed=42, max_fit_rows: int | None = None) -> DataFrame:
    """``(features, label, precision, recall, f1, support)``: a model for each group of columns, and one for ``all``.

    ``groups`` names the numeric columns of each modality of an aligned table. All models see the same rows, those with a
    label and every column present, and the same split; columns are standardised by the training part. Each is fitted on
    all of that part, unless a caller sets ``max_fit_rows``.
    """
    every = [c for columns in groups.values() for c in columns]
    # Written before rows are looked at: a filter would go below the joins and work out every feature once more.
    rows = written(df.where(has_label(label)).select(
        F.col(f"`{key}`"), F.col(f"`{label}`").cast("string").alias("_label"), *[F.col(f"`{c}`") for c in every]), "fused-rows")
    rows = fuse_features(rows, every).drop("features")
    split = written(stratified_split(rows, "_label", key, test_share, seed), "fused")
    scale = _scale(split.where(~F.col("is_test")), every)
    reports = []
    for name, columns in {**groups, "all": every}.items():
        data = fuse_features(split, columns, scale=scale).select(key, "_label", "is_test", "features")
        model = fit_classifier(data.where(~F.col("is_test")), "_label", key, len(columns), max_fit_rows=max_fit_rows, seed=seed)
        report = class_report(model.transform(data.where("is_test")), "_label")
        reports.append(report.select(F.lit(name).alias("features"), "label", "precision", "recall", "f1", "support"))
    return reduce(DataFrame.unionByName, reports)
