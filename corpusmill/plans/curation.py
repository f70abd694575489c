"""The seven-step curation job: collect, clean, annotate, review, select, train, report."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.durable import written
from corpusmill.operators import annotate, learn, quality, repair, review
from corpusmill.sources import sinks

# The strategy and sizes of the standard run.
STRATEGY = {"missing": "fill", "duplicates": "drop", "outliers": "clip_iqr"}


@dataclass
class Settings:
    key: str = "row_id"
    lexicon: dict | None = None
    strategy: dict = field(default_factory=lambda: dict(STRATEGY))
    threshold: float = annotate.THRESHOLD
    labelled_at: str | None = None
    n_iterations: int = 3
    batch_size: int = 50
    seed: int = 42
    promote: bool = True


@dataclass
class Outcome:
    raw: DataFrame
    cleaned: DataFrame
    labelled: DataFrame
    reviewed: DataFrame
    active: learn.ActiveLearningResult
    dataset: DataFrame
    trained: learn.Trained
    issues: DataFrame
    comparison: DataFrame
    annotation: DataFrame
    hitl: DataFrame
    funnel: DataFrame


def clean(raw: DataFrame, s: Settings):
    content = [c for c in raw.columns if c != s.key]
    issues = quality.detect_issues(raw, s.key)
    cleaned = written(repair.fix(raw, s.strategy, s.key), "cleaned")
    return cleaned, issues, quality.compare(raw, cleaned, s.key, content)


def funnel(steps: dict[str, DataFrame]) -> DataFrame:
    """``(step, name, rows)`` in the order given."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(i).alias("step"), F.lit(name).alias("name"), F.count("*").alias("rows"))
        for i, (name, df) in enumerate(steps.items(), 1)])


def queue_for_review(labelled: DataFrame, s: Settings, path: str) -> None:
    """First job of a real review: write the queue and stop."""
    sinks.write_csv(review.review_queue(labelled, s.key, s.threshold), path)


def read_corrections(spark: SparkSession, path: str, s: Settings, key_type: str = "bigint") -> DataFrame:
    """Second job of a real review: the corrected queue."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    flag = F.col("human_reviewed").cast("boolean") if "human_reviewed" in df.columns else F.lit(True)
    return df.select(F.col(s.key).cast(key_type).alias(s.key), "auto_label",
                     flag.alias("human_reviewed"))


def run(raw: DataFrame, settings: Settings | None = None,
        corrections: DataFrame | None = None) -> Outcome:
    """All steps. Without ``corrections`` the reviewer is simulated.

    The cleaned, labelled and reviewed tables are written once each: comparison and labelling read the first, review
    and reports the second, selection and training the third, each several times.
    """
    s = settings or Settings()
    cleaned, issues, comparison = clean(raw, s)
    labelled = written(annotate.auto_label(cleaned, s.lexicon, labelled_at=s.labelled_at), "labelled")
    fixes = corrections if corrections is not None else review.simulate_review(
        review.review_queue(labelled, s.key, s.threshold))
    reviewed = written(review.merge_review(labelled, fixes, s.key, s.threshold, s.promote,
                                           check=corrections is not None), "reviewed")
    active = learn.run_cycle(reviewed, s.key, n_iterations=s.n_iterations,
                             batch_size=s.batch_size, seed=s.seed)
    dataset = learn.attach_scores(reviewed, active, s.key)
    trained = learn.train_and_evaluate(dataset, s.key, seed=s.seed)
    return Outcome(
        raw, cleaned, labelled, reviewed, active, dataset, trained, issues, comparison,
        annotate.check_quality(labelled, "label", s.threshold),
        review.review_report(labelled, reviewed, s.key, s.threshold),
        funnel({"raw": raw, "cleaned": labelled,
                "high_confidence": annotate.confident(labelled, s.threshold),
                "after_review": reviewed, "scored": dataset}))


def summary(out: Outcome) -> DataFrame:
    """Final ``(metric, value)`` table."""
    spark = out.raw.sparkSession
    flagged_n = annotate.flagged(out.labelled).agg(F.count("*").cast("double").alias("value"))
    parts = [out.funnel.select(F.concat(F.lit("rows_"), "name").alias("metric"),
                               F.col("rows").cast("double").alias("value")),
             flagged_n.select(F.lit("low_confidence").alias("metric"), "value"),
             out.hitl.select(F.lit("corrections").alias("metric"),
                             F.col("corrected").cast("double").alias("value")),
             out.active.selected.agg(F.lit("al_selected").alias("metric"),
                                     F.count("*").cast("double").alias("value")),
             spark.createDataFrame([(k, float(v)) for k, v in out.trained.metrics.items()],
                                   "metric string, value double")]
    return reduce(DataFrame.unionByName, parts)


def save(out: Outcome, folder: str) -> None:
    """Dataset, artefacts and report tables of a run."""
    spark = out.raw.sparkSession
    sinks.export(out.dataset, f"{folder}/dataset", "parquet")
    out.trained.save(spark, f"{folder}/artefacts")
    for name, table in {"issues": out.issues, "comparison": out.comparison,
                        "annotation": out.annotation, "hitl": out.hitl,
                        "active_learning": out.active.iterations, "data_card": out.trained.card,
                        "final": summary(out)}.items():
        sinks.write_json(table, f"{folder}/reports/{name}")
