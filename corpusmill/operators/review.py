"""Human review of low-confidence rows: queue out, corrections in, labels promoted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.keys import require_unique
from corpusmill.operators.annotate import THRESHOLD, flagged, unflagged


def review_queue(df: DataFrame, key: str, threshold: float = THRESHOLD) -> DataFrame:
    """``key, text, label, auto_label, confidence`` of the rows to review."""
    return flagged(df, threshold).select(key, "text", "label", "auto_label", "confidence")


def simulate_review(queue: DataFrame) -> DataFrame:
    """A reviewer who knows ``label``: disagreeing rows take it; all are marked reviewed.

    A row without a known label keeps its automatic one.
    """
    known = F.col("label").isNotNull()
    return (queue.withColumn("auto_label",
                             F.when(known, F.col("label")).otherwise(F.col("auto_label")))
                 .withColumn("human_reviewed", F.lit(True)))


def unknown_corrections(df: DataFrame, corrected: DataFrame, key: str,
                        threshold: float = THRESHOLD) -> DataFrame:
    """Corrections whose key is not in the queue."""
    return corrected.select(key).join(flagged(df, threshold).select(key), key, "left_anti")


def merge_review(df: DataFrame, corrected: DataFrame, key: str, threshold: float = THRESHOLD,
                 promote: bool = True, check: bool = False) -> DataFrame:
    """All rows, those of the queue with corrections applied.

    ``human_reviewed`` is the correction's flag (true if it has none), null for rows
    without one. ``promote`` makes the resulting ``auto_label`` the ``label``. Rows without a
    confidence are in no queue and stay as they are. Of several corrections for one key the
    largest label counts. With ``check`` those, and corrections for unknown rows, are an error.
    """
    if check:
        require_unique(corrected, key)
        bad = unknown_corrections(df, corrected, key, threshold).limit(1).collect()
        if bad:
            raise ValueError(f"correction for unknown row {bad[0][0]!r}")
    flag = F.col("human_reviewed") if "human_reviewed" in corrected.columns else F.lit(True)
    fix = F.max(F.struct(F.col("auto_label"), flag.alias("flag"))).alias("_fix")
    fixes = corrected.groupBy(key).agg(fix).select(
        key, F.col("_fix.auto_label").alias("_fix"), F.col("_fix.flag").alias("human_reviewed"),
        F.lit(True).alias("_matched"))
    queue = flagged(df, threshold).join(fixes, key, "left").withColumn(
        "auto_label", F.when(F.col("_matched"), F.col("_fix")).otherwise(F.col("auto_label")))
    rest = unflagged(df, threshold).withColumn("human_reviewed", F.lit(None).cast("boolean"))
    out = rest.unionByName(queue.select(*df.columns, "human_reviewed"))
    return out.withColumn("label", F.col("auto_label")) if promote else out


def review_report(df: DataFrame, reviewed: DataFrame, key: str,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row: queue size, rows marked reviewed, labels that really changed."""
    before = flagged(df, threshold).select(key, F.col("auto_label").alias("_before"))
    both = before.join(reviewed.select(key, "auto_label", "human_reviewed"), key)
    return both.agg(
        F.count("*").alias("queued"),
        F.count_if(F.coalesce("human_reviewed", F.lit(False))).alias("reviewed"),
        F.count_if(~F.col("_before").eqNullSafe(F.col("auto_label"))).alias("corrected"))
