"""TF-IDF, splits, pools, active learning, training and the whole curation job."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.durable import written
from corpusmill.operators import annotate, learn, repair, review, tfidf
from corpusmill.plans import curation
from corpusmill.plans.queries_label import WITH as WITH_LABELLED
from corpusmill.plans.queries_label import labelled
from corpusmill.plans.registry import CORPUS, LEXICON, corpus, documents, query

GRAMS = r"""tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM documents),
g AS (SELECT doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM tok),
tf AS (SELECT doc_id, term, count(*) AS n FROM g GROUP BY 1, 2),
vocab AS (SELECT term, CAST(sum(n) AS BIGINT) AS ctf, count(*) AS df,
  ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1.0 AS idf
  FROM tf GROUP BY term HAVING count(*) >= 2 ORDER BY ctf DESC, term LIMIT 5000)"""


@query("tfidf_vocab", f"""WITH {GRAMS}
SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, ctf, df, round(idf, 6) AS idf FROM vocab""")
def tfidf_vocab(spark, sf):
    return tfidf.vocabulary(documents(spark, sf), 5000).withColumn("idf", F.round("idf", 6))


@query("tfidf", f"""WITH {GRAMS}, w AS (SELECT doc_id, term, (1.0 + ln(n)) * idf AS w FROM tf JOIN vocab USING (term)),
norm AS (SELECT doc_id, sqrt(sum(w * w)) AS s FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / s, 6) AS weight FROM w JOIN norm USING (doc_id)""")
def tfidf_long(spark, sf):
    out = tfidf.tfidf(documents(spark, sf).select("doc_id", "text"), "doc_id", 5000)
    return out.withColumn("weight", F.round("weight", 6))


@query("stratified_split", f"""WITH {CORPUS},
r AS (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY left(md5('42:' || row_id), 15), row_id) AS rn,
  count(*) OVER (PARTITION BY label) AS n FROM corpus WHERE label IS NOT NULL)
SELECT row_id, label, rn <= floor(n * 0.2 + 0.5) AS is_test FROM r""")
def stratified_split(spark, sf):
    rows = learn.trainable(corpus(spark, sf)).select("row_id", "label")
    return learn.stratified_split(rows, "label", "row_id", 0.2)


@query("quantile_pool", f"""{WITH_LABELLED}
SELECT row_id, confidence FROM labelled WHERE confidence <= (SELECT quantile_cont(confidence, 0.3) FROM labelled)""")
def quantile_pool(spark, sf):
    return learn.low_confidence_pool(labelled(spark, sf).select("row_id", "confidence"))


@query("labelled_and_pool", f"""WITH {CORPUS}
SELECT row_id, CASE WHEN label IS NOT NULL AND trim(label) <> '' THEN 'labeled' ELSE 'pool' END AS role FROM corpus""")
def labelled_and_pool(spark, sf):
    roles = learn.assign_roles(corpus(spark, sf), "row_id", "label", None, 50, 3)
    return roles.select("row_id", F.col("_role").alias("role"))


@query("topk_uncertain", f"""{WITH_LABELLED}
SELECT row_id, round(1.0 - confidence, 4) AS al_uncertainty FROM labelled
ORDER BY round(1.0 - confidence, 4) DESC, row_id LIMIT 50""")
def topk_uncertain(spark, sf):
    u = labelled(spark, sf).select("row_id", F.round(1.0 - F.col("confidence"), 4).alias("al_uncertainty"))
    return u.orderBy(F.desc("al_uncertainty"), "row_id").limit(50)


def reviewed(spark, sf):
    """Every row labelled, after a simulated review; written, as review and learning read it many times."""
    rows = written(labelled(spark, sf), "labelled")
    return written(review.merge_review(rows, review.simulate_review(review.review_queue(rows, "row_id")), "row_id"), "reviewed")


POOL = f"""{WITH_LABELLED}, pool AS (
  SELECT row_id FROM labelled WHERE confidence <= (SELECT quantile_cont(confidence, 0.3) FROM labelled)),
rounds AS (SELECT CAST(unnest(range(1, 4)) AS INTEGER) AS iteration, (SELECT count(*) FROM pool) AS pool)"""


@query("al_cycle", f"""{POOL}
SELECT iteration, (SELECT count(*) FROM labelled) - pool + 50 * (iteration - 1) AS labeled_size,
       least(50, pool - 50 * (iteration - 1)) AS selected, true AS scored
FROM rounds WHERE pool > 50 * (iteration - 1)""")
def al_cycle(spark, sf):
    found = learn.run_cycle(reviewed(spark, sf), "row_id").iterations
    scored = F.col("accuracy").between(0, 1) & F.col("f1_macro").between(0, 1) & F.col("mean_uncertainty").between(0, 1)
    return found.select("iteration", "labeled_size", "selected", scored.alias("scored"))


@query("al_selected", f"""{POOL}
SELECT iteration AS al_iteration, least(50, pool - 50 * (iteration - 1)) AS selected,
       least(50, pool - 50 * (iteration - 1)) AS different, 0 AS outside_pool, false AS repeated
FROM rounds WHERE pool > 50 * (iteration - 1)""")
def al_selected(spark, sf):
    rows = reviewed(spark, sf)
    found = learn.run_cycle(rows, "row_id").selected.select("row_id", "al_iteration")
    pool = learn.low_confidence_pool(rows).select("row_id", F.lit(True).alias("in_pool"))
    twice = found.groupBy("row_id").agg((F.count("*") > 1).alias("twice"))
    return found.join(pool, "row_id", "left").join(twice, "row_id").groupBy("al_iteration").agg(
        F.count("*").alias("selected"), F.countDistinct("row_id").alias("different"),
        F.count_if(F.col("in_pool").isNull()).alias("outside_pool"), F.max("twice").alias("repeated"))


@query("uncertainty_scores", f"{WITH_LABELLED} SELECT row_id, true AS in_range FROM labelled")
def uncertainty_scores(spark, sf):
    out = learn.score_uncertainty(reviewed(spark, sf), "row_id", n_iterations=1)
    return out.select("row_id", F.col("al_uncertainty").between(0, 0.5 + 1e-9).alias("in_range"))


@query("train_eval", f"""WITH {CORPUS}
SELECT label, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS support, true AS scored
FROM corpus WHERE label IS NOT NULL AND text IS NOT NULL GROUP BY label""")
def train_eval(spark, sf):
    trained = learn.train_and_evaluate(corpus(spark, sf), "row_id")
    scored = F.col("precision").between(0, 1) & F.col("recall").between(0, 1) & F.col("f1").between(0, 1)
    return learn.class_report(trained.predictions, "label", "prediction_label").select(
        "label", F.col("support").cast("long").alias("support"), scored.alias("scored"))


CURATED = ("""WITH c AS (SELECT * FROM (VALUES (1)) t(x)), """ + CORPUS + """,
d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY text, label ORDER BY row_id) AS rn
  FROM (SELECT * REPLACE (coalesce(text, '[missing]') AS text) FROM corpus)) WHERE rn = 1), """
       + WITH_LABELLED.split("hits AS (", 1)[1].join(["hits AS (", ""]).replace("FROM corpus)", "FROM d)"))


@query("curation_funnel", CURATED + """
SELECT 1 AS step, 'raw' AS name, count(*) AS rows FROM corpus
UNION ALL SELECT 2, 'cleaned', count(*) FROM d
UNION ALL SELECT 3, 'high_confidence', count(*) FROM labelled WHERE confidence >= 0.55
UNION ALL SELECT 4, 'after_review', count(*) FROM labelled""")
def curation_funnel(spark, sf):
    raw = corpus(spark, sf)
    cleaned = repair.fix(raw, curation.STRATEGY, "row_id")
    marked = annotate.auto_label(cleaned, LEXICON)
    reviewed = review.merge_review(
        marked, review.simulate_review(review.review_queue(marked, "row_id")), "row_id")
    return curation.funnel({"raw": raw, "cleaned": cleaned, "high_confidence": annotate.confident(marked),
                            "after_review": reviewed})


@query("curation_summary", CURATED + """,
final AS (SELECT *, CASE WHEN confidence < 0.55 THEN coalesce(label, auto_label) ELSE auto_label END AS final FROM labelled),
parts AS (SELECT final, count(*) AS n, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS test FROM final GROUP BY final)
SELECT metric, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'rows_raw' AS metric, count(*) AS value FROM corpus
  UNION ALL SELECT unnest(['rows_cleaned', 'rows_after_review', 'rows_scored']), (SELECT count(*) FROM d)
  UNION ALL SELECT 'rows_high_confidence', count(*) FROM labelled WHERE confidence >= 0.55
  UNION ALL SELECT 'low_confidence', count(*) FROM labelled WHERE confidence < 0.55
  UNION ALL SELECT 'corrections', count(*) FROM labelled WHERE confidence < 0.55 AND label <> auto_label
  UNION ALL SELECT 'al_selected', least(50, count(*)) FROM labelled
    WHERE confidence <= (SELECT quantile_cont(confidence, 0.3) FROM labelled)
  UNION ALL SELECT 'test_size', sum(test) FROM parts
  UNION ALL SELECT 'train_size', sum(n - test) FROM parts)""")
def curation_summary(spark, sf):
    settings = curation.Settings(lexicon=LEXICON, n_iterations=1)
    out = curation.summary(curation.run(corpus(spark, sf), settings))
    return out.where(~F.col("metric").isin("accuracy", "f1_macro"))


# What a fit yields has no SQL form: tests/test_learn.py fits the same rows by brute force.

@query("train_report")
def train_report(spark, sf):
    """Precision, recall, F1 and support of every class, with accuracy and averages."""
    trained = learn.train_and_evaluate(corpus(spark, sf), "row_id")
    return learn.report_with_averages(trained.predictions, "label")


@query("al_rounds")
def al_rounds(spark, sf):
    """Sizes, mean uncertainty, hold-out metrics and solver steps of every round."""
    return learn.run_cycle(reviewed(spark, sf), "row_id").iterations


@query("al_picks")
def al_picks(spark, sf):
    """The rows that every round selects, with their uncertainty."""
    found = learn.run_cycle(reviewed(spark, sf), "row_id").selected
    return found.select("row_id", "label", "al_iteration", F.round("al_uncertainty", 4).alias("al_uncertainty"))


@query("uncertainty_values")
def uncertainty_values(spark, sf):
    out = learn.score_uncertainty(reviewed(spark, sf), "row_id", n_iterations=1)
    return out.select("row_id", F.round("al_uncertainty", 4).alias("al_uncertainty"))


@query("curation_report")
def curation_report(spark, sf):
    """All final numbers of a run, accuracy and F1 included."""
    return curation.summary(curation.run(corpus(spark, sf), curation.Settings(lexicon=LEXICON, n_iterations=1)))
