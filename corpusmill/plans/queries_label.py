"""Labelling, agreement, examples, task documents and review."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions.text import TOKEN
from corpusmill.operators import annotate, learn, review
from corpusmill.plans.registry import COLLECTED_AT, CORPUS, LABELLED, LEXICON, corpus, documents, query, table

WITH = f"WITH {CORPUS}, {LABELLED}"
PAIRS = f"""{WITH}, pairs AS (SELECT label AS ref, auto_label AS pred, count(*) AS n FROM labelled
  WHERE label IS NOT NULL AND auto_label IS NOT NULL GROUP BY 1, 2)"""


def labelled(spark, sf):
    return annotate.auto_label(corpus(spark, sf), LEXICON, labelled_at=COLLECTED_AT)


@query("auto_label", f"{WITH} SELECT row_id, label, source, auto_label, confidence, auto_label_at FROM labelled")
def auto_label(spark, sf):
    return labelled(spark, sf).select("row_id", "label", "source", "auto_label", "confidence", "auto_label_at")


def _any(stems):
    return " + ".join(f"CAST(contains(lower(text), '{s}') AS INT)" for s in stems)


@query("auto_label_default", f"""
WITH {CORPUS}, h AS (SELECT row_id, lower(text) AS t, {_any(annotate.POSITIVE_STEMS)} AS p,
  {_any(annotate.NEGATIVE_STEMS)} AS g FROM corpus)
SELECT row_id, CASE WHEN p + g = 0 THEN CASE WHEN length(t) > 300 THEN 'neg' ELSE 'pos' END
  WHEN p >= g THEN 'pos' ELSE 'neg' END AS auto_label,
  CASE WHEN p + g = 0 THEN 0.51 ELSE round(0.5 + CAST(greatest(p, g) AS DOUBLE) / (p + g) * 0.49, 4) END AS confidence
FROM h""")
def auto_label_default(spark, sf):
    return annotate.auto_label(corpus(spark, sf)).select("row_id", "auto_label", "confidence")


TABLE_LEXICON = r"""lexicon AS (SELECT DISTINCT stem, CASE WHEN length(stem) % 2 = 0 THEN 'pos' ELSE 'neg' END AS polarity
  FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS stem FROM benchmark))"""


def _table_lexicon(spark, sf):
    words = table(spark, sf, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))).alias("stem"))
    polarity = F.when(F.length("stem") % 2 == 0, "pos").otherwise("neg")
    return words.select("stem", polarity.alias("polarity")).distinct()


@query("lexicon_matches", f"""
WITH {TABLE_LEXICON} SELECT d.doc_id, l.stem, l.polarity FROM documents d JOIN lexicon l
ON contains(lower(d.text), l.stem)""")
def lexicon_matches(spark, sf):
    return annotate.lexicon_matches(documents(spark, sf), _table_lexicon(spark, sf), "doc_id")


@query("auto_label_table", f"""
WITH {CORPUS}, {TABLE_LEXICON}, h AS (
  SELECT c.row_id, any_value(length(lower(c.text))) AS len, count(*) FILTER (polarity = 'pos') AS p,
         count(*) FILTER (polarity = 'neg') AS g
  FROM corpus c LEFT JOIN lexicon l ON contains(lower(c.text), l.stem) GROUP BY c.row_id)
SELECT row_id, CASE WHEN p + g = 0 THEN CASE WHEN len > 300 THEN 'neg' ELSE 'pos' END
  WHEN p >= g THEN 'pos' ELSE 'neg' END AS auto_label,
  CASE WHEN p + g = 0 THEN 0.51 ELSE round(0.5 + CAST(greatest(p, g) AS DOUBLE) / (p + g) * 0.49, 4) END AS confidence
FROM h""")
def auto_label_table(spark, sf):
    out = annotate.auto_label_from_table(corpus(spark, sf), _table_lexicon(spark, sf), "row_id")
    return out.select("row_id", "auto_label", "confidence")


@query("confidence_split", f"""{WITH}
SELECT row_id, confidence, 'flagged' AS part FROM labelled WHERE confidence < 0.55
UNION ALL SELECT row_id, confidence, 'confident' FROM labelled WHERE confidence >= 0.55""")
def confidence_split(spark, sf):
    df = labelled(spark, sf).select("row_id", "confidence")
    return annotate.flagged(df).withColumn("part", F.lit("flagged")).unionByName(
        annotate.confident(df).withColumn("part", F.lit("confident")))


@query("confidence_stats", f"""{WITH}
SELECT round(avg(confidence), 4) AS confidence_mean, round(median(confidence), 4) AS confidence_median,
  count(*) FILTER (confidence < 0.55) AS low_confidence_n FROM labelled""")
def confidence_stats(spark, sf):
    return annotate.confidence_stats(labelled(spark, sf))


AGREEMENT = """s AS (SELECT CAST(sum(n) AS DOUBLE) AS n, sum(n) FILTER (ref = pred) AS hits FROM pairs),
e AS (SELECT sum(r.n * p.n) AS chance FROM (SELECT ref, CAST(sum(n) AS DOUBLE) AS n FROM pairs GROUP BY ref) r
  JOIN (SELECT pred, CAST(sum(n) AS DOUBLE) AS n FROM pairs GROUP BY pred) p ON ref = pred),
k AS (SELECT s.n, round((hits / s.n - chance / (s.n * s.n)) / nullif(1 - chance / (s.n * s.n), 0), 4) AS kappa,
  round(100.0 * hits / s.n, 1) AS agreement_pct FROM s, e)"""


@query("kappa", f"{PAIRS}, {AGREEMENT} SELECT CAST(n AS BIGINT) AS n, kappa, agreement_pct FROM k")
def kappa(spark, sf):
    return annotate.agreement(labelled(spark, sf), "label")


@query("annotation_quality", f"""{PAIRS}, {AGREEMENT}
SELECT 'label_dist' AS metric, auto_label AS name, CAST(count(*) AS DOUBLE) AS value FROM labelled GROUP BY auto_label
UNION ALL SELECT 'label_dist_pct', auto_label, round(100.0 * count(*) / (SELECT count(*) FROM labelled), 1)
  FROM labelled GROUP BY auto_label
UNION ALL SELECT 'confidence_mean', NULL, round(avg(confidence), 4) FROM labelled
UNION ALL SELECT 'confidence_median', NULL, round(median(confidence), 4) FROM labelled
UNION ALL SELECT 'low_confidence_n', NULL, CAST(count(*) FILTER (confidence < 0.55) AS DOUBLE) FROM labelled
UNION ALL SELECT 'kappa', NULL, kappa FROM k
UNION ALL SELECT 'agreement_pct', NULL, agreement_pct FROM k""")
def annotation_quality(spark, sf):
    return annotate.check_quality(labelled(spark, sf), "label")


@query("confusion", f"""{WITH}
SELECT r AS reference, count(*) FILTER (label = r AND auto_label = 'pos') AS pred_pos,
  count(*) FILTER (label = r AND auto_label = 'neg') AS pred_neg
FROM labelled, (VALUES ('pos'), ('neg')) v(r) GROUP BY r""")
def confusion(spark, sf):
    return annotate.confusion(labelled(spark, sf), "label", "auto_label", ["pos", "neg"])


@query("match_counts", f"""{WITH}
SELECT count(*) FILTER (label = auto_label) AS matches,
  count(*) - count(*) FILTER (label = auto_label) AS mismatches,
  round(100.0 * count(*) FILTER (label = auto_label) / count(*), 1) AS match_pct FROM labelled""")
def match_counts(spark, sf):
    return annotate.match_counts(labelled(spark, sf))


@query("accuracy_by_confidence", f"""{WITH}, parts AS (SELECT unnest(['confident', 'flagged']) AS confidence_group)
SELECT confidence_group, count(l.row_id) AS n,
  coalesce(round(100.0 * count(*) FILTER (l.label = l.auto_label) / nullif(count(l.row_id), 0), 1), 0.0) AS accuracy_pct
FROM parts LEFT JOIN labelled l ON confidence_group = CASE WHEN confidence >= 0.55 THEN 'confident' ELSE 'flagged' END
GROUP BY confidence_group""")
def accuracy_by_confidence(spark, sf):
    return annotate.accuracy_by_confidence(labelled(spark, sf))


@query("counts_side_by_side", f"""{WITH}
SELECT v AS label_value, count(*) FILTER (label = v) AS label, count(*) FILTER (auto_label = v) AS auto_label
FROM labelled, (VALUES ('pos'), ('neg')) t(v) GROUP BY v""")
def counts_side_by_side(spark, sf):
    rows = labelled(spark, sf).withColumnRenamed("label", "truth")
    out = annotate.counts_side_by_side(rows, ["truth", "auto_label"], ["pos", "neg"])
    return out.withColumnsRenamed({"label": "label_value"}).withColumnRenamed("truth", "label")


SHORT = "CASE WHEN length(text) > 200 THEN left(text, 200) || '…' ELSE text END"


@query("spec_examples", f"""{WITH}
SELECT auto_label AS label, rank, row_id AS row, {SHORT} AS text
FROM (SELECT *, row_number() OVER (PARTITION BY auto_label ORDER BY confidence DESC, row_id) AS rank
      FROM labelled WHERE text IS NOT NULL) WHERE rank <= 3""")
def spec_examples(spark, sf):
    return annotate.class_examples(labelled(spark, sf), "row_id")


@query("edge_cases", f"""{WITH}
SELECT row_id AS row, {SHORT} AS text FROM labelled WHERE confidence < 0.55 AND text IS NOT NULL
ORDER BY row_id LIMIT 5""")
def edge_cases(spark, sf):
    return annotate.edge_cases(labelled(spark, sf), "row_id")


@query("specification", f"""{WITH}
SELECT 'rows' AS section, CAST(NULL AS VARCHAR) AS label, 0 AS rank, CAST(count(*) AS VARCHAR) AS text FROM labelled
UNION ALL SELECT 'example', auto_label, rank, {SHORT}
FROM (SELECT *, row_number() OVER (PARTITION BY auto_label ORDER BY confidence DESC, row_id) AS rank
      FROM labelled WHERE text IS NOT NULL) WHERE rank <= 3
UNION ALL SELECT 'edge_case', NULL, rank, {SHORT}
FROM (SELECT *, row_number() OVER (ORDER BY row_id) AS rank
      FROM labelled WHERE text IS NOT NULL AND confidence < 0.55) WHERE rank <= 5""")
def specification(spark, sf):
    return annotate.specification(labelled(spark, sf), "row_id")


def _uuid_sql(salt):
    h = f"md5('{salt}:' || row_id)"
    return " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def _task_sql(where=""):
    return f"""{WITH}
SELECT {_uuid_sql('task')} AS id, coalesce(text, '') AS text, source, collected_at, confidence,
  confidence < 0.55 AS flagged, 'lexicon-v1' AS model_version, confidence AS score,
  {_uuid_sql('result')} AS result_id, 'choices' AS type, auto_label AS choice, 'sentiment' AS from_name, 'text' AS to_name
FROM labelled {where}"""


def _flat(tasks):
    """Through JSON text and back, so what is checked is what a task file holds."""
    schema = tasks.schema
    back = tasks.select(F.from_json(F.to_json(F.struct("*")), schema).alias("t")).select("t.*")
    p = F.col("predictions")[0]
    r = p["result"][0]
    return back.select(
        "id", "data.text", "data.source", "data.collected_at", "meta.confidence", "meta.flagged",
        p["model_version"].alias("model_version"), p["score"].alias("score"), r["id"].alias("result_id"),
        r["type"].alias("type"), r["value"]["choices"][0].alias("choice"), r["from_name"].alias("from_name"),
        r["to_name"].alias("to_name"))


@query("task_export", _task_sql())
def task_export(spark, sf):
    return _flat(annotate.tasks(labelled(spark, sf), "row_id"))


@query("task_export_flagged", _task_sql("WHERE confidence < 0.55"))
def task_export_flagged(spark, sf):
    return _flat(annotate.tasks(labelled(spark, sf), "row_id", flagged_only=True))


@query("review_queue", f"""{WITH}
SELECT row_id, text, label, auto_label, confidence FROM labelled WHERE confidence < 0.55""")
def review_queue(spark, sf):
    return review.review_queue(labelled(spark, sf), "row_id")


def _reviewed(spark, sf):
    df = labelled(spark, sf)
    return df, review.merge_review(df, review.simulate_review(review.review_queue(df, "row_id")), "row_id")


@query("review_merge", f"""{WITH}
SELECT row_id, CASE WHEN confidence < 0.55 THEN coalesce(label, auto_label) ELSE auto_label END AS label,
  CASE WHEN confidence < 0.55 THEN coalesce(label, auto_label) ELSE auto_label END AS auto_label, confidence,
  CASE WHEN confidence < 0.55 THEN true END AS human_reviewed FROM labelled""")
def review_merge(spark, sf):
    return _reviewed(spark, sf)[1].select("row_id", "label", "auto_label", "confidence", "human_reviewed")


@query("review_report", f"""{WITH}
SELECT count(*) AS queued, count(*) AS reviewed,
  count(*) FILTER (coalesce(label, auto_label) <> auto_label) AS corrected FROM labelled WHERE confidence < 0.55""")
def review_report(spark, sf):
    return review.review_report(*_reviewed(spark, sf), "row_id")


@query("unknown_corrections", f"""{WITH}
SELECT doc_id AS row_id FROM labels WHERE doc_id NOT IN (SELECT row_id FROM labelled WHERE confidence < 0.55)""")
def unknown_corrections(spark, sf):
    offered = table(spark, sf, "labels").select(F.col("doc_id").alias("row_id"), F.lit("pos").alias("auto_label"))
    return review.unknown_corrections(labelled(spark, sf), offered, "row_id")


@query("class_report", f"""{PAIRS},
cls AS (SELECT DISTINCT ref AS label FROM pairs UNION SELECT DISTINCT pred FROM pairs),
m AS (SELECT label, coalesce((SELECT sum(n) FROM pairs WHERE ref = label AND pred = label), 0) AS hits,
  coalesce((SELECT sum(n) FROM pairs WHERE ref = label), 0) AS support,
  coalesce((SELECT sum(n) FROM pairs WHERE pred = label), 0) AS predicted FROM cls),
r AS (SELECT label, coalesce(hits / nullif(CAST(predicted AS DOUBLE), 0), 0) AS precision,
  coalesce(hits / nullif(CAST(support AS DOUBLE), 0), 0) AS recall,
  coalesce(2.0 * hits / nullif(CAST(support + predicted AS DOUBLE), 0), 0) AS f1, hits, support FROM m),
a AS (SELECT label, precision, recall, f1, support FROM r
  UNION ALL SELECT 'accuracy', sum(hits) / CAST(sum(support) AS DOUBLE), sum(hits) / CAST(sum(support) AS DOUBLE),
    sum(hits) / CAST(sum(support) AS DOUBLE), sum(support) FROM r
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM r)
SELECT label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
  CAST(support AS BIGINT) AS support FROM a""")
def class_report(spark, sf):
    return learn.report_with_averages(labelled(spark, sf), "label", "auto_label")
