"""Exploration: text features, histograms, box statistics, top words, summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions.text import ANY_LETTER_WORD
from corpusmill.operators import explore, quality
from corpusmill.plans.queries_label import WITH as WITH_LABELLED
from corpusmill.plans.queries_label import labelled
from corpusmill.plans.queries_quality import CONTENT, WORDS
from corpusmill.plans.registry import CORPUS, corpus, query, table

STOP = ("the", "and", "que", "der", "und", "les")


@query("text_features", f"""WITH {CORPUS}
SELECT row_id, length(text) AS text_len, {WORDS} AS word_count,
  round(length(text) / nullif(CAST({WORDS} AS DOUBLE), 0), 2) AS avg_word_len,
  round(length(regexp_replace(text, '[^!?…]', '', 'g')) / greatest(length(text), 1), 6) AS punct_ratio FROM corpus""")
def text_features(spark, sf):
    return explore.text_features(corpus(spark, sf), "row_id")


def _hist_sql(bins):
    """Histogram of relation ``x(v)``."""
    return f"""span AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
w AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
  (CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END) / {bins} AS step FROM span),
c AS (SELECT CAST(least(floor((v - lo) / step), {bins - 1}) AS INT) AS bin, count(*) AS n FROM x, w WHERE v IS NOT NULL
  GROUP BY 1)
SELECT b.bin, round(lo + b.bin * step, 4) AS lower, round(lo + (b.bin + 1) * step, 4) AS upper, coalesce(n, 0) AS count
FROM w CROSS JOIN (SELECT unnest(range({bins})) AS bin) b LEFT JOIN c ON c.bin = b.bin"""


@query("hist_len", f"WITH {CORPUS}, x AS (SELECT CAST(length(text) AS DOUBLE) AS v FROM corpus), {_hist_sql(50)}")
def hist_len(spark, sf):
    return explore.histogram(corpus(spark, sf).select(F.length("text").alias("n")), "n", 50)


@query("hist_confidence", f"{WITH_LABELLED}, x AS (SELECT confidence AS v FROM labelled), {_hist_sql(30)}")
def hist_confidence(spark, sf):
    return explore.histogram(labelled(spark, sf).select("confidence"), "confidence", 30)


@query("hist_prices", f"WITH x AS (SELECT l_extendedprice AS v FROM lineitem), {_hist_sql(60)}")
def hist_prices(spark, sf):
    return explore.histogram(table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice", 60)


@query("hist_len_split", f"""WITH {CORPUS},
q AS (SELECT quantile_cont(length(text), 0.25) AS q1, quantile_cont(length(text), 0.75) AS q3 FROM corpus),
x AS (SELECT CAST(length(text) AS DOUBLE) AS v, CASE WHEN length(text) < q1 - 1.5 * (q3 - q1)
  OR length(text) > q3 + 1.5 * (q3 - q1) THEN 'outlier' ELSE 'normal' END AS part FROM corpus, q),
w AS (SELECT part, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
  (CASE WHEN min(v) = max(v) THEN 1.0 ELSE max(v) - min(v) END) / 60 AS step FROM x GROUP BY part),
c AS (SELECT x.part, CAST(least(floor((v - lo) / step), 59) AS INT) AS bin, count(*) AS n FROM x JOIN w USING (part)
  GROUP BY 1, 2)
SELECT w.part, b.bin, round(lo + b.bin * step, 4) AS lower, round(lo + (b.bin + 1) * step, 4) AS upper,
  coalesce(n, 0) AS count
FROM w CROSS JOIN (SELECT unnest(range(60)) AS bin) b LEFT JOIN c ON c.part = w.part AND c.bin = b.bin""")
def hist_len_split(spark, sf):
    rows = quality.with_text_length(corpus(spark, sf)).select(quality.TEXT_LEN)
    bounds = quality.fences(rows, [quality.TEXT_LEN])[quality.TEXT_LEN]
    return explore.split_histograms(rows, quality.TEXT_LEN, 60, quality.outside(quality.TEXT_LEN, bounds))


@query("box_by_label", f"""WITH {CORPUS}, x AS (SELECT label, length(text) AS v FROM corpus WHERE label IS NOT NULL),
q AS (SELECT label, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3
  FROM x GROUP BY label),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT label, row_number() OVER (ORDER BY any_value(q2), label) AS position, count(*) AS count,
  round(any_value(q1), 2) AS q1, round(any_value(q2), 2) AS median, round(any_value(q3), 2) AS q3,
  min(v) FILTER (v BETWEEN lo AND hi) AS whisker_low, max(v) FILTER (v BETWEEN lo AND hi) AS whisker_high,
  count(*) FILTER (v NOT BETWEEN lo AND hi) AS outliers
FROM x JOIN b USING (label) GROUP BY label""")
def box_by_label(spark, sf):
    return explore.box_stats(corpus(spark, sf).select("label", F.length("text").alias("n")), "n", "label")


@query("top_words", fr"""WITH {CORPUS}, w AS (SELECT label, unnest(regexp_extract_all(lower(text), '\p{{L}}{{3,}}')) AS word
  FROM corpus WHERE label IS NOT NULL),
f AS (SELECT label, word, count(*) AS freq FROM w WHERE word NOT IN {STOP} GROUP BY 1, 2)
SELECT label, rank, word, freq FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY freq DESC, word) AS rank FROM f) WHERE rank <= 20""")
def top_words(spark, sf):
    return explore.top_words(corpus(spark, sf), "label", 20, pattern=ANY_LETTER_WORD, stop_words=STOP)


@query("eda_summary", f"""WITH {CORPUS}, n AS (SELECT length(coalesce(text, '')) AS n FROM corpus)
SELECT 'total_rows' AS metric, CAST(NULL AS VARCHAR) AS name, CAST(count(*) AS DOUBLE) AS value FROM corpus
UNION ALL SELECT 'text_len_mean', NULL, round(avg(n), 1) FROM n
UNION ALL SELECT 'text_len_median', NULL, round(median(n), 1) FROM n
UNION ALL SELECT 'missing_text', NULL, CAST(count(*) FILTER (text IS NULL) AS DOUBLE) FROM corpus
UNION ALL SELECT 'missing_label', NULL, CAST(count(*) FILTER (label IS NULL) AS DOUBLE) FROM corpus
UNION ALL SELECT 'label_dist', label, CAST(count(*) AS DOUBLE) FROM corpus WHERE label IS NOT NULL GROUP BY label
UNION ALL SELECT 'sources', source, CAST(count(*) AS DOUBLE) FROM corpus GROUP BY source""")
def eda_summary(spark, sf):
    return explore.eda_summary(corpus(spark, sf))


@query("source_breakdown", """SELECT source AS value, count(*) AS n,
  round(100.0 * count(*) / (SELECT count(*) FROM documents), 1) AS pct FROM documents GROUP BY source""")
def source_breakdown(spark, sf):
    return quality.value_counts(table(spark, sf, "documents"), "source")


@query("missing_sample", f"""WITH {CORPUS}
SELECT row_id, {', '.join(f'CAST({c} IS NULL AS INT) AS {c}' for c in CONTENT)} FROM corpus
ORDER BY left(md5('42:' || row_id), 15), row_id LIMIT 300""")
def missing_sample(spark, sf):
    return explore.missing_sample(corpus(spark, sf), "row_id")
