"""Modality alignment and its description."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import align, learn
from corpusmill.operators.explore import histogram, text_features
from corpusmill.operators.quality import rows_with_missing
from corpusmill.plans.queries_quality import WORDS
from corpusmill.plans.registry import COLLECTED_AT, documents, query, table

TEXT_SQL = f"""t AS (SELECT doc_id AS id, source, '{COLLECTED_AT}' AS collected_at, length(text) AS text__text_len,
  {WORDS} AS text__word_count, round(length(text) / nullif(CAST({WORDS} AS DOUBLE), 0), 2) AS text__avg_word_len,
  round(length(regexp_replace(text, '[^!?…]', '', 'g')) / greatest(length(text), 1), 6) AS text__punct_ratio
  FROM documents)"""


def _array_sql(prefix):
    d = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"
    chan = ", ".join(
        f"round(list_avg(list_filter({d}, lambda x, i: (i - 1) % 3 = {c})), 3) AS {prefix}mean_{c}" for c in range(3))
    pop = f"list_stddev_pop({d})"
    return (f"{chan}, round({pop}, 3) AS {prefix}std, round(list_avg({d}) / 255.0, 4) AS {prefix}brightness, "
            f"round({pop} / 128.0, 4) AS {prefix}contrast")


IMAGE_SQL = f"i AS (SELECT vec_id AS id, {_array_sql('image__')} FROM embeddings)"
AUDIO = [f"audio__{c}" for c in align.MODALITY_FEATURES["audio"]]
AUDIO_SQL = f"""audio_values AS (SELECT vec_id AS id, [CAST(x AS DOUBLE) FOR x IN embedding] AS d FROM embeddings),
audio_middles AS (SELECT id, d, list_sum([abs(x) FOR x IN d]) AS w,
  list_sum([(i - 1) * abs(d[i]) FOR i IN range(1, len(d) + 1)]) / list_sum([abs(x) FOR x IN d]) AS mid FROM audio_values),
a AS (SELECT id, {", ".join(f"d[{i}] AS audio__mfcc_{i}" for i in range(1, 14))},
  len([i FOR i IN range(2, len(d) + 1) IF (d[i] < 0) <> (d[i - 1] < 0)]) / (len(d) - 1) AS audio__zcr, mid AS audio__spectral_centroid,
  sqrt(list_sum([(i - 1 - mid) * (i - 1 - mid) * abs(d[i]) FOR i IN range(1, len(d) + 1)]) / w) AS audio__spectral_bandwidth,
  sqrt(list_sum([x * x FOR x IN d]) / len(d)) AS audio__rms_energy FROM audio_middles)"""
LABEL_SQL = """l AS (SELECT doc_id AS id, CASE quality WHEN 1 THEN 'pos' ELSE 'neg' END AS label,
  toxic AS judged__toxic FROM labels)"""
COLUMNS = """id, source, collected_at, text__text_len, text__word_count, text__avg_word_len, text__punct_ratio, label,
  judged__toxic, image__mean_0, image__mean_1, image__mean_2, image__std, image__brightness, image__contrast,
  """ + ", ".join(AUDIO)
CTES = f"{TEXT_SQL}, {LABEL_SQL}, {IMAGE_SQL}, {AUDIO_SQL}"
OUTER = f"""aligned AS (SELECT {COLUMNS} FROM t FULL JOIN l USING (id) FULL JOIN i USING (id)
  FULL JOIN a USING (id))"""
INNER = f"aligned AS (SELECT {COLUMNS} FROM t JOIN l USING (id) JOIN i USING (id) JOIN a USING (id))"
FEATURES = ["text__text_len", "text__word_count", "text__avg_word_len", "text__punct_ratio", "judged__toxic",
            "image__mean_0", "image__mean_1", "image__mean_2", "image__std", "image__brightness",
            "image__contrast", *AUDIO]
GROUPS = {p: [c for c in FEATURES if c.startswith(p)] for p in ("text", "judged", "image", "audio")}


def _modalities(spark, sf):
    docs = documents(spark, sf).select(
        F.col("doc_id").alias("id"), "text", "source", F.lit(COLLECTED_AT).alias("collected_at"))
    vectors = table(spark, sf, "embeddings")
    audio = align.signal_stats(vectors.withColumnRenamed("vec_id", "id"), "embedding", "id")
    judged = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "pos").otherwise("neg").alias("label"), "toxic")
    return {"text": text_features(docs, "id", keep=["source", "collected_at"]), "judged": judged,
            "image": align.array_stats(vectors.withColumnRenamed("vec_id", "id"), "embedding", "id"),
            "audio": audio}


def aligned(spark, sf, how="inner"):
    return align.align(_modalities(spark, sf), "id", how)


def _shown(df):
    return df.select([F.round(c, 6).alias(c) if c.startswith("audio") else F.col(c) for c in df.columns])


SHOWN = ", ".join(f"round({c.strip()}, 6) AS {c.strip()}" if c.strip().startswith("audio") else c.strip()
                  for c in COLUMNS.split(","))


@query("align_inner", f"WITH {CTES}, {INNER} SELECT {SHOWN} FROM aligned")
def align_inner(spark, sf):
    return _shown(aligned(spark, sf))


@query("align_outer", f"WITH {CTES}, {OUTER} SELECT {SHOWN} FROM aligned")
def align_outer(spark, sf):
    return _shown(aligned(spark, sf, "outer"))


@query("align_left", f"""WITH {CTES}, aligned AS (SELECT {COLUMNS} FROM t LEFT JOIN l USING (id)
  LEFT JOIN i USING (id) LEFT JOIN a USING (id)) SELECT {SHOWN} FROM aligned""")
def align_left(spark, sf):
    return _shown(aligned(spark, sf, "left"))


@query("align_shared_label", f"""
WITH {LABEL_SQL}, e AS (SELECT vec_id AS id, CAST(label AS VARCHAR) AS label, embedding[1] AS v,
  list_sum([CAST(x AS DOUBLE) FOR x IN embedding]) AS total FROM embeddings)
SELECT id, l.label, judged__toxic, round(CAST(v AS DOUBLE), 6) AS vector__v, round(total, 6) AS vector__total
FROM l FULL JOIN e USING (id)""")
def align_shared_label(spark, sf):
    judged = _modalities(spark, sf)["judged"]
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("v"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double")), 6).alias("total"))
    return align.align({"judged": judged, "vector": vectors}, "id", "outer")


@query("coverage", f"WITH {CTES}, {OUTER} " + " UNION ALL ".join(
    f"SELECT '{p}' AS modality, round(100.0 * count(*) FILTER ({' AND '.join(f'{c} IS NOT NULL' for c in cols)}) "
    f"/ count(*), 1) AS coverage_pct FROM aligned" for p, cols in GROUPS.items()))
def coverage(spark, sf):
    return align.coverage(aligned(spark, sf, "outer"))


@query("aligned_missing", f"""WITH {CTES}, {OUTER} SELECT count(*) AS rows,
  count(*) FILTER ({' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}) AS complete,
  count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in FEATURES)}) AS with_missing FROM aligned""")
def aligned_missing(spark, sf):
    return rows_with_missing(aligned(spark, sf, "outer"), FEATURES)


STATS_SQL = " UNION ALL ".join(
    f"SELECT '{c.split('__')[0]}' AS modality, '{c.split('__')[1]}' AS feature, round(avg({c}), 3) AS mean, "
    f"round(stddev_samp({c}), 3) AS std, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 1) AS missing_pct "
    f"FROM aligned" for c in FEATURES)


@query("modality_stats", f"WITH {CTES}, {OUTER} {STATS_SQL}")
def modality_stats(spark, sf):
    return align.modality_stats(aligned(spark, sf, "outer"))


def _r(x, y):
    """Pearson over complete pairs; null for a constant side."""
    both = f"FILTER ({x} IS NOT NULL AND {y} IS NOT NULL)"
    return (f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) {both} * stddev_pop({y}) {both}, 0)")


Y = "CASE WHEN label = 'pos' THEN 1 ELSE 0 END"
CORR_SQL = f"""corr AS (SELECT feature, round(r, 4) AS r FROM (
  {" UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n, {_r(c, Y)} AS r FROM aligned" for c in FEATURES)})
  WHERE n > 10 AND r IS NOT NULL ORDER BY abs(round(r, 4)) DESC, feature LIMIT 10)"""


@query("label_corr_top10", f"WITH {CTES}, {OUTER}, {CORR_SQL} SELECT * FROM corr")
def label_corr_top10(spark, sf):
    return align.label_correlations(aligned(spark, sf, "outer"))


@query("corr_matrix", f"WITH {CTES}, {OUTER} " + " UNION ALL ".join(
    f"SELECT '{a}' AS f1, '{b}' AS f2, round({_r(a, b)}, 4) AS r FROM aligned" for a in FEATURES for b in FEATURES))
def corr_matrix(spark, sf):
    return align.correlation_matrix(aligned(spark, sf, "outer"), FEATURES)


@query("array_stats", f"SELECT vec_id, {_array_sql('')} FROM embeddings")
def array_stats(spark, sf):
    return align.array_stats(table(spark, sf, "embeddings"), "embedding", "vec_id")


@query("describe_aligned", f"""WITH {CTES}, {INNER}, {CORR_SQL}, st AS ({STATS_SQL})
SELECT 'n_rows' AS section, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS metric, CAST(count(*) AS DOUBLE) AS value
FROM aligned
UNION ALL SELECT 'coverage', p, 'pct', 100.0 FROM (VALUES ('text'), ('judged'), ('image'), ('audio')) v(p)
UNION ALL SELECT 'feature', modality || '__' || feature, 'mean', mean FROM st
UNION ALL SELECT 'feature', modality || '__' || feature, 'std', std FROM st
UNION ALL SELECT 'feature', modality || '__' || feature, 'missing_pct', missing_pct FROM st
UNION ALL SELECT 'label', label, 'count', CAST(count(*) AS DOUBLE) FROM aligned GROUP BY label
UNION ALL SELECT 'label', label, 'pct', round(100.0 * count(*) / (SELECT count(*) FROM aligned), 1)
  FROM aligned GROUP BY label
UNION ALL SELECT 'label_correlation', feature, 'r', r FROM corr""")
def describe_aligned(spark, sf):
    return align.describe_aligned(aligned(spark, sf))


@query("example_rows", f"""WITH {CTES}, {INNER}
SELECT id, label, text__text_len, image__std, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY id) AS rank FROM aligned) WHERE rank <= 6""")
def example_rows(spark, sf):
    return align.example_rows(aligned(spark, sf), n=6).select("id", "label", "text__text_len", "image__std", "rank")


@query("hist_feature_by_label", f"""WITH {CTES}, {INNER},
span AS (SELECT label, CAST(min(text__word_count) AS DOUBLE) AS lo, CAST(max(text__word_count) AS DOUBLE) AS hi
  FROM aligned GROUP BY label),
w AS (SELECT label, lo, (hi - lo) / 40 AS step FROM span),
c AS (SELECT a.label, CAST(least(floor((text__word_count - lo) / step), 39) AS INT) AS bin, count(*) AS n
  FROM aligned a JOIN w USING (label) GROUP BY 1, 2)
SELECT w.label, b.bin, round(lo + b.bin * step, 4) AS lower, round(lo + (b.bin + 1) * step, 4) AS upper,
  coalesce(n, 0) AS count
FROM w CROSS JOIN (SELECT unnest(range(40)) AS bin) b LEFT JOIN c ON c.label = w.label AND c.bin = b.bin""")
def hist_feature_by_label(spark, sf):
    return histogram(aligned(spark, sf), "text__word_count", 40, by="label")


COMPLETE = f"whole AS (SELECT * FROM aligned WHERE label IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)})"


def _modality_models(spark, sf):
    return learn.compare_modalities(aligned(spark, sf, "outer"), "id", GROUPS)


@query("fused_models", f"""WITH {CTES}, {OUTER}, {COMPLETE},
parts AS (SELECT label, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS support FROM whole GROUP BY label)
SELECT f AS features, label, support, true AS scored FROM parts, (VALUES ('text'), ('judged'), ('image'), ('audio'), ('all')) v(f)""")
def fused_models(spark, sf):
    """Test rows of every class for a model of each modality and one of all."""
    scored = F.col("precision").between(0, 1) & F.col("recall").between(0, 1) & F.col("f1").between(0, 1)
    return _modality_models(spark, sf).where("support > 0").select(
        "features", "label", F.col("support").cast("long").alias("support"), scored.alias("scored"))


@query("fused_report")
def fused_report(spark, sf):
    """Precision, recall and F1 of a model of each modality and of one of all."""
    return _modality_models(spark, sf).select(
        "features", "label", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")], "support")
