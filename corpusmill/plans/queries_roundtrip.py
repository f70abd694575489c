"""What is written and read again: landed folders, exports, saved runs and models."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.durable import shared_folder
from corpusmill.functions.ranks import positions_in_groups
from corpusmill.operators import align, learn, quality
from corpusmill.operators.explore import text_features
from corpusmill.operators.learn import Classifier
from corpusmill.operators.tfidf import TfidfModel
from corpusmill.plans import curation
from corpusmill.plans.queries_align import TEXT_SQL
from corpusmill.plans.queries_learn import CURATED
from corpusmill.plans.queries_quality import NUM
from corpusmill.plans.registry import COLLECTED_AT, CORPUS, LEXICON, ORACLES, corpus, documents, query, table
from corpusmill.sources import collect, landed, sinks


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/corpusmill/{name}-{uuid.uuid4().hex}"


FILE_KEYS = 20_000          # of a landed file


def _by_folder(df, column: str, order: str, folder: str, size: int = FILE_KEYS) -> str:
    """CSV files of ``size`` keys for each value of ``column``, in a folder of its own; their paths follow the given order."""
    keys = positions_in_groups(df.select(column, order).distinct(), column, [order], "_place")
    keys = keys.select(F.col(column).alias("_column"), F.col(order).alias("_order"),
                       F.lpad(F.floor((F.col("_place") - 1) / size).cast("string"), 9, "0").alias("_file"))
    rows = df.join(keys, F.col(column).eqNullSafe(F.col("_column")) & F.col(order).eqNullSafe(F.col("_order")))
    rows.select(*df.columns, "_file").repartition(column, "_file").sortWithinPartitions(column, "_file", order).write.partitionBy(
        column, "_file").option("header", True).option("escape", '"').csv(folder)
    return folder


@query("first_csv_below", """
SELECT doc_id, text, source FROM documents WHERE lang = (SELECT min(lang) FROM documents) ORDER BY doc_id LIMIT 500""")
def first_csv_below(spark, sf):
    """The file with the smallest path below a folder, capped."""
    docs = documents(spark, sf).select("doc_id", "text", "source", "lang")
    folder = _by_folder(docs, "lang", "doc_id", _folder(spark, "below"))
    rows = landed.first_csv_below(spark, folder, 500, recursiveFileLookup=True)
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source")


@query("capped_folder", """
SELECT doc_id, lang, source FROM documents ORDER BY lang, doc_id LIMIT 700""")
def capped_folder(spark, sf):
    """A cap over a folder whose files differ in size: rows follow file names, then their place in the file."""
    docs = documents(spark, sf).select("doc_id", F.col("lang").alias("folder"), "lang", "source")
    folder = _by_folder(docs, "folder", "doc_id", _folder(spark, "capped"))
    rows = landed.capped_concat(landed.read_csv_in_order(spark, [folder], recursiveFileLookup=True), 700)
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source")


@query("collect_sources", f"""
SELECT nullif(trim(text), '') AS text, CAST(NULL AS VARCHAR) AS audio, CAST(NULL AS VARCHAR) AS image,
  CASE lang WHEN 'en' THEN 'English' ELSE lang END AS label, 'csv' AS source, '{COLLECTED_AT}' AS collected_at FROM documents
UNION ALL SELECT nullif(trim(text), ''), NULL, NULL, role, 'api:json', '{COLLECTED_AT}' FROM conversations
UNION ALL SELECT nullif(trim(text), ''), NULL, NULL, 'unknown', 'api:csv-concat', '{COLLECTED_AT}' FROM benchmark""")
def collect_sources(spark, sf):
    """A CSV source, paged JSON bodies and listed CSV files, merged and written as CSV, read again."""
    docs, pages, items = (_folder(spark, name) for name in ("docs", "pages", "items"))
    sinks.write_csv(documents(spark, sf).select("text", "lang"), docs)
    turns = table(spark, sf, "conversations").groupBy((F.col("conv_id") + 1).alias("page")).agg(
        F.to_json(F.collect_list(F.struct("text", "role"))).alias("payload"))
    turns.write.parquet(pages)
    sinks.write_csv(table(spark, sf, "benchmark").select("text"), items)
    out = _folder(spark, "collected")
    collect.collect(spark, [
        {"type": "hf_dataset", "path": docs, "source_id": "csv", "label_column": "lang", "label_map": {"en": "English"}},
        {"type": "api", "path": pages, "label_field": "role"},
        {"type": "api", "api_kind": "csv_http_concat", "paths": [items]}], COLLECTED_AT, out)
    return landed.read_csv(spark, out, missing=("",))


@query("load_modality", f"""WITH {TEXT_SQL}
SELECT id, source, CAST(text__text_len AS DOUBLE) AS text_len, CAST(text__word_count AS DOUBLE) AS word_count,
  text__avg_word_len AS avg_word_len FROM t""")
def load_modality(spark, sf):
    """A modality table as a landed CSV: known features come back as numbers."""
    rows = text_features(documents(spark, sf), "doc_id", keep=["source"]).withColumnRenamed("doc_id", "id")
    path = sinks.write_csv(rows.drop("punct_ratio"), _folder(spark, "modality"))
    loaded = align.load_modality(spark, path, "text")
    return loaded.df.select(F.col("id").cast("bigint").alias("id"), "source", *loaded.features)


@query("export_formats", """
SELECT vec_id, label, len(embedding) AS n, round(list_sum([CAST(x AS DOUBLE) FOR x IN embedding]), 3) AS total, fmt
FROM embeddings, (VALUES ('csv'), ('parquet')) f(fmt)""")
def export_formats(spark, sf):
    """A nested column through CSV, as JSON text, and through Parquet."""
    vectors = table(spark, sf, "embeddings")
    as_csv = landed.read_csv(spark, sinks.export(vectors, _folder(spark, "export"), "csv"))
    parts = [as_csv.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
                           F.from_json("embedding", "array<double>").alias("v"), F.lit("csv").alias("fmt")),
             spark.read.parquet(sinks.export(vectors, _folder(spark, "export"), "parquet")).select(
                 "vec_id", "label", F.col("embedding").cast("array<double>").alias("v"), F.lit("parquet").alias("fmt"))]
    both = parts[0].unionByName(parts[1])
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x)
    return both.select("vec_id", "label", F.size("v").cast("long").alias("n"), F.round(total, 3).alias("total"), "fmt")


@query("issue_report", ORACLES["detect_issues"])
def issue_report(spark, sf):
    """The issue table as a written report, read again."""
    rows = corpus(spark, sf, ["n_chars", "toxic"]).select("row_id", *NUM)
    path = sinks.write_json(quality.detect_issues(rows, "row_id"), _folder(spark, "issues"))
    return spark.read.schema("issue string, `column` string, metric string, value double, name string").json(path)


@query("saved_run", CURATED + """
SELECT row_id, source, CASE WHEN confidence < 0.55 THEN coalesce(label, auto_label) ELSE auto_label END AS label,
  auto_label AS automatic, confidence, true AS scored FROM labelled""")
def saved_run(spark, sf):
    """The dataset of a saved run, as it is read from its folder; labels before and after review."""
    folder = _folder(spark, "run")
    out = curation.run(corpus(spark, sf), curation.Settings(lexicon=LEXICON, n_iterations=1))
    curation.save(out, folder)
    saved = spark.read.parquet(f"{folder}/dataset")
    automatic = out.labelled.select("row_id", F.col("auto_label").alias("automatic"))
    return saved.join(automatic, "row_id").select(
        "row_id", "source", "label", "automatic", "confidence", F.col("al_uncertainty").isNotNull().alias("scored"))


@query("saved_model", f"""WITH {CORPUS}
SELECT label, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS support, true AS same
FROM corpus WHERE label IS NOT NULL AND text IS NOT NULL GROUP BY label""")
def saved_model(spark, sf):
    """Test rows scored by the fitted model and by the one loaded from its folder: equal to the last bit."""
    rows, folder = corpus(spark, sf), _folder(spark, "model")
    trained = learn.train_and_evaluate(rows, "row_id")
    trained.save(spark, folder)
    model, words = Classifier.load(spark, f"{folder}/model"), TfidfModel.load(spark, f"{folder}/vocabulary")
    test = rows.join(trained.predictions.select("row_id", F.col("probability").alias("fitted")), "row_id")
    again = model.transform(words.transform(test))
    return again.groupBy("label").agg(
        F.count("*").alias("support"), F.bool_and(F.col("probability") == F.col("fitted")).alias("same"))
