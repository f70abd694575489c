"""Collection: unified view, caps, samples, JSON bodies, pages, files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.durable import shared_folder
from corpusmill.functions.keys import seeded_sample
from corpusmill.plans.registry import COLLECTED_AT, CORPUS, UNIFIED, corpus, query, table
from corpusmill.sources import collect, html, landed, sinks

RECORD = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])


@query("unified_view", f"WITH {CORPUS} SELECT {UNIFIED} FROM corpus")
def unified_view(spark, sf):
    return corpus(spark, sf)


@query("label_map", """
SELECT doc_id, nullif(trim(text), '') AS text, CAST(NULL AS VARCHAR) AS audio, CAST(NULL AS VARCHAR) AS image,
       CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE lang END AS label,
       'landed:documents' AS source, '2024-01-01T00:00:00Z' AS collected_at
FROM documents""")
def label_map(spark, sf):
    return landed.normalise(table(spark, sf, "documents"), "landed:documents", COLLECTED_AT, label="lang",
                            label_map={"en": "English", "fr": "French"}, keep=["doc_id"])


@query("merge_sources", """
SELECT text, CAST(NULL AS VARCHAR) AS audio, CAST(NULL AS VARCHAR) AS image, label, source,
       '2024-01-01T00:00:00Z' AS collected_at
FROM (SELECT nullif(trim(text), '') AS text, lang AS label, 'documents' AS source FROM documents
      UNION ALL SELECT nullif(trim(text), ''), 'unknown', 'benchmark' FROM benchmark
      UNION ALL SELECT nullif(trim(text), ''), role, 'conversations' FROM conversations)""")
def merge_sources(spark, sf):
    return landed.merge([
        landed.normalise(table(spark, sf, "documents"), "documents", COLLECTED_AT, label="lang"),
        landed.normalise(table(spark, sf, "benchmark"), "benchmark", COLLECTED_AT),
        landed.normalise(table(spark, sf, "conversations"), "conversations", COLLECTED_AT, label="role")])


@query("capped_concat", """
SELECT file_no, row_no, text FROM (
  SELECT 0 AS file_no, item_id AS row_no, text FROM benchmark
  UNION ALL SELECT 1, conv_id * 1000 + turn, text FROM conversations
  UNION ALL SELECT 2, doc_id, text FROM documents)
ORDER BY file_no, row_no LIMIT 1000""")
def capped_concat(spark, sf):
    parts = [("benchmark", F.col("item_id")), ("conversations", F.col("conv_id") * 1000 + F.col("turn")),
             ("documents", F.col("doc_id"))]
    files = landed.merge([
        table(spark, sf, name).select(F.lit(i).alias("file_no"), key.alias("row_no"), "text")
        for i, (name, key) in enumerate(parts)], columns=None)
    return landed.capped_concat(files, 1000)


@query("allow_list_scan", """
WITH seen AS (SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 800)
SELECT doc_id, lang, text FROM seen WHERE lang IN ('fr', 'de') ORDER BY doc_id LIMIT 100""")
def allow_list_scan(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return landed.allow_listed(docs, "lang", ["fr", "de"], 100, "doc_id")


@query("seeded_sample", """
SELECT doc_id, source, n_chars FROM documents
ORDER BY left(md5('42:' || doc_id), 15), doc_id LIMIT 300""")
def sample(spark, sf):
    return seeded_sample(table(spark, sf, "documents").select("doc_id", "source", "n_chars"), 300, "doc_id")


@query("split_scan", """
SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 500""")
def split_scan(spark, sf):
    split = F.when(F.col("lang") == "en", "train").otherwise("test")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars", split.alias("split"))
    return landed.take_split(docs, "train[:500]", "doc_id").drop("split")


def _bodies(rows, group, order, body):
    """Landed response bodies: the records of one group as a JSON document."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), body.alias("item")))),
                        lambda x: x["item"])
    return rows.groupBy(group).agg(items.alias("items"))


@query("paged_json", """
SELECT doc_id // 64 + 1 AS page, CAST(doc_id % 64 AS INT) AS pos, text, lang AS label FROM documents""")
def paged_json(spark, sf):
    docs = table(spark, sf, "documents")
    item = F.struct("text", F.col("lang").alias("label"))
    pages = _bodies(docs, F.expr("doc_id div 64 + 1").alias("page"), F.col("doc_id"), item)
    pages = pages.select("page", F.to_json(F.struct(F.struct("items").alias("data"))).alias("payload"))
    return landed.paged_records(pages, RECORD, page_size=64, path="data.items")


@query("paged_json_stop", """
WITH sized AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id),
stop AS (SELECT min(conv_id) AS s FROM sized WHERE n < 3)
SELECT c.conv_id + 1 AS page, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS pos,
       text, role AS label
FROM conversations c, stop WHERE stop.s IS NULL OR conv_id <= stop.s""")
def paged_json_stop(spark, sf):
    turns = table(spark, sf, "conversations")
    item = F.struct("text", F.col("role").alias("label"))
    pages = _bodies(turns, (F.col("conv_id") + 1).alias("page"), F.col("turn"), item)
    return landed.paged_records(pages.select("page", F.to_json("items").alias("payload")), RECORD,
                                page_size=3)


@query("json_records", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_records(spark, sf):
    record = T.StructType([T.StructField("k", T.LongType())])
    rows = table(spark, sf, "events").select(
        "event_id", "event_type", F.explode_outer(landed.json_records(F.col("props"), record)).alias("r"))
    return rows.select("event_id", "event_type", "r.k")


@query("envelope_rows", """
SELECT doc_id // 100 * 100 AS "offset", CAST(doc_id % 100 AS INT) AS pos, text, lang AS label
FROM documents""")
def envelope_rows(spark, sf):
    record = F.struct("text", F.col("lang").alias("label"))
    bare = F.col("lang") == "fr"
    item = F.struct(F.when(~bare, record).alias("row"), F.when(bare, F.col("text")).alias("text"),
                    F.when(bare, F.col("lang")).alias("label"))
    batches = _bodies(table(spark, sf, "documents"), F.expr("doc_id div 100 * 100").alias("offset"),
                      F.col("doc_id"), item)
    batches = batches.select("offset", F.to_json(F.struct(F.col("items").alias("rows"))).alias("payload"))
    return landed.envelope_rows(batches, RECORD)


@query("landed_csv", f"WITH {CORPUS} SELECT row_id, text, label, source FROM corpus")
def landed_csv(spark, sf):
    folder = f"{shared_folder(spark)}/corpusmill/landed-{uuid.uuid4().hex}"
    sinks.write_csv(corpus(spark, sf).select("row_id", "text", "label", F.col("source").alias("site")), folder)
    rows = landed.read_csv(spark, folder)
    out = landed.normalise(rows, "", COLLECTED_AT, keep=["row_id", "site"])
    return out.select(F.col("row_id").cast("bigint").alias("row_id"), "text", "label",
                      F.col("site").alias("source"))


@query("collection_summary", f"""
WITH {CORPUS}
SELECT 'total' AS section, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM corpus
UNION ALL SELECT 'label', label, count(*) FROM corpus GROUP BY label
UNION ALL SELECT 'source', source, count(*) FROM corpus GROUP BY source""")
def collection_summary(spark, sf):
    return collect.summary(corpus(spark, sf))


@query("sequential_id", """
SELECT 'item_' || CASE WHEN r < 10000 THEN lpad(CAST(r AS VARCHAR), 4, '0') ELSE CAST(r AS VARCHAR) END AS id,
       o_orderkey, o_totalprice
FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders)""")
def sequential_id(spark, sf):
    return landed.sequential_id(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


@query("scrape_nav_links", """
WITH links AS (
  SELECT page_id, url, unnest(regexp_extract_all(
    regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a [^>]*>(.*?)</a>', 1, 's')) AS link FROM pages)
SELECT page_id, trim(replace(replace(replace(link, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS text,
       'scrape:' || split_part(url, '/', 3) AS source
FROM links WHERE trim(link) <> ''""")
def scrape_nav_links(spark, sf):
    found = html.scrape(landed.spread(table(spark, sf, "pages"), "page_id"), "nav a", COLLECTED_AT, keep_key=True)
    return found.select("page_id", "text", "source")


@query("scrape_pages", r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS article,
         regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's') AS ad FROM pages),
parts AS (
  SELECT page_id, url, unnest(list_append(string_split_regex(article, '</?(?:h1|p)>'), ad)) AS part FROM a),
plain AS (
  SELECT page_id, url, replace(replace(replace(regexp_replace(regexp_replace(
           replace(part, '<br>', ' '), '</?b>', '', 'g'), '&amp;?', '&', 'g'),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"') AS t FROM parts)
SELECT page_id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text, 'scrape:' || split_part(url, '/', 3) AS source
FROM plain WHERE trim(regexp_replace(t, '\s+', ' ', 'g')) <> ''""")
def scrape_pages(spark, sf):
    found = html.scrape(landed.spread(table(spark, sf, "pages"), "page_id"), "article h1, article p, div.ad", COLLECTED_AT, keep_key=True)
    return found.select("page_id", "text", "source")
