"""One query for each operator of the package, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from corpusmill.llm import (
    bpe, edit_fingerprint, html_text, metric_search, near_dedup, packing, prefix_trie, quality_filter, secrets, simhash,
    spelling, substring_dedup, token_rollup)
from corpusmill.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from corpusmill.llm.tables import Scratch
from corpusmill.llm.tokens import ranks_of

WORD = r"[^\x20\x09-\x0D]+"

SQL_NEAR = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]
                                      ELSE w END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id,
       coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS component FROM reach GROUP BY 1) c USING (doc_id)"""


@query("op1_near_dedup", SQL_NEAR)
def op1(spark, sf):
    return near_dedup.near_duplicates(table(spark, sf, "documents"), shingle=2, percent=80)


@query("op2_secret_scan")
def op2(spark, sf):
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    counts = [_count(spans, kind).alias(f"n_{name}") for kind, name in enumerate(secrets.KINDS)]
    return secrets.find_secrets(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(secrets.named_spans(base), 256).alias("base_sha256"),
        secrets.named_spans(spans).alias("spans"))


def _count(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query("op4_quality_filter")
def op4(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality_filter.resample(docs, table(spark, sf, "labels")).select("doc_id", "log_weight", "score", "kept")


@query("op5_bpe_round_trip")
def op5(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                       keep_ids=False).drop("text")


@query("op8_packing")
def op8(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.PATTERN, ids=False)


SQL_SUBSTRING = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) > 12)),
earliest AS (SELECT g, min(doc_id) AS first_doc FROM windows GROUP BY 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN earliest USING (g) WHERE first_doc < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


@query("op9_substring_dedup", SQL_SUBSTRING)
def op9(spark, sf):
    return substring_dedup.removed_passages(table(spark, sf, "documents")).select(
        F.col("key").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL_TOP_K = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
WHERE rank <= 20"""


@query("op3_top_k", SQL_TOP_K)
def op3(spark, sf):
    return metric_search.top_k(table(spark, sf, "embeddings"), lambda id: id % 20 == 0)


@query("op7_html_text")
def op7(spark, sf):
    return html_text.extracted(table(spark, sf, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op6_edit_fingerprint")
def op6(spark, sf):
    return edit_fingerprint.compared_to_next(table(spark, sf, "documents"))


@query("op10_token_rollup")
def op10(spark, sf):
    """Totals after four commits: all documents; toxic ones out; trimmed texts recounted; the second again."""
    encoders = {name: (ranks_of(public_tokenizers.path(f"{name}.tiktoken")), {}, public_tokenizers.PATTERN)
                for name in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    scratch = Scratch(spark, "rollup")
    trimmed, changed = F.trim("text"), F.trim("text") != F.col("text")
    docs = table(spark, sf, "documents").select(
        "doc_id", "source", "lang", changed.alias("changed"), token_rollup.counted(F.col("text"), encoders).alias("counts"),
        token_rollup.counted(F.when(changed, trimmed), encoders).alias("recounts"))
    counts = scratch.write(
        docs.select("doc_id", "source", "lang", "changed", "recounts", F.explode("counts").alias("version", "tokens")).select(
            "doc_id", "source", "lang", "version", "tokens",
            F.when(F.col("changed"), F.element_at("recounts", F.col("version"))).alias("after")), "counts")
    toxic = table(spark, sf, "labels").where("toxic = 1").select("doc_id").distinct()
    gone, stay = (counts.join(toxic, "doc_id", how) for how in ("left_semi", "left_anti"))
    rollup = token_rollup.Rollup(spark, f"{scratch.folder}/totals")
    rollup.commit("1-load", token_rollup.inserts(counts))
    rollup.commit("2-toxic", token_rollup.deletes(gone))
    rollup.commit("3-trimmed", token_rollup.revisions(stay.where("after is not null"), "tokens", "after"))
    rollup.commit("2-toxic", token_rollup.deletes(gone))
    return rollup.totals()


# crc32 in SQL: the 256 entries of its table by eight steps each, then one step per byte.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM (SELECT unnest(range(256)) AS i))"""


def _crc32(of: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295, {of}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), "
            f"4294967295)")


def _bytes(text: str) -> str:
    """UTF-8 of a string of code points below 256, as numbers."""
    return (f"flatten([CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] "
            f"ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END "
            f"FOR c IN regexp_extract_all({text}, '(?s).')])")


SQL_SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, k, {_crc32(_bytes("doc_id || ':' || run"))} AS h FROM runs, crc_table),
changed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
              ELSE run END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM changed GROUP BY 1 HAVING sum(k) >= 5 AND length(word) >= 6),
gaps AS (SELECT word, n, length(word) AS len, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r
  FROM (SELECT *, unnest(range(1, CAST(length(word) AS INTEGER) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b USING (len, i, l, r) WHERE a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.l || g.r
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.l || g.r),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near FROM near GROUP BY 1),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, f.word AS form, f.n AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN words f ON f.word = b.near AND f.n >= 5 * w.n),
up AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT up.word, forms.form, steps + 1 FROM up JOIN forms ON forms.word = up.root WHERE forms.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(root, steps) AS root FROM up GROUP BY 1) USING (word)"""


@query("op11_spelling_groups", SQL_SPELLING)
def op11(spark, sf):
    return spelling.spelling_groups(table(spark, sf, "documents"), drop_every=199)


# XXH64 in SQL: 64-bit arithmetic on 128-bit unsigned numbers. ``rotated`` binds its argument once.
_M = "18446744073709551615::UHUGEINT"
_P = [f"{p}::UHUGEINT" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579,
                                 2870177450012600261)]


def _rotated(x: str, by: int) -> str:
    return f"list_transform([{x}], lambda r: ((r << {by}) | (r >> {64 - by})) & {_M})[1]"


def _round(acc: str, word: str) -> str:
    return f"(({_rotated(f'({acc} + (({word} * {_P[1]}) & {_M})) & {_M}', 31)} * {_P[0]}) & {_M})"


def _little(hexed: str, at: str, size: int) -> str:
    """The number that ``size`` bytes from place ``at`` (in hexadecimal digits, from 1) make, lowest byte first."""
    parts = " || ".join(f"substr({hexed}, CAST({at} + {2 * k} AS INTEGER), 2)" for k in reversed(range(size)))
    return f"CAST(('0x' || {parts}) AS UBIGINT)::UHUGEINT"


def _xxh64(source: str, seed: int) -> str:
    """CTEs that end in ``xxh`` (g, h): the hash of every different string ``g`` of ``source``."""
    start = [(seed + x) % 2 ** 64 for x in (11400714785074694791 + 14029467366897019727, 14029467366897019727, 0, -11400714785074694791)]
    lanes = ", ".join(
        f"list_reduce(list_prepend({v}::UHUGEINT, [words[4 * i + {k}] FOR i IN range(1, n // 32 + 1)]), lambda a, w: {_round('a', 'w')}) AS v{k}"
        for k, v in enumerate(start))
    mixed = " + ".join(_rotated(f"v{k}", by) for k, by in enumerate((1, 7, 12, 18)))
    merged = (f"list_reduce([({mixed}) & {_M}, v0, v1, v2, v3], lambda a, v: "
              f"((xor(a, {_round('0::UHUGEINT', 'v')}) * {_P[0]}) + {_P[3]}) & {_M})")
    return rf"""hexed AS (SELECT DISTINCT g, hex(g) AS x, CAST(len(hex(g)) // 2 AS BIGINT) AS n FROM {source}),
worded AS (SELECT g, x, n, list_concat([0::UHUGEINT, 0::UHUGEINT, 0::UHUGEINT, 0::UHUGEINT],
  [{_little("x", "16 * i + 1", 8)} FOR i IN range(0, n // 8)]) AS words FROM hexed),
laned AS (SELECT g, x, n, words, {lanes.replace("words[4 * i + ", "words[4 * i + 1 + ")} FROM worded),
begun AS (SELECT g, x, n, words, ((CASE WHEN n >= 32 THEN {merged} ELSE {(seed + 2870177450012600261) % 2 ** 64}::UHUGEINT END) + n::UHUGEINT) & {_M} AS h
  FROM laned),
eights AS (SELECT g, x, n, list_reduce(list_prepend(h, words[5 + n // 32 * 4:]), lambda a, w:
  (({_rotated(f"xor(a, {_round('0::UHUGEINT', 'w')})", 27)} * {_P[0]}) + {_P[3]}) & {_M}) AS h FROM begun),
fours AS (SELECT g, x, n, CASE WHEN n % 8 >= 4 THEN
  (({_rotated(f"xor(h, ({_little('x', '16 * (n // 8) + 1', 4)} * {_P[0]}) & {_M})", 23)} * {_P[1]}) + {_P[2]}) & {_M} ELSE h END AS h FROM eights),
ones AS (SELECT g, list_reduce(list_prepend(h, [{_little("x", "2 * i + 1", 1)} FOR i IN range(n // 4 * 4, n)]), lambda a, b:
  ({_rotated(f"xor(a, (b * {_P[4]}) & {_M})", 11)} * {_P[0]}) & {_M}) AS h FROM fours),
spread1 AS (SELECT g, (xor(h, h >> 33) * {_P[1]}) & {_M} AS h FROM ones),
spread2 AS (SELECT g, (xor(h, h >> 29) * {_P[2]}) & {_M} AS h FROM spread1),
xxh AS (SELECT g, CAST(xor(h, h >> 32) AS UBIGINT) AS h FROM spread2)"""


SQL_SIMHASH = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) > 2 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
{_xxh64("s", 42)},
bits AS (SELECT doc_id, count(*) AS n, {", ".join(f"sum(CAST((h >> {k}) & 1 AS INTEGER)) AS b{k}" for k in range(64))}
  FROM s JOIN xxh USING (g) GROUP BY doc_id),
made AS (SELECT doc_id, {" + ".join(f"CASE WHEN 2 * b{k} > n THEN {1 << k}::UHUGEINT ELSE 0::UHUGEINT END" for k in range(64))} AS fp FROM bits),
prints AS (SELECT d.doc_id, CAST(coalesce(fp, 0::UHUGEINT) AS UBIGINT) AS fp FROM documents d LEFT JOIN made USING (doc_id)),
classes AS (SELECT fp, min(doc_id) AS id FROM prints GROUP BY fp),
links AS (SELECT x.id AS a, y.id AS b FROM classes x JOIN classes y ON x.id <> y.id AND bit_count(xor(x.fp, y.fp)) <= 2),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT p.doc_id, lower(lpad(to_hex(p.fp), 16, '0')) AS fingerprint, least(c.id, coalesce(r.component, c.id)) AS component_id
FROM prints p JOIN classes c ON c.fp = p.fp LEFT JOIN (SELECT a, min(b) AS component FROM reach GROUP BY 1) r ON r.a = c.id"""


@query("op12_simhash_dedup", SQL_SIMHASH)
def op12(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


SQL_TRIE = rf"""
WITH {CRC_TABLE},
own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
hashed AS (
  SELECT conv_id, t, CAST({_crc32(_bytes("CAST(conv_id AS VARCHAR)"))} % 4 AS INTEGER) AS h FROM own, crc_table),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.t, [])[1:h], a.t[h + 1:]) AS t
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
prefixes AS (SELECT conv_id, d, t[1:d] AS p, len(t) = d AS whole FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (whole), '')) AS ends_sha256,
         CASE WHEN d > 0 THEN len(regexp_extract_all(p[d].text, '{WORD}')) ELSE 0 END AS words
  FROM prefixes GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids ON kids.p = n.p),
sums AS (
  SELECT p[1:e] AS p, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums ON sums.p = n.p LEFT JOIN nodes u ON n.d > 0 AND u.p = n.p[1:n.d - 1]"""


@query("op13_conversation_trie", SQL_TRIE)
def op13(spark, sf):
    return prefix_trie.conversation_trie(table(spark, sf, "conversations"), shared=(20, 4))
