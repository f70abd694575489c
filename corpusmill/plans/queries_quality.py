"""Quality: missing, duplicates, outliers, imbalance, repair, comparison."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators import quality, repair
from corpusmill.plans.registry import CORPUS, UNIFIED, corpus, query, table

CONTENT = ["text", "audio", "image", "label", "source", "collected_at"]


def _missing_sql(columns, digits=2):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS count, "
        f"round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), {digits}) AS pct FROM corpus"
        for c in columns)


@query("missing_profile", f"WITH {CORPUS} {_missing_sql(CONTENT)}")
def missing_profile(spark, sf):
    return quality.missing_profile(corpus(spark, sf), key="row_id")


@query("missing_cells", f"""
WITH {CORPUS} SELECT CAST(sum({' + '.join(f'CAST({c} IS NULL AS INT)' for c in CONTENT)}) AS BIGINT)
       AS missing_cells FROM corpus""")
def missing_cells(spark, sf):
    return quality.missing_cells(corpus(spark, sf), key="row_id")


@query("rows_with_missing", f"""
WITH {CORPUS} SELECT count(*) AS rows, count(*) FILTER (text IS NOT NULL AND label IS NOT NULL) AS complete,
  count(*) FILTER (text IS NULL OR label IS NULL) AS with_missing FROM corpus""")
def rows_with_missing(spark, sf):
    return quality.rows_with_missing(corpus(spark, sf), ["text", "label"])


@query("missing_matrix", f"""
WITH {CORPUS} SELECT row_id, {', '.join(f'CAST({c} IS NULL AS INT) AS {c}' for c in CONTENT)} FROM corpus""")
def missing_matrix(spark, sf):
    return quality.missing_matrix(corpus(spark, sf), "row_id")


@query("dup_exact", f"""
WITH {CORPUS}, g AS (SELECT count(*) AS n FROM corpus GROUP BY {', '.join(CONTENT)})
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM g""")
def dup_exact(spark, sf):
    return quality.duplicate_rows(corpus(spark, sf), key="row_id")


@query("dup_text", """
SELECT CAST(count(*) - count(DISTINCT text) AS BIGINT) AS duplicates FROM documents""")
def dup_text(spark, sf):
    return quality.duplicate_rows(table(spark, sf, "documents"), ["text"])


@query("dup_text_members", f"""
WITH {CORPUS} SELECT row_id, source, text, group_size FROM (
  SELECT *, count(*) OVER (PARTITION BY text) AS group_size FROM corpus) WHERE group_size > 1""")
def dup_text_members(spark, sf):
    return quality.duplicated_members(corpus(spark, sf), "text", "row_id").select(
        "row_id", "source", "text", "group_size")


def _iqr_sql(relation, columns):
    """columns: output name -> expression."""
    return " UNION ALL ".join(f"""
SELECT "column", count(*) FILTER (v < lower OR v > upper) AS count,
       round(any_value(lower), 2) AS lower, round(any_value(upper), 2) AS upper
FROM (SELECT '{n}' AS "column", v, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper, nn
      FROM (SELECT CAST({e} AS DOUBLE) AS v FROM {relation}),
           (SELECT quantile_cont(CAST({e} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({e} AS DOUBLE), 0.75) AS q3,
                   count({e}) AS nn FROM {relation}) WHERE q3 <> q1 AND nn >= 4)
GROUP BY "column" HAVING count(*) FILTER (v < lower OR v > upper) > 0""" for n, e in columns.items())


LINEITEM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("iqr_outliers", f"WITH {CORPUS} {_iqr_sql('corpus', {'_text_len': 'length(text)', 'n_chars': 'n_chars', 'toxic': 'toxic'})}")
def iqr_outliers(spark, sf):
    return quality.iqr_outliers(corpus(spark, sf, ["n_chars", "toxic"]), key="row_id")


@query("iqr_outliers_lineitem", _iqr_sql("lineitem", {c: c for c in LINEITEM}))
def iqr_outliers_lineitem(spark, sf):
    return quality.iqr_outliers(table(spark, sf, "lineitem"), LINEITEM)


@query("iqr_outliers_events", _iqr_sql("events", {"value": "value"}))
def iqr_outliers_events(spark, sf):
    return quality.iqr_outliers(table(spark, sf, "events"), ["value"])


@query("iqr_outliers_part", _iqr_sql("part", {"p_size": "p_size", "p_retailprice": "p_retailprice"}))
def iqr_outliers_part(spark, sf):
    return quality.iqr_outliers(table(spark, sf, "part"), ["p_size", "p_retailprice"])


def _z_sql(relation, columns):
    return " UNION ALL ".join(f"""
SELECT '{n}' AS "column", count(*) FILTER (abs((CAST({e} AS DOUBLE) - m) / s) > 3) AS count,
       round(any_value(m), 4) AS mean, round(any_value(s), 4) AS std
FROM {relation}, (SELECT avg(CAST({e} AS DOUBLE)) AS m, stddev_samp(CAST({e} AS DOUBLE)) AS s FROM {relation})"""
                              for n, e in columns.items())


def _z(df):
    return df.select("column", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


def _all_fences(sql):
    """Columns without an outlier as well."""
    return sql.replace("HAVING count(*) FILTER (v < lower OR v > upper) > 0", "")


@query("iqr_fences_lineitem", _all_fences(_iqr_sql("lineitem", {c: c for c in LINEITEM})))
def iqr_fences_lineitem(spark, sf):
    return quality.iqr_outliers(table(spark, sf, "lineitem"), LINEITEM, only_found=False)


@query("iqr_fences_part", _all_fences(_iqr_sql("part", {"p_size": "p_size", "p_retailprice": "p_retailprice"})))
def iqr_fences_part(spark, sf):
    return quality.iqr_outliers(table(spark, sf, "part"), ["p_size", "p_retailprice"], only_found=False)



@query("zscore_outliers", f"WITH {CORPUS} {_z_sql('corpus', {'_text_len': 'length(text)'})}")
def zscore_outliers(spark, sf):
    return _z(quality.zscore_outliers(corpus(spark, sf), ["_text_len"]))


@query("zscore_outliers_events", _z_sql("events", {"value": "value"}))
def zscore_outliers_events(spark, sf):
    return _z(quality.zscore_outliers(table(spark, sf, "events"), ["value"]))


IMBALANCE = """SELECT round(max(n) / min(n), 3) AS ratio, arg_min(label, (-n, label)) AS majority,
  arg_max(label, (-n, label)) AS minority, count(*) AS n_classes FROM counts HAVING count(*) >= 2"""


@query("imbalance", f"""
WITH {CORPUS}, counts AS (SELECT label, CAST(count(*) AS DOUBLE) AS n FROM corpus WHERE label IS NOT NULL
GROUP BY label) {IMBALANCE}""")
def imbalance(spark, sf):
    return quality.imbalance(corpus(spark, sf))


@query("imbalance_segments", f"""
WITH counts AS (SELECT c_mktsegment AS label, CAST(count(*) AS DOUBLE) AS n FROM customer GROUP BY 1) {IMBALANCE}""")
def imbalance_segments(spark, sf):
    return quality.imbalance(table(spark, sf, "customer"), "c_mktsegment")


@query("label_distribution", f"""
WITH {CORPUS} SELECT label AS value, count(*) AS n,
  round(100.0 * count(*) / (SELECT count(*) FROM corpus), 1) AS pct
FROM corpus WHERE label IS NOT NULL GROUP BY label""")
def label_distribution(spark, sf):
    return quality.value_counts(corpus(spark, sf), "label")


STATS = """SELECT count(*) AS rows,
  CAST(sum({missing}) AS DOUBLE) AS missing_count,
  (SELECT CAST(sum(n - 1) AS DOUBLE) FROM (SELECT count(*) AS n FROM {t} GROUP BY {cols})) AS duplicates,
  (SELECT CAST(count(*) AS DOUBLE) FROM {t}, (SELECT quantile_cont(length(text), 0.25) AS q1,
     quantile_cont(length(text), 0.75) AS q3 FROM {t})
   WHERE q3 > q1 AND (length(text) < q1 - 1.5 * (q3 - q1) OR length(text) > q3 + 1.5 * (q3 - q1))) AS outlier_rows,
  (SELECT round(max(n) / min(n), 3) FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM {t} WHERE label IS NOT NULL
     GROUP BY label)) AS imbalance_ratio,
  CAST(count(DISTINCT label) AS DOUBLE) AS n_classes,
  floor(quantile_cont(length(text), 0.5)) AS median_text_len,
  round(avg(length(text)), 1) AS mean_text_len
FROM {t}"""
METRICS = ("rows", "missing_count", "duplicates", "outlier_rows", "imbalance_ratio", "n_classes",
           "median_text_len", "mean_text_len")


def _stats_sql(t, columns):
    return STATS.format(t=t, cols=", ".join(columns),
                        missing=" + ".join(f"CAST({c} IS NULL AS INT)" for c in columns))


# -- repair: each step of the strategy as SQL over `corpus` ------------------------

NUM = ["text", "label", "source", "n_chars", "toxic"]


def _repair_sql(missing, outliers, name="fixed"):
    """CTEs m (missing), d (duplicates) and the final relation."""
    if missing == "drop":
        m = "m AS (SELECT row_id, text, label, source, n_chars, toxic FROM corpus WHERE text IS NOT NULL AND label IS NOT NULL)"
    else:
        m = """m AS (SELECT row_id, coalesce(text, '[missing]') AS text, label, source,
  coalesce(CAST(n_chars AS DOUBLE), (SELECT median(n_chars) FROM corpus)) AS n_chars,
  coalesce(CAST(toxic AS DOUBLE), (SELECT median(toxic) FROM corpus)) AS toxic FROM corpus)"""
    d = """d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY text, label
  ORDER BY row_id) AS rn FROM m) WHERE rn = 1)"""
    exprs = {"len": "length(text)", "n_chars": "n_chars", "toxic": "toxic"}
    b = "b AS (SELECT " + ", ".join(
        f"quantile_cont({e}, 0.25) AS {n}_q1, quantile_cont({e}, 0.75) AS {n}_q3, avg({e}) AS {n}_m, "
        f"stddev_samp({e}) AS {n}_s" for n, e in exprs.items()) + " FROM d)"
    lo = {n: f"{n}_q1 - 1.5 * ({n}_q3 - {n}_q1)" for n in exprs}
    up = {n: f"{n}_q3 + 1.5 * ({n}_q3 - {n}_q1)" for n in exprs}
    cols = "d.*"
    where = ""
    if outliers == "clip_iqr":
        cols = "row_id, text, label, source, " + ", ".join(
            f"CASE WHEN {n}_q3 = {n}_q1 THEN CAST({n} AS DOUBLE) WHEN {n} IS NULL THEN NULL "
            f"ELSE least(greatest(CAST({n} AS DOUBLE), {lo[n]}), {up[n]}) END AS {n}"
            for n in ("n_chars", "toxic"))
    elif outliers == "drop":
        where = "WHERE " + " AND ".join(
            f"({n}_q3 = {n}_q1 OR {e} IS NULL OR {e} BETWEEN {lo[n]} AND {up[n]})" for n, e in exprs.items())
    elif outliers == "zscore_drop":
        where = "WHERE " + " AND ".join(
            f"({n}_q3 = {n}_q1 OR {e} IS NULL OR abs(({e} - {n}_m) / ({n}_s + 1e-9)) <= 3)"
            for n, e in exprs.items())
    return f"{m}, {d}, {b}, {name} AS (SELECT {cols} FROM d, b {where})"


def _plain(df):
    """Exact decimals as doubles, which is what the SQL twins return."""
    return df.select([F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                      for f in df.schema.fields])


def _fix(strategy):
    return lambda spark, sf: _plain(repair.fix(_wide(spark, sf), strategy, "row_id"))


def _wide(spark, sf):
    return corpus(spark, sf, ["n_chars", "toxic"]).select("row_id", *NUM)


STRATEGIES = {
    "fix_aggressive": "aggressive", "fix_conservative": "conservative", "fix_balanced": "balanced",
    "fix_zscore": {"missing": "drop", "duplicates": "drop", "outliers": "zscore_drop"},
    "fix_median": {"missing": "median", "duplicates": "drop", "outliers": "clip_iqr"},
}
for _name, _strategy in STRATEGIES.items():
    _s = repair.strategy_of(_strategy)
    query(_name, f"WITH {CORPUS}, {_repair_sql(_s['missing'], _s['outliers'])} SELECT * FROM fixed")(
        _fix(_strategy))


@query("fix_orders_drop", """
WITH b AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders, b
WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def fix_orders_drop(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return repair.fix(orders, {"missing": "drop", "duplicates": "none", "outliers": "drop"}, "o_orderkey")


@query("fix_events_clip", """
WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, event_type, round(least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 4) AS value
FROM events, b""")
def fix_events_clip(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    out = repair.fix(events, {"missing": "drop", "duplicates": "none", "outliers": "clip_iqr"}, "event_id")
    return out.withColumn("value", F.round("value", 4))


BIG = 9007199254740993                     # the first integer that no double holds


@query("fix_big_numbers", f"""
WITH n AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey + {BIG} END AS big,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(20, 2)) END AS price FROM orders),
b AS (SELECT big, row_number() OVER (ORDER BY big) AS i, count(*) OVER () AS k FROM n WHERE big IS NOT NULL),
p AS (SELECT price, row_number() OVER (ORDER BY price) AS i, count(*) OVER () AS k FROM n WHERE price IS NOT NULL),
m AS (SELECT
  (SELECT CASE WHEN count(*) = 1 THEN max(big) * 10 ELSE sum(big) * 5 END FROM b WHERE i IN ((k + 1) // 2, (k + 2) // 2)) AS tenths,
  (SELECT CASE WHEN count(*) = 1 THEN max(price) * 2 ELSE sum(price) END FROM p WHERE i IN ((k + 1) // 2, (k + 2) // 2)) AS twice)
SELECT o_orderkey, coalesce(CAST(big AS VARCHAR) || '.0', CAST(tenths // 10 AS VARCHAR) || '.' || CAST(tenths % 10 AS VARCHAR)) AS big,
       CAST(coalesce(CAST(price AS DECIMAL(24, 3)), CAST(twice * 0.5 AS DECIMAL(24, 3))) AS VARCHAR) AS price FROM n, m""")
def fix_big_numbers(spark, sf):
    """Medians of integers and decimals beyond the precision of a double, as text."""
    known = F.col("o_orderpriority") != "5-LOW"
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(known, F.col("o_custkey") + F.lit(BIG)).alias("big"),
        F.when(known, F.col("o_totalprice").cast("decimal(20,2)")).alias("price"))
    out = repair.fix(orders, {"missing": "fill", "duplicates": "none", "outliers": "none"}, "o_orderkey")
    return out.select("o_orderkey", F.col("big").cast("string").alias("big"), F.col("price").cast("string").alias("price"))


@query("clip_big_numbers", f"""
WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey * l_partkey + {BIG} AS big FROM lineitem),
r AS (SELECT big, row_number() OVER (ORDER BY big) - 1 AS i, count(*) OVER () AS k FROM n),
q AS (SELECT
  (SELECT min(big) FILTER (i = (k - 1) // 4) * (4 - any_value((k - 1) % 4)) + min(big) FILTER (i = (k + 2) // 4) * any_value((k - 1) % 4) FROM r) AS q1,
  (SELECT min(big) FILTER (i = (3 * (k - 1)) // 4) * (4 - any_value((3 * (k - 1)) % 4))
     + min(big) FILTER (i = (3 * (k - 1) + 3) // 4) * any_value((3 * (k - 1)) % 4) FROM r) AS q3),
f AS (SELECT 5 * q1 - 3 * q3 AS low, 5 * q3 - 3 * q1 AS high FROM q),
c AS (SELECT l_orderkey, l_linenumber, least(greatest(CAST(big AS HUGEINT) * 8, low), high) AS eighths FROM n, f)
SELECT l_orderkey, l_linenumber, CAST(eighths // 8 AS VARCHAR) || '.' || lpad(CAST(eighths % 8 * 125 AS VARCHAR), 3, '0') AS big FROM c""")
def clip_big_numbers(spark, sf):
    """Fences of integers beyond the precision of a double, as text."""
    lines = table(spark, sf, "lineitem").select(
        F.struct("l_orderkey", "l_linenumber").alias("line"), (F.col("l_partkey") * F.col("l_partkey") + F.lit(BIG)).alias("big"))
    out = repair.fix(lines, {"missing": "none", "duplicates": "none", "outliers": "clip_iqr"}, "line")
    return out.select("line.l_orderkey", "line.l_linenumber", F.col("big").cast("string").alias("big"))


@query("fix_report", f"""
WITH {CORPUS}, {_repair_sql('drop', 'drop')},
c AS (SELECT (SELECT count(*) FROM corpus) AS n0, (SELECT count(*) FROM m) AS n1,
             (SELECT count(*) FROM d) AS n2, (SELECT count(*) FROM fixed) AS n3)
SELECT 'input' AS step, n0 AS rows, 0 AS removed, n0 < 100 AS small_result FROM c
UNION ALL SELECT 'missing', n1, n0 - n1, n1 < 100 FROM c
UNION ALL SELECT 'duplicates', n2, n1 - n2, n2 < 100 FROM c
UNION ALL SELECT 'outliers', n3, n2 - n3, n3 < 100 FROM c""")
def fix_report(spark, sf):
    return repair.fix_report(_wide(spark, sf), "aggressive", "row_id")


def _unpivot(relation, name):
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS {name} FROM {relation}" for m in METRICS)


@query("compare_quality", f"""
WITH {CORPUS}, {_repair_sql('drop', 'drop')},
sb AS ({_stats_sql('corpus', NUM)}), sa AS ({_stats_sql('fixed', NUM)}),
bb AS ({_unpivot('sb', 'before')}), aa AS ({_unpivot('sa', 'after')})
SELECT metric, before, after, CASE WHEN after < before THEN 'improved' WHEN after = before THEN '—'
  WHEN after > before THEN 'increased' END AS change FROM bb JOIN aa USING (metric)
UNION ALL SELECT 'rows_removed', NULL, CAST(sb.rows - sa.rows AS DOUBLE), NULL FROM sb, sa
UNION ALL SELECT 'rows_removed_pct', NULL, round(100.0 * (sb.rows - sa.rows) / sb.rows, 1), NULL FROM sb, sa""")
def compare_quality(spark, sf):
    wide = _wide(spark, sf)
    return quality.compare(wide, repair.fix(wide, "aggressive", "row_id"), "row_id")


@query("compare_strategies", f"""
WITH {CORPUS}, base AS (SELECT row_id, {', '.join(NUM)} FROM corpus),
a AS (WITH {_repair_sql('drop', 'drop')} SELECT * FROM fixed),
b AS (WITH {_repair_sql('fill', 'clip_iqr')} SELECT * FROM fixed),
s0 AS ({_stats_sql('base', NUM)}), s1 AS ({_stats_sql('a', NUM)}), s2 AS ({_stats_sql('b', NUM)}),
l0 AS ({_unpivot('s0', 'before')}), l1 AS ({_unpivot('s1', 'drop_all')}), l2 AS ({_unpivot('s2', 'fill_clip')})
SELECT metric, before, drop_all, fill_clip FROM l0 JOIN l1 USING (metric) JOIN l2 USING (metric)""")
def compare_strategies(spark, sf):
    wide = _wide(spark, sf)
    fill = {"missing": "fill", "duplicates": "keep_first", "outliers": "clip_iqr"}
    return quality.compare_strategies(wide, {
        "drop_all": repair.fix(wide, "aggressive", "row_id"),
        "fill_clip": repair.fix(wide, fill, "row_id")}, "row_id")


@query("profile", f"""
WITH {CORPUS}, t AS (SELECT length(text) AS n FROM corpus)
SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS name, CAST(count(*) AS DOUBLE) AS value FROM corpus
UNION ALL SELECT 'columns', NULL, 6.0
UNION ALL SELECT 'nulls', "column", CAST(count AS DOUBLE) FROM ({_missing_sql(CONTENT)})
UNION ALL SELECT 'duplicates', NULL, CAST(sum(n - 1) AS DOUBLE)
  FROM (SELECT count(*) AS n FROM corpus GROUP BY {', '.join(CONTENT)})
UNION ALL SELECT 'text_len', 'min', CAST(min(n) AS DOUBLE) FROM t
UNION ALL SELECT 'text_len', 'mean', round(avg(n), 0) FROM t
UNION ALL SELECT 'text_len', 'max', CAST(max(n) AS DOUBLE) FROM t
UNION ALL SELECT 'text_len', 'p95', round(quantile_cont(n, 0.95), 0) FROM t
UNION ALL SELECT 'label', label, CAST(count(*) AS DOUBLE) FROM corpus WHERE label IS NOT NULL GROUP BY label""")
def profile(spark, sf):
    return quality.profile(corpus(spark, sf), "row_id")


def _describe_sql(relation, columns):
    return " UNION ALL ".join(f"""
SELECT '{n}' AS "column", count({e}) AS count, round(avg({e}), 1) AS mean, round(stddev_samp({e}), 1) AS std,
  round(CAST(min({e}) AS DOUBLE), 1) AS min, round(quantile_cont(CAST({e} AS DOUBLE), 0.25), 1) AS q25,
  round(quantile_cont(CAST({e} AS DOUBLE), 0.5), 1) AS median,
  round(quantile_cont(CAST({e} AS DOUBLE), 0.75), 1) AS q75, round(CAST(max({e}) AS DOUBLE), 1) AS max
FROM {relation}""" for n, e in columns.items())


WORDS = r"len(regexp_extract_all(text, '[^\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'))"


@query("describe_len", f"WITH {CORPUS} {_describe_sql('corpus', {'text_len': 'length(text)', 'word_count': WORDS})}")
def describe_len(spark, sf):
    from corpusmill.operators.explore import text_features
    lengths = ["text_len", "word_count"]
    return quality.describe(text_features(corpus(spark, sf), "row_id"), lengths, narrow=lengths)


@query("describe_lineitem", _describe_sql("lineitem", {c: c for c in LINEITEM}))
def describe_lineitem(spark, sf):
    return quality.describe(table(spark, sf, "lineitem"), LINEITEM)


@query("detect_issues", f"""
WITH {CORPUS}, miss AS ({_missing_sql(NUM)}),
outl AS ({_iqr_sql('corpus', {'_text_len': 'length(text)', 'n_chars': 'n_chars', 'toxic': 'toxic'})}),
counts AS (SELECT label, CAST(count(*) AS DOUBLE) AS n FROM corpus WHERE label IS NOT NULL GROUP BY label),
imb AS ({IMBALANCE})
SELECT 'missing' AS issue, "column", 'count' AS metric, CAST(count AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS name
FROM miss WHERE count > 0
UNION ALL SELECT 'missing', "column", 'pct', pct, NULL FROM miss WHERE count > 0
UNION ALL SELECT 'duplicates', NULL, 'count', CAST(sum(n - 1) AS DOUBLE), NULL
  FROM (SELECT count(*) AS n FROM corpus GROUP BY {', '.join(NUM)})
UNION ALL SELECT 'outliers', "column", 'count', CAST(count AS DOUBLE), NULL FROM outl
UNION ALL SELECT 'outliers', "column", 'lower', lower, NULL FROM outl
UNION ALL SELECT 'outliers', "column", 'upper', upper, NULL FROM outl
UNION ALL SELECT 'imbalance', 'label', 'ratio', ratio, NULL FROM imb
UNION ALL SELECT 'imbalance', 'label', 'majority', NULL, majority FROM imb
UNION ALL SELECT 'imbalance', 'label', 'minority', NULL, minority FROM imb
UNION ALL SELECT 'imbalance', 'label', 'count', n, label FROM counts WHERE (SELECT count(*) FROM imb) > 0""")
def detect_issues(spark, sf):
    return quality.detect_issues(_wide(spark, sf), "row_id")
