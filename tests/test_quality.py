"""Quality and repair on small frames with every awkward case."""

import math

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import quality, repair
from corpusmill.schema import is_missing, label_role, nan_to_null, numeric_columns, text_role

NAN = float("nan")


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.fixture()
def messy(spark):
    return spark.createDataFrame([
        (1, "aa", "pos", 1.0), (2, "aa", "pos", 2.0), (3, None, "neg", NAN), (4, "bbbb", None, None),
        (5, "cc", "pos", 3.0), (6, "aa", "neg", 4.0), (7, None, "neg", 1000.0), (8, "d" * 90, "pos", 2.5)],
        "row_id int, text string, label string, v double")


def test_roles(spark, messy):
    assert (text_role(messy), label_role(messy)) == ("text", "label")
    other = spark.createDataFrame([("a", "b", True, 1)], "review string, target string, flag boolean, n int")
    assert (text_role(other), label_role(other)) == ("review", "target")
    assert numeric_columns(other) == ["n"]


def test_missing_counts_nan_and_null(messy):
    got = rows_of(quality.missing_profile(messy, key="row_id"), "column", "count", "pct")
    assert got == [("label", 1, 12.5), ("text", 2, 25.0), ("v", 2, 25.0)]
    assert quality.missing_cells(messy, key="row_id").head()[0] == 5
    only = quality.missing_profile(messy.select("row_id"), only_missing=True)
    assert only.count() == 0


def test_duplicates_count_rows_with_nulls(spark):
    df = spark.createDataFrame([("a", None)] * 3 + [(None, None)] * 2 + [("a", "b")], "x string, y string")
    assert quality.duplicate_rows(df).head()[0] == 3
    assert quality.duplicate_rows(df.limit(0)).head()[0] == 0


def test_duplicated_members_lists_whole_groups(messy):
    got = rows_of(quality.duplicated_members(messy, "text", "row_id"), "row_id", "group_size")
    assert got == [(1, 3), (2, 3), (3, 2), (6, 3), (7, 2)]


def test_outliers_skip_short_and_constant_columns(spark):
    df = spark.createDataFrame([(i, 5.0, float(i) if i < 3 else None) for i in range(10)],
                               "row_id int, flat double, few double")
    assert quality.iqr_outliers(df, key="row_id").count() == 0


def test_outlier_bounds(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 9)] + [(9, 100.0)], "row_id int, v double")
    assert rows_of(quality.iqr_outliers(df, key="row_id"), "column", "count", "lower", "upper") == [
        ("v", 1, -3.0, 13.0)]


def test_imbalance_ties_and_single_class(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "label string")
    assert tuple(quality.imbalance(df).head()) == (1.0, "a", "b", 2)
    assert quality.imbalance(df.where("label = 'a'")).count() == 0


def test_detect_issues_of_an_empty_table(messy):
    found = quality.detect_issues(messy.limit(0), "row_id").collect()
    assert [(r.issue, r.value) for r in found] == [("duplicates", 0.0)]


def test_stats_of_an_empty_table(messy):
    row = quality.quality_stats(messy.limit(0), "row_id").head()
    assert (row.rows, row.missing_count, row.duplicates, row.median_text_len) == (0, 0, 0, None)
    compared = {r.metric: r for r in quality.compare(messy.limit(0), messy.limit(0), "row_id").collect()}
    assert compared["rows_removed_pct"].after is None


def test_stats(messy):
    row = quality.quality_stats(messy, "row_id").head()
    assert (row.rows, row.missing_count, row.duplicates) == (8, 5, 0)
    assert (row.imbalance_ratio, row.n_classes, row.median_text_len) == (1.333, 2, 2)


def test_verdict(spark):
    df = spark.createDataFrame([(2, 1), (1, 1), (1, 2)], "b int, a int")
    assert [r[0] for r in df.select(quality.verdict(F.col("b"), F.col("a"))).collect()] == [
        "improved", "—", "increased"]


def test_fix_drop_dedup(messy):
    out = repair.fix(messy, {"missing": "drop", "duplicates": "drop", "outliers": "keep"})
    assert rows_of(out, "row_id") == [(1,), (5,), (6,), (8,)]


def test_fix_is_idempotent_and_order_free(messy):
    once = repair.fix(messy, "aggressive")
    assert rows_of(repair.fix(once, "conservative"), "row_id") == rows_of(once, "row_id")
    shuffled = messy.orderBy(F.desc("row_id")).repartition(5)
    assert rows_of(repair.fix(shuffled, "aggressive"), "row_id") == rows_of(once, "row_id")


def test_fix_fill_uses_medians_and_marker(messy):
    out = {r.row_id: r for r in repair.fix(
        messy, {"missing": "median", "duplicates": "none", "outliers": "keep"}).collect()}
    assert out[3].text == "[missing]" and out[3].v == 2.75 and out[4].label is None
    assert not any(math.isnan(r.v) for r in out.values())


def test_clip_changes_numbers_not_text(spark):
    df = spark.createDataFrame([(i, "t" * i, "l", float(i)) for i in range(1, 9)] + [(9, "t" * 900, "l", 100.0)],
                               "row_id int, text string, label string, v double")
    out = {r.row_id: r for r in repair.fix(df, "balanced").collect()}
    assert out[9].v == 13.0 and len(out[9].text) == 900 and len(out) == 9


def test_zscore_and_iqr_drop_keep_nulls(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(200)] + [(200, 1e6), (201, None)],
                               "row_id int, v double")
    for how in ("drop", "zscore_drop"):
        ids = {r.row_id for r in repair.fix(
            df, {"missing": "keep", "duplicates": "none", "outliers": how}).collect()}
        assert 200 not in ids and 201 in ids and len(ids) == 201


def test_strategies(messy):
    assert repair.strategy_of('{"missing": "fill"}') == {"missing": "fill"}
    report = {r.step: r for r in repair.fix_report(messy, "aggressive").collect()}
    assert [report[s].rows for s in ("input", "missing", "duplicates")] == [8, 5, 4]
    assert report["outliers"].small_result


def test_missing_boundary(messy):
    assert nan_to_null(messy).where("v is null").count() == 2
    assert messy.where(is_missing(messy, "v")).count() == 2
