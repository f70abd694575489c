"""Values that must come through unrounded, groups of any size, keys that repeat."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import quantiles
from corpusmill.operators import align, explore, quality, repair
from corpusmill.sources import landed

BIG = 9007199254740993                     # not a double


@pytest.mark.parametrize("direct", [5_000_000, 10])
def test_ranks_keep_big_integers_and_decimals(spark, monkeypatch, direct):
    monkeypatch.setattr(quantiles, "RANK_DIRECTLY", direct)
    longs = [BIG + i for i in range(41)]
    df = spark.createDataFrame([(v, Decimal(v) / 100, i / 7) for i, v in enumerate(longs)], "n long, d decimal(30,2), x double")
    got = quantiles.exact_quantiles(df.repartition(3), ["n", "d", "x"], [0.25, 0.5, 0.9875], exact=True)
    assert got["n"].values == (BIG + 10, BIG + 20, Decimal(BIG + 39) + Decimal("0.5"))
    assert got["d"].values[1] == Decimal(BIG + 20) / 100
    assert got["x"].values == pytest.approx(np.quantile([i / 7 for i in range(41)], [0.25, 0.5, 0.9875]))


def test_fill_keeps_big_integers(spark):
    df = spark.createDataFrame([(1, BIG, Decimal("1.10"), 1.5, 3), (2, None, None, None, None), (3, BIG + 3, Decimal("1.20"), 2.5, 4)],
                               "id long, n long, d decimal(6,2), x double, i int")
    out = repair.fill_missing(df, "id").orderBy("id").collect()
    assert [r.n for r in out] == [BIG, BIG + Decimal("1.5"), BIG + 3]
    assert [r.d for r in out] == [Decimal("1.10"), Decimal("1.150"), Decimal("1.20")]
    assert [r.x for r in out] == [1.5, 2.0, 2.5] and [r.i for r in out] == [3, Decimal("3.5"), 4]


def test_one_schema_whatever_the_data(spark):
    schema = "id long, n long, i int, d decimal(6,2), x double, text string"
    few = spark.createDataFrame([(1, BIG, 1, Decimal(1), 1.0, "a")], schema)
    many = spark.createDataFrame([(i, BIG + i, i, Decimal(i), float(i), "a") for i in range(40)], schema)
    gaps = many.unionByName(spark.createDataFrame([(99, None, None, None, None, None)], schema))
    for how in ({"missing": "fill", "duplicates": "none", "outliers": "none"},
                {"missing": "none", "duplicates": "none", "outliers": "clip_iqr"},
                {"missing": "fill", "duplicates": "none", "outliers": "clip_iqr"}):
        assert len({repair.fix(df, how, "id").schema.simpleString() for df in (few, many, gaps, many.limit(0))}) == 1
    clipped = repair.fix_outliers(many.unionByName(spark.createDataFrame([(50, 0, 0, Decimal(0), 0.0, "a")], schema)), "clip_iqr", "id")
    assert {r.n for r in clipped.where("id < 40").collect()} == {BIG + i for i in range(40)}
    low = clipped.where("id = 50").head().n
    q = sorted([0] + [BIG + i for i in range(40)])
    assert low == q[10] - Decimal("1.5") * (q[30] - q[10])


def test_repair_needs_a_unique_key(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "x")], "row_id int, text string, label string")
    with pytest.raises(ValueError, match="unique"):
        repair.fix(df, "balanced", "row_id")


def test_align_checks_keys(spark):
    twice = spark.createDataFrame([(1, 2), (1, 3)], "id int, v int")
    parts = {"a": twice, "b": twice}
    with pytest.raises(ValueError, match="unique"):
        align.align(parts)
    assert align.align(parts, repeated_keys="multiply").count() == 4
    with pytest.raises(ValueError):
        align.align(parts, repeated_keys="drop")


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_group_quantiles_equal_numpy(spark, by):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["b", None, "one"]), rng.randint(0, 1), rng.choice([None, *range(50)])) for _ in range(900)]
    rows += [("single", 0, 7), ("none", 0, None)]
    df = spark.createDataFrame(rows, "g string, h int, `odd v` int").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = quantiles.group_quantiles(df, by, "odd v", [0.0, 0.1, 0.5, 0.95, 1.0]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for g, h, v in rows:
        if v is not None:
            want.setdefault((g, h)[:len(by)], []).append(v)
    assert {tuple(r)[:len(by)] for r in out} == set(want) and len(out) == len(want)
    for r in out:
        values = want[tuple(r)[:len(by)]]
        assert r.n == len(values) and r.q == pytest.approx(np.quantile(values, [0.0, 0.1, 0.5, 0.95, 1.0]))


def test_group_quantiles_of_weights_and_nothing(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("a", 10, 6)], "g string, v int, n long")
    (row,) = quantiles.group_quantiles(df, ["g"], "v", [0.25, 0.5], weight="n").collect()
    assert row.n == 10 and row.q == pytest.approx(np.quantile([1] * 3 + [2] + [10] * 6, [0.25, 0.5]))
    assert quantiles.group_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0
    assert quantiles.group_quantiles(df.limit(0), [], "v", [0.5]).count() == 0


def test_reports_of_empty_tables(spark):
    df = spark.createDataFrame([], "row_id int, text string, label string, source string")
    (row,) = quality.quality_stats(df, "row_id").collect()
    assert row.rows == row.duplicates == row.outlier_rows == 0 and row.median_text_len is None and row.n_classes is None
    assert explore.box_stats(df.withColumn("n", F.length("text")), "n", "label").count() == 0
    assert {r.metric for r in explore.eda_summary(df).collect()} >= {"total_rows", "text_len_median"}
    assert quality.profile(df, "row_id").where("metric = 'text_len' and name = 'p95'").head().value is None


def test_correlations_by_co_moments(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) * [1, 1e-3, 50, 1] + [1e9, 5, -2, 0]
    x[:, 3] = x[:, 0] * 2 + rng.normal(size=300)
    x[rng.random((300, 4)) < 0.2] = np.nan
    rows = [(*map(float, r), 7.0, None) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, same double, none double").repartition(5)
    got = {(r.f1, r.f2): r.r for r in align.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 36
    for i, f in enumerate("abcd"):
        for j, g in enumerate("abcd"):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[f, g] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-4)
        assert got[f, "same"] is None and got["none", f] is None and got["same", "same"] is None
    assert align.correlation_matrix(df.limit(0), ["a", "b"]).where("r IS NOT NULL").count() == 0


@pytest.mark.parametrize("hot", [1_000_000, 3])
def test_members_of_large_and_small_groups(spark, monkeypatch, hot):
    monkeypatch.setattr(quality, "HOT_MEMBERS", hot)
    texts = ["same"] * 20 + [None] * 2 + ["two", "two", "one", ""]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, text string, `a b` string").repartition(3)
    got = {r.id: r.group_size for r in quality.duplicated_members(df, "text", "id").collect()}
    assert got == {i: texts.count(t) for i, t in enumerate(texts) if texts.count(t) > 1}


def test_rows_of_a_folder_follow_file_names(spark, tmp_path):
    """However files are packed: the largest file comes last by name and first by size."""
    for name, n in (("a.csv", 3), ("b.csv", 1), ("c.csv", 4000)):
        (tmp_path / name).write_text("text,label\n" + "".join(f"{name}-{i:05d} {'x' * 40},1\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = landed.read_csv_in_order(spark, [str(tmp_path)])
        got = [r.text.split()[0] for r in landed.capped_concat(rows, 1500).orderBy(*landed.FILE_ORDER).collect()]
        assert rows.rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"a.csv-{i:05d}" for i in range(3)] + ["b.csv-00000"] + [f"c.csv-{i:05d}" for i in range(1496)]


@pytest.mark.parametrize("body, plain", [
    ('a,b\n1,"x ""q"" y"\n\n2,z\n', True), ('a,b\n1,"x\ny"\n2,z\n', False), ('a,b\n1,"x"\n \n2,z\n', False),
    ('a,b\r\n1,"x, y"\r\n2,"z"\r\n', True), ("a,b\n", True), ('a,b\n1,"x\r2"\n', False)])
def test_lines_or_whole_files_give_equal_rows(spark, tmp_path, body, plain):
    (tmp_path / "f.csv").write_bytes(body.encode())
    path = str(tmp_path / "f.csv")
    assert landed.lines_are_records(spark, path) is plain
    a, b = ([tuple(r) for r in landed.read_csv(spark, path, **o).collect()] for o in ({}, {"multiLine": True}))
    assert a == b
