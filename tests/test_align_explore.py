"""Alignment, description, histograms and word counts on small frames."""

import numpy as np
import pytest

from corpusmill.operators import align, explore


@pytest.fixture()
def parts(spark):
    text = spark.createDataFrame([(1, "pos", 10.0), (2, "neg", 20.0)], "id int, label string, text_len double")
    image = spark.createDataFrame([(2, "neg", .5), (3, "pos", float("nan"))], "id int, label string, img_std double")
    return {"text": text, "image": image}


def test_inner_outer_and_shared(parts):
    inner = align.align(parts)
    assert inner.columns == ["id", "label", "text__text_len", "image__img_std"] and inner.count() == 1
    outer = {r.id: r.label for r in align.align(parts, how="outer").collect()}
    assert outer == {1: "pos", 2: "neg", 3: None}
    filled = {r.id: r.label for r in align.align(parts, how="outer", coalesce_shared=True).collect()}
    assert filled == {1: "pos", 2: "neg", 3: "pos"}
    assert align.align(parts, how="right").count() == 2


def test_coverage_counts_nan_as_missing(parts):
    got = {r.modality: r.coverage_pct for r in align.coverage(align.align(parts, how="outer")).collect()}
    assert got == {"text": 66.7, "image": 33.3}


def test_load_modality(spark, tmp_path):
    good, bad = str(tmp_path / "g"), str(tmp_path / "b")
    spark.createDataFrame([(1, "5", "x")], "id int, text_len string, note string").write.option("header", True).csv(good)
    spark.createDataFrame([(1,)], "key int").write.option("header", True).csv(bad)
    m = align.load_modality(spark, good, "text")
    assert m.features == ["text_len"] and m.df.head().text_len == 5.0
    with pytest.raises(ValueError):
        align.load_modality(spark, bad, "text")


def test_correlations_need_more_than_ten_and_skip_constants(spark):
    rnd = np.random.default_rng(1)
    rows = [("pos" if i % 2 else "neg", float(rnd.normal() + i % 2), 3.0, float(i) if i < 10 else None, None if i % 5 else 1.0 * i)
            for i in range(60)]
    df = spark.createDataFrame(rows, "label string, a__x double, a__flat double, a__few double, a__some double")
    got = {r.feature: r.r for r in align.label_correlations(df).collect()}
    y = np.array([r[0] == "pos" for r in rows], float)
    want = np.corrcoef([r[1] for r in rows], y)[0, 1]
    assert got["a__x"] == pytest.approx(want, abs=1e-4) and set(got) == {"a__x", "a__some"}
    matrix = {(r.f1, r.f2): r.r for r in align.correlation_matrix(df).collect()}
    assert len(matrix) == 16 and matrix["a__x", "a__x"] == 1.0 and matrix["a__x", "a__flat"] is None
    some = [(r[1], r[4]) for r in rows if r[4] is not None]
    assert matrix["a__some", "a__x"] == matrix["a__x", "a__some"] == pytest.approx(
        np.corrcoef(*zip(*some))[0, 1], abs=1e-4)


def test_array_stats_equal_numpy(spark):
    a = np.random.default_rng(3).integers(0, 256, 48)
    r = align.array_stats(spark.createDataFrame([(1, [int(x) for x in a])], "id int, a array<int>"), "a", "id").head()
    p = a.reshape(-1, 3)
    assert [r.mean_0, r.mean_1, r.mean_2] == pytest.approx(list(p.mean(axis=0)), abs=1e-3)
    assert (r.std, r.brightness, r.contrast) == pytest.approx(
        (a.std(), a.mean() / 255, a.std() / 128), abs=1e-3)


def test_histogram_equals_numpy(spark):
    v = np.random.default_rng(5).normal(size=400)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    got = [r["count"] for r in explore.histogram(df, "v", 13).orderBy("bin").collect()]
    assert got == list(np.histogram(v, 13)[0])
    flat = explore.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in flat] == [0, 0, 3, 0] and (flat[0].lower, flat[-1].upper) == (1.5, 2.5)


def test_box_stats(spark):
    df = spark.createDataFrame([("a", x) for x in (1, 2, 3, 4, 100)] + [("b", 1), (None, 5), ("b", None)],
                               "g string, n int")
    got = {r.g: r for r in explore.box_stats(df, "n", "g").collect()}
    assert (got["a"].median, got["a"].whisker_high, got["a"].outliers, got["a"].position) == (3.0, 4, 1, 2)
    assert got["b"].position == 1 and got["b"]["count"] == 1


def test_top_words_and_stop_words(spark):
    df = spark.createDataFrame([("pos", "Мама мыла мыла раму и это"), ("neg", "рама рама тоже"), (None, "нет")],
                               "label string, text string")
    got = [(r.label, r.rank, r.word, r.freq) for r in
           explore.top_words(df, "label", 2).orderBy("label", "rank").collect()]
    assert got == [("neg", 1, "рама", 2), ("pos", 1, "мыла", 2), ("pos", 2, "мама", 1)]


def test_example_rows(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None)], "id int, label string")
    assert {(r.label, r.id) for r in align.example_rows(df).collect()} == {("a", 1), ("b", 2)}
