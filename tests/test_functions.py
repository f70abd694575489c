"""Text expressions, keys, selection and quantiles against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import keys, quantiles, text

TEXTS = ["", "  plain words here ", " nbsp em　wide ", "a\x1cb\x1dc", "мама МЫЛА раму!?…",
         "one\ntwo\r\nthree\tfour", "emoji 😀 ok", "Ünïcode ßtraße", "!!!", "x_1 y2 z"]


def column(spark, expr, values=TEXTS):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def test_strip_and_words_equal_python(spark):
    assert column(spark, text.strip) == [t.strip() for t in TEXTS]
    assert column(spark, text.word_count) == [len(t.split()) for t in TEXTS]
    assert column(spark, text.text_length) == [len(t) for t in TEXTS]


def test_average_word_length_is_null_without_words(spark):
    assert column(spark, text.average_word_length, ["ab cd", ""]) == [2.5, None]


def test_punctuation_ratio(spark):
    want = [sum(c in "!?…" for c in t) / max(len(t), 1) for t in TEXTS]
    assert column(spark, text.punctuation_ratio) == pytest.approx(want)


def test_tokens_and_grams(spark):
    want = [re.findall(r"\b\w\w+\b", t.lower()) for t in TEXTS]
    assert column(spark, text.tokens) == want
    assert column(spark, text.one_and_two_grams) == [
        w + [f"{a} {b}" for a, b in zip(w, w[1:])] for w in want]


def test_letter_words_and_shorten(spark):
    assert column(spark, text.letter_words, ["мама МЫЛА ре раму ёжик"]) == [["мама", "мыла", "раму", "ёжик"]]
    assert column(spark, text.shorten, ["a" * 200, "a" * 201]) == ["a" * 200, "a" * 200 + "…"]


def test_fingerprint_separates_rows(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("-", "1:a"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(keys.fingerprint(df, ["x", "y"])).distinct().count() == len(rows)
    same = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "v double")
    assert same.select(keys.fingerprint(same, ["v"])).distinct().count() == 2


def test_keep_first_with_one_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"t{i}", None if i % 2 else "x") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, t string, l string")
    seen, want = set(), []
    for i, t, l in rows:
        if (t, l) not in seen:
            seen.add((t, l))
            want.append(i)
    got = sorted(r.id for r in keys.keep_first(df.repartition(7), ["t", "l"], "id").collect())
    assert got == want


@pytest.mark.parametrize("n", [1, 99, 250, 500])
def test_first_rows_by_threshold_equals_limit(spark, monkeypatch, n):
    rnd = random.Random(n)
    rows = [(rnd.randint(0, 3), i) for i in range(500)]
    df = spark.createDataFrame(rows, "f int, r int").repartition(5)
    monkeypatch.setattr(keys, "SORTED_KEYS", 20)
    monkeypatch.setattr(keys, "PIVOTS", 4)
    got = sorted(map(tuple, keys.first_rows(df, n, ["f", "r"]).collect()))
    assert got == sorted(rows)[:n]


@pytest.mark.parametrize("sorted_keys", [1, 1000])
def test_first_rows_with_repeated_null_and_string_keys(spark, monkeypatch, sorted_keys):
    monkeypatch.setattr(keys, "SORTED_KEYS", sorted_keys)
    numbers = spark.createDataFrame([(k, t) for k in (1, 1, 1, 2, None) for t in ("x",)], "k int, t string")
    assert sorted((r.k or 0 for r in keys.first_rows(numbers, 2, "k").collect())) == [0, 1]
    assert keys.first_rows(numbers, 4, "k").count() == 4 and keys.first_rows(numbers, 9, "k").count() == 5
    assert keys.first_rows(numbers, 0, "k").count() == 0 and keys.first_rows(numbers, None, "k").count() == 5
    words = spark.createDataFrame([(w, i) for i in range(40) for w in (None, "b", "a", "é", "z")], "w string, i int")
    got = keys.first_rows(words.repartition(7), 53, ["w", "i"]).collect()
    assert sorted((r.w or "", r.i) for r in got) == sorted([("", i) for i in range(40)] + [("a", i) for i in range(13)])
    tied = [(r.w, r.i) for r in keys.first_rows(words, 53, "w").collect()]
    assert len(tied) == 53 and sum(w is None for w, _ in tied) == 40
    assert sorted(tied, key=str) == sorted(((r.w, r.i) for r in keys.first_rows(words.repartition(3), 53, "w").collect()), key=str)


@pytest.mark.parametrize("n", [1, 37, 400, 1000])
def test_seeded_sample_paths_agree(spark, monkeypatch, n):
    df = spark.range(400).repartition(6)
    want = sorted(range(400), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest()[:15], i))[:n]
    assert sorted(r.id for r in keys.seeded_sample(df, n, "id").collect()) == sorted(want)
    monkeypatch.setattr(keys, "SORTED_KEYS", 20)
    assert sorted(r.id for r in keys.seeded_sample(df, n, "id").collect()) == sorted(want)


def test_small_side_keeps_all_rows_beyond_the_bound(spark):
    df = spark.range(50)
    assert keys.small_side(df, 10).count() == 50
    assert keys.small_side(df, 100).count() == 50


def test_require_unique(spark):
    keys.require_unique(spark.range(5), "id")
    with pytest.raises(ValueError):
        keys.require_unique(spark.createDataFrame([(1,), (1,)], "id int"), "id")


PROBS = [0.0, 0.25, 0.5, 0.95, 1.0]


@pytest.mark.parametrize("size, direct", [
    *[(n, 5_000_000) for n in (1, 2, 3, 4, 7, 101, 1000)], (101, 20), (20_003, 50)])
def test_quantiles_equal_numpy(spark, monkeypatch, size, direct):
    monkeypatch.setattr(quantiles, "RANK_DIRECTLY", direct)
    rnd = np.random.default_rng(size)
    a = np.round(rnd.lognormal(3, 2, size), 2)
    b = np.where(rnd.random(size) < .9, 7.0, rnd.integers(0, 5, size).astype(float))
    rows = [(float(x), float(y), None) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], PROBS)
    assert got["a"].values == pytest.approx(list(np.quantile(a, PROBS)))
    assert got["b"].values == pytest.approx(list(np.quantile(b, PROBS)))
    assert got["a"].n == size and got["c"] == quantiles.Quantiles(0, (None,) * len(PROBS))


def test_ranks_of_integers_beyond_double_precision(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "RANK_DIRECTLY", 10)
    base = 2 ** 60
    df = spark.createDataFrame([(base + i,) for i in range(300)], "id long").repartition(4)
    got = quantiles.values_at_ranks(df, {"id": [0, 150, 299]}, {"id": 300})["id"]
    assert got == {r: base + r for r in (0, 150, 299)}
