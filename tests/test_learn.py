"""TF-IDF, split, classifier and active learning."""

import math
from collections import Counter
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import annotate, learn, tfidf
from corpusmill.plans import curation



def dense(cell, width):
    out = np.zeros(width)
    out[cell.indices] = cell["values"]
    return list(out)


DOCS = ["the cat sat on the mat", "the dog sat", "a cat and a dog and a cat", "", None, "zzz unique words only", "dog dog dog mat"]


def brute(docs, cap):
    def grams(t):
        w = re.findall(r"\b\w\w+\b", (t or "").lower())
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]
    counts = [Counter(grams(t)) for t in docs]
    total, df = Counter(), Counter()
    for c in counts:
        total.update(c)
        df.update(c.keys())
    kept = sorted((t for t in total if df[t] >= 2), key=lambda t: (-total[t], t))[:cap]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for i, c in enumerate(counts):
        w = {t: (1 + math.log(c[t])) * idf[t] for t in kept if t in c}
        n = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / n for t, x in w.items()})
    return sorted(kept), out


@pytest.mark.parametrize("cap", [3, 100])
def test_tfidf_equals_brute_force(spark, cap):
    df = spark.createDataFrame(list(enumerate(DOCS)), "row_id int, text string").repartition(3)
    terms, want = brute(DOCS, cap)
    model = tfidf.TfidfModel.fit(df, cap)
    assert list(model.terms) == terms
    got = {(r.row_id, r.term): r.weight for r in model.long_form(df, "row_id").collect()}
    assert got == pytest.approx(want)
    rows = {r.row_id: dense(r.features, len(terms)) for r in model.transform(df).collect()}
    assert len(rows) == len(DOCS) and rows[3] == [0.0] * len(terms)
    assert {(i, terms[j]): x for i, v in rows.items() for j, x in enumerate(v) if x} == pytest.approx(want)


def test_model_round_trip(spark, tmp_path):
    model = tfidf.TfidfModel(("a", "b c"), (1.5, 2.0))
    model.save(spark, str(tmp_path / "m"))
    assert tfidf.TfidfModel.load(spark, str(tmp_path / "m")) == model


def test_split_is_exact_and_stable(spark):
    rows = [(i, "big" if i % 10 else "small") for i in range(503)] + [(900, None), (901, "single")]
    df = spark.createDataFrame(rows, "id long, label string")
    parts = [{r.id: r.is_test for r in learn.stratified_split(d, "label", "id", .25).collect()}
             for d in (df, df.orderBy(F.desc("id")).repartition(7))]
    assert parts[0] == parts[1] and len(parts[0]) == len(rows)
    tests = Counter(dict(rows)[i] for i, t in parts[0].items() if t)
    n = Counter(label for _, label in rows)
    assert tests == {l: k for l in n if l and (k := math.floor(n[l] * .25 + .5))}
    assert parts[0][900] is False


def toy(spark, n=120):
    rnd = np.random.default_rng(7)
    rows = []
    for i in range(n):
        label = "pos" if i % 3 else "neg"
        vocab = ["sun", "joy", "win", "day"] if label == "pos" else ["war", "ill", "sad", "day"]
        rows.append((i, " ".join(rnd.choice(vocab, 6)), label, float(rnd.choice([0.51, 0.8, 0.99]))))
    return spark.createDataFrame(rows, "row_id long, text string, label string, confidence double")


def test_classifier_is_at_the_optimum(spark):
    df = toy(spark)
    model = tfidf.TfidfModel.fit(df, 50)
    width = len(model.terms)
    feats = model.transform(df).cache()
    fitted = learn.fit_classifier(feats, "label", "row_id", width, tol=1e-10)
    assert fitted.labels == ("neg", "pos") and fitted.rows == 120 and 0 < fitted.iterations < 1000
    rows = feats.orderBy("row_id").collect()
    x = np.array([dense(r.features, width) for r in rows])
    y = np.array([r.label == "pos" for r in rows], float)
    sw = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w, b = fitted.coefficients[0], fitted.intercepts[0]
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(w + x.T @ (sw * (p - y))).max() < 1e-3 and abs((sw * (p - y)).sum()) < 1e-3
    scored = {r.row_id: r for r in fitted.transform(feats).collect()}
    assert [scored[r.row_id].probability[1] for r in rows] == pytest.approx(list(p))
    assert all(r.prediction_label == ("pos" if r.probability[1] > .5 else "neg") for r in scored.values())
    again = learn.fit_classifier(feats, "label", "row_id", width, tol=1e-10, start=fitted)
    assert again.iterations <= 1 and again.coefficients[0] == pytest.approx(w, abs=1e-6)


def test_three_classes_are_at_the_optimum(spark):
    df = toy(spark).withColumn("label", F.when(F.col("row_id") % 5 == 0, "odd").otherwise(F.col("label")))
    model = tfidf.TfidfModel.fit(df, 50)
    width = len(model.terms)
    feats = model.transform(df).cache()
    fitted = learn.fit_classifier(feats, "label", "row_id", width, c=0.5, tol=1e-9)
    rows = feats.orderBy("row_id").collect()
    x = np.array([dense(r.features, width) for r in rows])
    y = np.array([[r.label == label for label in fitted.labels] for r in rows], float)
    sw = (len(rows) / (3 * y.sum(axis=0)))[y.argmax(axis=1)][:, None]
    margin = x @ fitted.coefficients.T + fitted.intercepts
    p = np.exp(margin) / np.exp(margin).sum(axis=1, keepdims=True)
    assert np.abs(fitted.coefficients / 0.5 + (sw * (p - y)).T @ x).max() < 1e-3
    scored = {r.row_id: r for r in fitted.transform(feats).collect()}
    assert np.array([scored[r.row_id].probability for r in rows]) == pytest.approx(p)
    assert [scored[r.row_id].prediction_label for r in rows] == [fitted.labels[k] for k in p.argmax(axis=1)]


def test_fit_on_a_bounded_sample(spark):
    df = toy(spark, 400)
    model = tfidf.TfidfModel.fit(df, 50)
    feats = model.transform(df).cache()
    fitted = learn.fit_classifier(feats, "label", "row_id", len(model.terms), max_fit_rows=100)
    assert 98 <= fitted.rows <= 102                           # a share of each class, rounded
    same = learn.fit_classifier(feats.repartition(7), "label", "row_id", len(model.terms), max_fit_rows=100)
    assert same.coefficients[0] == pytest.approx(fitted.coefficients[0])
    assert learn.scores(fitted.transform(feats), "label")["accuracy"] > .95
    rare = feats.withColumn("label", F.when(F.col("row_id") == 3, "rare").otherwise(F.col("label")))
    assert learn.fit_classifier(rare, "label", "row_id", len(model.terms), max_fit_rows=50).labels == ("neg", "pos", "rare")


def test_saved_classifier_scores_the_same(spark, tmp_path):
    df = toy(spark)
    model = tfidf.TfidfModel.fit(df, 50)
    feats = model.transform(df)
    fitted = learn.fit_classifier(feats, "label", "row_id", len(model.terms))
    fitted.save(spark, str(tmp_path / "m"))
    loaded = learn.Classifier.load(spark, str(tmp_path / "m"))
    a, b = ({r.row_id: r.probability for r in m.transform(feats).collect()} for m in (fitted, loaded))
    assert a == b and loaded.iterations == fitted.iterations


@pytest.mark.parametrize("rows", [
    [(1, "a", "pos")] * 60, [(1, f"t{i}", "pos") for i in range(60)],
    [(i % 3, f"t{i % 4}", "pos") for i in range(60)] + [(7, "x", "neg")] * 10])
def test_split_of_repeated_keys_is_exact(spark, rows):
    df = spark.createDataFrame(rows, "id long, text string, label string")
    parts = [sorted(map(tuple, learn.stratified_split(d, "label", "id", .2).collect())) for d in (df, df.repartition(5))]
    assert parts[0] == parts[1] and len(parts[0]) == len(rows)
    tests = Counter(label for *_, label, test in parts[0] if test)
    assert tests == {label: math.floor(n * .2 + .5) for label, n in Counter(r[2] for r in rows).items()}


def test_one_class_is_an_error(spark):
    df = toy(spark).where("label = 'pos'").withColumn("features", F.lit(None))
    with pytest.raises(learn.OneClass):
        learn.fit_classifier(df, "label", "row_id", 1)


def test_roles(spark):
    df = toy(spark)
    count = lambda d: {r["_role"]: r["count"] for r in d.groupBy("_role").count().collect()}
    some = df.withColumn("label", F.when(F.col("row_id") < 40, F.col("label")).when(F.col("row_id") < 50, F.lit("  ")))
    assert count(learn.assign_roles(some, "row_id", "label", "confidence", 5, 2)) == {"labeled": 40, "pool": 80}
    cut = np.quantile([r.confidence for r in df.collect()], .3)
    pool = sum(r.confidence <= cut for r in df.collect())
    assert count(learn.assign_roles(df, "row_id", "label", "confidence", 5, 2)) == {"labeled": 120 - pool, "pool": pool}
    assert count(learn.assign_roles(df, "row_id", "label", None, 5, 2)) == {"labeled": 90, "pool": 30}
    assert count(learn.assign_roles(df, "row_id", "label", None, 50, 9)) == {"pool": 120}


def test_cycle_invariants(spark):
    df = toy(spark).withColumn("label", F.when(F.col("row_id") < 60, F.col("label")))
    out = learn.run_cycle(df, "row_id", n_iterations=2, batch_size=7)
    picks = out.selected.collect()
    assert len({r.row_id for r in picks}) == 14 and all(r.row_id >= 60 for r in picks)
    rounds = out.iterations.orderBy("iteration").collect()
    assert [(r.labeled_size, r.selected) for r in rounds] == [(60, 7), (60, 7)]
    scores = {r.row_id: r.al_uncertainty for r in out.scores.collect()}
    assert len(scores) == 120 and all(0 <= u <= .5 + 1e-9 for u in scores.values())
    first = [r for r in picks if r.al_iteration == 1]
    assert min(r.al_uncertainty for r in first) >= 0 and rounds[0].mean_uncertainty == pytest.approx(
        np.mean([r.al_uncertainty for r in first]), abs=1e-4)


def test_cycle_grows_over_labelled_rows(spark):
    df = toy(spark)                                           # all labelled: the pool is the unsure part
    pool = learn.low_confidence_pool(df).count()
    out = learn.run_cycle(df, "row_id", n_iterations=3, batch_size=7)
    rounds = out.iterations.orderBy("iteration").collect()
    assert [(r.labeled_size, r.selected) for r in rounds] == [(120 - pool + 7 * i, 7) for i in range(3)]
    picks = [r.row_id for r in out.selected.collect()]
    unsure = {r.row_id for r in learn.low_confidence_pool(df).collect()}
    assert len(set(picks)) == len(picks) == 21 and set(picks) <= unsure


def test_cycle_without_enough_labels(spark):
    df = toy(spark).withColumn("label", F.when(F.col("row_id") < 5, F.col("label")))
    out = learn.run_cycle(df, "row_id", batch_size=9)
    assert out.skipped and out.iterations.count() == 0 and out.selected.count() == 9
    assert out.scores.agg(F.max("al_uncertainty")).head()[0] == 0.0


def test_whole_run_grows_and_trains(spark, tmp_path):
    settings = curation.Settings(lexicon={"pos": ["sun", "joy"], "neg": ["war", "ill"]}, n_iterations=1, batch_size=5)
    raw = toy(spark).drop("confidence")
    out = curation.run(raw, settings)
    rows = {r.name: r.rows for r in out.funnel.collect()}
    assert rows["raw"] == 120 and rows["after_review"] == rows["cleaned"] == rows["scored"]
    assert out.trained.metrics["accuracy"] > .8
    assert {"rows_raw", "corrections", "accuracy"} <= {r.metric for r in curation.summary(out).collect()}
    curation.save(out, str(tmp_path / "run"))
    assert spark.read.parquet(str(tmp_path / "run" / "dataset")).count() == rows["scored"]
    curation.queue_for_review(out.labelled, settings, str(tmp_path / "queue"))
    fixes = curation.read_corrections(spark, str(tmp_path / "queue"), settings)
    assert fixes.count() == annotate.flagged(out.labelled).count()


def test_fused_features(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a__x double, b__y double")
    (row,) = learn.fuse_features(df, ["a__x", "b__y"]).collect()
    assert row.features.indices == [0, 1] and row.features["values"] == [1.0, 2.0]
    (row,) = learn.fuse_features(df, ["a__x", "b__y"], scale={"a__x": (3.0, 4.0), "b__y": (2.0, 0.0)}).collect()
    assert row.features["values"] == [-0.5, 0.0]


def test_models_of_modalities_equal_brute_force(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for i in range(150):
        y = i % 3 > 0
        rows.append((i, "pos" if y else "neg", float(rnd.normal(y)), float(rnd.normal(50 * y, 60)), 3.0 if i % 10 else None))
    df = spark.createDataFrame(rows, "id long, label string, a__x double, b__y double, b__z double").repartition(3)
    groups = {"a": ["a__x"], "b": ["b__y", "b__z"]}
    got = {(r.features, r.label): r for r in learn.compare_modalities(df, "id", groups).collect()}
    whole = [r for r in rows if r[4] is not None]
    keyed = spark.createDataFrame([r[:2] for r in whole], "id long, label string")
    split = {r.id: r.is_test for r in learn.stratified_split(keyed, "label", "id", .2).collect()}
    x = np.array([r[2:] for r in whole])
    test, y = np.array([split[r[0]] for r in whole]), np.array([r[1] == "pos" for r in whole], float)
    spread = x[~test].std(axis=0)
    x = (x - x[~test].mean(axis=0)) / np.where(spread == 0, 1, spread)
    for name, columns in {"a": [0], "b": [1, 2], "all": [0, 1, 2]}.items():
        guess = brute_fit(x[~test][:, columns], y[~test])(x[test][:, columns]) > .5
        for label, truth, made in (("pos", y[test] == 1, guess), ("neg", y[test] == 0, ~guess)):
            row = got[name, label]
            assert row.support == truth.sum()
            assert row.recall == pytest.approx((truth & made).sum() / truth.sum(), abs=1e-4)
            assert row.precision == pytest.approx((truth & made).sum() / max(1, made.sum()), abs=1e-4)


# -- whole reports against a brute-force fit ------------------------------------------

def noisy(spark, n=160, seed=5):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = "pos" if i % 3 else "neg"
        vocab = ["sun", "joy", "win", "day", "sea", "sky"] if (label == "pos") == (rnd.random() > .2) else ["war", "ill", "sad", "day", "sea", "fog"]
        rows.append((i, " ".join(rnd.choice(vocab, 7)), label))
    return spark.createDataFrame(rows, "row_id long, text string, label string"), rows


def brute_vectors(fit_on, texts, cap):
    terms, _ = brute(fit_on, cap)

    def grams(t):
        w = re.findall(r"\b\w\w+\b", t.lower())
        return Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    seen = [grams(t) for t in fit_on]
    idf = [math.log((1 + len(fit_on)) / (1 + sum(t in c for c in seen))) + 1 for t in terms]
    out = np.array([[(1 + math.log(c[t])) * w if t in c else 0.0 for t, w in zip(terms, idf)] for c in map(grams, texts)])
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm == 0, 1, norm)


def brute_fit(x, y, c=1.0):
    """Probability function of the class that y marks, by Newton steps on the dense problem."""
    sw = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    z = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.append(np.full(x.shape[1], 1 / c), 0.0)
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve((z * (sw * p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (sw * (p - y)) + penalty * w)
    return lambda v: 1 / (1 + np.exp(-(np.hstack([v, np.ones((len(v), 1))]) @ w)))


def test_report_equals_brute_force(spark):
    df, rows = noisy(spark)
    trained = learn.train_and_evaluate(df, "row_id", max_features=60)
    split = {r.row_id: r.is_test for r in learn.stratified_split(df, "label", "row_id", .2).collect()}
    train, test = ([r for r in rows if split[r[0]] is side] for side in (False, True))
    x = brute_vectors([r[1] for r in train], [r[1] for r in rows], 60)
    p = brute_fit(x[[r[0] for r in train]], np.array([r[2] == "pos" for r in train], float))(x)
    want = {r[0]: p[r[0]] for r in test}
    got = {r.row_id: r for r in trained.predictions.collect()}
    assert {k: r.probability[1] for k, r in got.items()} == pytest.approx(want, abs=1e-4)
    truth, guess = {r[0]: r[2] for r in test}, {k: "pos" if v > .5 else "neg" for k, v in want.items()}
    hits = sum(truth[k] == guess[k] for k in truth)
    assert 0.5 < hits / len(test) < 1.0
    f1 = {}
    report = {r.label: r for r in learn.report_with_averages(trained.predictions, "label").collect()}
    for label in ("neg", "pos"):
        tp = sum(truth[k] == guess[k] == label for k in truth)
        made, there = (sum(v == label for v in side.values()) for side in (guess, truth))
        f1[label] = 2 * tp / (made + there)
        assert report[label].support == there
        assert [report[label].precision, report[label].recall, report[label].f1] == pytest.approx(
            [tp / made, tp / there, f1[label]], abs=1e-4)
    assert report["accuracy"].f1 == trained.metrics["accuracy"] == pytest.approx(hits / len(test), abs=1e-4)
    assert report["macro avg"].f1 == trained.metrics["f1_macro"] == pytest.approx(np.mean(list(f1.values())), abs=1e-4)


def test_rounds_equal_brute_force(spark):
    df, rows = noisy(spark, 150, 9)
    known = {r[0] for r in rows if r[0] < 70}
    df = df.withColumn("label", F.when(F.col("row_id") < 70, F.col("label")))
    out = learn.run_cycle(df, "row_id", n_iterations=2, batch_size=9, max_features=40)
    x = brute_vectors([r[1] for r in rows], [r[1] for r in rows], 40)
    y = np.array([r[2] == "pos" for r in rows], float)
    p = brute_fit(x[sorted(known)], y[sorted(known)])(x)
    unsure = np.minimum(p, 1 - p)
    left = [r[0] for r in rows if r[0] not in known]
    picked = []
    for it in (1, 2):                                          # picks have no label, so the model stays
        best = sorted(left, key=lambda k: (-round(unsure[k], 5), k))[:9]
        got = {r.row_id: r.al_uncertainty for r in out.selected.where(F.col("al_iteration") == it).collect()}
        assert sorted(got.values()) == pytest.approx(sorted(unsure[best]), abs=1e-4)
        picked += got
        left = [k for k in left if k not in got]
    assert len(set(picked)) == 18
    scored = {r.row_id: r.al_uncertainty for r in out.scores.collect()}
    assert scored == pytest.approx(dict(enumerate(unsure)), abs=1e-4)
    rounds = out.iterations.orderBy("iteration").collect()
    assert [r.mean_uncertainty for r in rounds] == pytest.approx(
        [np.mean(sorted(unsure[70:])[-9 * i:][:9]) for i in (1, 2)], abs=1e-3)
    assert all(r.fit_rows == 70 and r.fit_steps > 0 for r in rounds)


def test_words_that_tie_make_pairs(spark):
    """The last word kept ties with others, whose pairs are as frequent and come first."""
    texts = ["aa bb", "aa bb", "zz", "zz", "yy", "yy", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string").repartition(2)
    for cap in range(1, 6):
        assert list(tfidf.TfidfModel.fit(df, cap).terms) == brute(texts, cap)[0]


def test_terms_are_added_up_in_tasks(spark, monkeypatch):
    """Counts of slices of any size add up, and a term travels once for each slice, not once for each occurrence."""
    from corpusmill.functions import grams
    batch = pa.RecordBatch.from_arrays([pa.array(["the cat sat", "the cat the cat", None, "", "cat's été_1 x"] * 50)], ["text"])
    want = None
    for size in (1, 40, 10**6):
        monkeypatch.setattr(grams, "SLICE_BYTES", size)
        total, sent = Counter(), 0
        for count in (grams.count_words, grams.count_pairs(), grams.count_pairs(["cat", "the"])):
            for part in count(iter([batch])):
                sent += part.num_rows
                for r in part.to_pylist():
                    total[r["term"], "ctf"] += r["ctf"]
                    total[r["term"], "df"] += r["df"]
        want = want or total
        assert total == want
    assert want["cat the", "ctf"] == 100 and want["the cat", "ctf"] == 300 and want["the cat", "df"] == 200 and sent < 20
    cells = grams.Vectoriser(["cat", "the cat"], [1.0, 2.0]).cells(batch.column(0).slice(0, 5)).to_pylist()
    assert [c["indices"] for c in cells] == [[0, 1], [0, 1], [], [], [0]]


def test_features_of_modalities_are_worked_out_once(spark):
    """Learning reads an aligned table once, whatever its columns cost."""
    seen = spark.sparkContext.accumulator(0)

    def slow(x):
        seen.add(1)
        return float(x)
    rows = spark.createDataFrame([(i, "pos" if i % 2 else "neg") for i in range(100)], "id int, label string")
    value = F.udf(slow, "double", useArrow=False)(F.col("id"))
    learn.compare_modalities(rows.select("*", value.alias("a__x")), "id", {"a": ["a__x"]}).collect()
    assert seen.value == 100


def test_training_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def slow(x):
        seen.add(1)
        return x
    rows = spark.createDataFrame([(i, "good one" if i % 2 else "bad one", "pos" if i % 2 else "neg") for i in range(50)],
                                 "id int, text string, label string")
    learn.train_and_evaluate(rows.select("id", F.udf(slow, "string", useArrow=False)("text").alias("text"), "label"), "id")
    assert seen.value <= 100                                  # one scan, and the same for the null check below it


def test_a_task_sends_a_term_once(spark, monkeypatch):
    """Slices and batches of a task are added up, within a bound, before terms travel."""
    from corpusmill.functions import grams
    monkeypatch.setattr(grams, "SLICE_BYTES", 20)
    batches = [pa.RecordBatch.from_arrays([pa.array(["the cat sat", "the cat the cat"] * 5)], ["text"])] * 3
    for bound, most in ((1000, 1), (4, 30)):
        monkeypatch.setattr(grams, "MERGED_TERMS", bound)
        for count, term, n in ((grams.count_words, "cat", 45), (grams.count_pairs(["cat", "the"]), "the cat", 45)):
            rows = [r for part in count(iter(batches)) for r in part.to_pylist() if r["term"] == term]
            assert sum(r["ctf"] for r in rows) == n and sum(r["df"] for r in rows) == 30 and len(rows) <= most


def test_words_of_all_letters_and_digits():
    """Words by bytes are the runs that a regular expression over code points finds."""
    from corpusmill.functions import grams
    texts = ["été_1 x", None, "", "中文 ٣٤ 𝔘𝟙 😀ab", "a", "́a b́c", "x\U0010ffffyz", "ab", "cd-É ñ"] * 3
    row, flat = grams._words(pa.array(texts).slice(1, 20))
    pattern = re.compile(r"[^\W]{2,}")
    assert list(zip(row, flat.to_pylist())) == [(i, w) for i, t in enumerate(texts[1:21]) for w in pattern.findall(t or "")]


def test_scores_come_from_batches_and_equal_sums_in_order(spark):
    rng = np.random.default_rng(1)
    for k in (1, 3):
        model = learn.Classifier(("a", "b", "c")[:max(2, k)], rng.normal(size=(k, 50)), rng.normal(size=k))
        cells = [(i, ([int(x) for x in rng.permutation(50)[:i]], [float(x) for x in rng.normal(size=i)])) for i in range(20)]
        rows = spark.createDataFrame([*cells, (99, None)], "id int, features struct<indices: array<int>, values: array<double>>")
        scored = model.transform(rows)
        assert "ArrowEval" in scored._jdf.queryExecution().toString()
        got = {r.id: r for r in scored.collect()}
        assert got[99].probability == [None] * len(model.labels)
        for i, (indices, values) in cells:
            margins = []
            for w, total in zip(model.coefficients, model.intercepts):
                for at, x in zip(indices, values):
                    total = total + x * w[at]
                margins.append(total)
            e = np.exp(np.array(margins) - max(margins))
            want = e / e.sum() if k > 1 else [1 - 1 / (1 + math.exp(-margins[0])), 1 / (1 + math.exp(-margins[0]))]
            assert np.allclose(got[i].probability, want, rtol=1e-14, atol=0)


def test_curation_cleans_and_reviews_once(spark):
    """What several steps read is a written table, not the work that made it."""
    settings = curation.Settings(lexicon={"pos": ["sun", "joy"], "neg": ["war", "ill"]}, n_iterations=1, batch_size=5)
    out = curation.run(toy(spark).drop("confidence"), settings)
    for table in (out.cleaned, out.labelled, out.reviewed):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan and table.inputFiles()


def many_rows(spark, n=20_400):
    """Labelled rows; the last 400, in the order that a sample of 20,000 would be taken by, contradict the others."""
    last = set(sorted(range(n), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[-400:])
    rows = [(i, ("sun day" if i % 2 else "war day") + (" rare" if i in last else ""), "pos" if i % 2 != (i in last) else "neg")
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, text string, label string")


@pytest.mark.parametrize("classes, sent", [(2, 1 << 26), (3, 0)])
def test_passes_over_blocks_equal_one_task(spark, monkeypatch, classes, sent):
    from corpusmill.functions import logistic
    df = toy(spark, 300).repartition(3)
    if classes == 3:
        df = df.withColumn("label", F.when(F.col("row_id") % 5 == 0, "odd").otherwise(F.col("label")))
    model = tfidf.TfidfModel.fit(df, 50)
    feats = model.transform(df).cache()
    whole = learn.fit_classifier(feats, "label", "row_id", len(model.terms), tol=1e-9)
    for name, value in (("ONE_TASK_CELLS", 0), ("PIECE", 7), ("SENT_BYTES", sent)):
        monkeypatch.setattr(logistic, name, value)
    passed = learn.fit_classifier(feats, "label", "row_id", len(model.terms), tol=1e-9)
    assert passed.rows == whole.rows == 300 and passed.labels == whole.labels
    assert passed.coefficients == pytest.approx(whole.coefficients, abs=1e-6)
    assert passed.intercepts == pytest.approx(whole.intercepts, abs=1e-6)
    again = learn.fit_classifier(feats, "label", "row_id", len(model.terms), tol=1e-8, start=passed)
    assert again.iterations <= 1


def test_blocks_hold_all_rows(monkeypatch):
    from corpusmill.functions import logistic
    cells = [[3], [], [1, 2, 0], [4, 5], [], [0, 1, 2, 3, 4, 5, 6], [2]]
    batch = pa.RecordBatch.from_arrays([
        pa.array([0, 1, 1, 0, 2, 1, 0]), pa.array(cells, pa.list_(pa.int32())),
        pa.array([[float(10 * i + x) for x in c] for i, c in enumerate(cells)], pa.list_(pa.float64()))], ["label", "indices", "values"])
    for size in (1, 4, 100):
        monkeypatch.setattr(logistic, "BLOCK_CELLS", size)
        blocks = list(logistic._packed(3)(iter([batch.slice(0, 0), batch.slice(0, 3), batch.slice(3)])))
        label, counts, indices, values = (np.concatenate(x).tolist() for x in zip(*logistic._unpacked(iter(blocks))))
        assert label == batch.column("label").to_pylist() and counts == [len(c) for c in cells]
        assert indices == sum(cells, []) and values == [float(10 * i + x) for i, c in enumerate(cells) for x in c]
        assert [sum(t) for t in zip(*[b.column("tally")[0].as_py() for b in blocks])] == [3, 3, 1, 14]


def test_fit_uses_every_row(spark):
    """No row is left out, whatever their number: here 400 of 20,400 decide what one term means."""
    df = many_rows(spark)
    model = tfidf.TfidfModel.fit(df, 50)
    feats = model.transform(df)
    fitted = learn.fit_classifier(feats, "label", "row_id", len(model.terms))
    assert fitted.rows == 20_400
    rows = df.selectExpr("text", "label = 'pos' as y").groupBy("text", "y").count().collect()
    texts = sorted({r.text for r in rows})
    vectors = {r.text: dense(r.features, len(model.terms)) for r in model.transform(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    n, pos = sum(r["count"] for r in rows), sum(r["count"] for r in rows if r.y)
    slope = np.append(fitted.coefficients[0], 0.0)
    for r in rows:
        x = np.append(vectors[r.text], 1.0)
        p = 1 / (1 + math.exp(-(x[:-1] @ fitted.coefficients[0] + fitted.intercepts[0])))
        slope += r["count"] * (n / (2 * pos) if r.y else n / (2 * (n - pos))) * (p - r.y) * x
    assert np.abs(slope / n).max() < 2e-6


def test_cycle_fits_every_labelled_row(spark):
    df = many_rows(spark)
    more = spark.createDataFrame([(100_000 + i, "sun rare" if i % 2 else "war rare", None) for i in range(40)], df.schema)
    out = learn.run_cycle(df.unionByName(more), "row_id", n_iterations=1, batch_size=5)
    (row,) = out.iterations.collect()
    assert row.labeled_size == row.fit_rows == 20_400
    assert out.scores.where("al_uncertainty between 0 and 0.5").count() == 20_440


def test_training_fits_every_row(spark):
    trained = learn.train_and_evaluate(many_rows(spark, 25_600), "row_id")
    assert trained.model.rows == trained.metrics["train_size"] == 20_480 and trained.metrics["test_size"] == 5_120


def test_models_of_modalities_fit_every_row(spark, monkeypatch):
    rows, fit = [], learn.Classifier.fit

    def seen(*args, **named):
        model = fit(*args, **named)
        rows.append(model.rows)
        return model
    monkeypatch.setattr(learn.Classifier, "fit", staticmethod(seen))
    df = spark.range(25_600).selectExpr("id", "if(id % 3 = 0, 'pos', 'neg') as label", "cast(id % 7 as double) as a__x",
                                        "cast(id % 6 as double) as b__y")
    report = learn.compare_modalities(df, "id", {"a": ["a__x"], "b": ["b__y"]})
    assert rows == [20_480] * 3 and report.where("features = 'all'").agg(F.sum("support")).head()[0] == 5_120
