"""Lexicon labels, agreement, examples, tasks and review."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import annotate, learn, review

WORDS = {"pos": ["good", "great"], "neg": ["bad"]}


def labelled(spark, texts, lexicon=WORDS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id int, text string")
    out = annotate.auto_label(df, lexicon, labelled_at="now").orderBy("row_id").collect()
    return [(r.auto_label, r.confidence) for r in out]


def test_rules(spark):
    got = labelled(spark, ["good", "BAD", "good bad", "good great bad", "x" * 300, "x" * 301, None, "good good"])
    assert got == [("pos", 0.99), ("neg", 0.99), ("pos", 0.745), ("pos", 0.8267), ("pos", 0.51), ("neg", 0.51),
                   ("pos", 0.51), ("pos", 0.99)]


def test_default_lexicon(spark):
    assert (len(annotate.POSITIVE_STEMS), len(annotate.NEGATIVE_STEMS)) == (37, 47)
    got = labelled(spark, ["Отличный праздник, победа!", "Взрыв и пожар, погибли люди", "Нейтрально"], None)
    assert got == [("pos", 0.99), ("neg", 0.99), ("pos", 0.51)]


def test_confidence_range(spark):
    df = spark.createDataFrame([(i, " ".join(["good"] * (i % 2) + ["bad"] * (i % 3))) for i in range(30)],
                               "row_id int, text string")
    bad = annotate.auto_label(df, WORDS).where("confidence <> 0.51 and not confidence between 0.745 and 0.99")
    assert bad.count() == 0


def test_other_modalities_are_refused(spark):
    with pytest.raises(NotImplementedError):
        annotate.auto_label(spark.range(1), modality="image")


def test_table_lexicon_equals_constant_lexicon(spark):
    texts = ["good", "so bad, so good", "bådgood", "", None, "gre great", "a\ngood", "😀bad😀great"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id int, text string")
    lex = spark.createDataFrame([("good", "pos"), ("great", "pos"), ("bad", "neg"), ("good", "pos")],
                                "stem string, polarity string")
    a = annotate.auto_label(df, WORDS, labelled_at="t").orderBy("row_id").collect()
    b = annotate.auto_label_from_table(df, lex, "row_id", labelled_at="t").orderBy("row_id").collect()
    assert a == b
    hits = annotate.lexicon_matches(df, lex, "row_id").collect()
    want = {(i, s) for i, t in enumerate(texts) for s in ("good", "great", "bad") if s in (t or "")}
    assert {(r.row_id, r.stem) for r in hits} == want and len(hits) == len(want)


def test_labels_a_stream_unchanged(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "good"), (2, "bad")], "row_id int, text string").write.parquet(src)
    stream = spark.readStream.schema("row_id int, text string").parquet(src)
    q = (annotate.flagged(annotate.auto_label(stream, WORDS), 2.0).writeStream.format("memory")
         .queryName("labelled_stream").option("checkpointLocation", str(tmp_path / "cp")).start())
    q.processAllAvailable()
    q.stop()
    assert spark.table("labelled_stream").count() == 2


def frame(spark, pairs):
    return spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate(pairs)],
                                 "row_id int, label string, auto_label string, confidence double")


def test_kappa_cases(spark):
    same = frame(spark, [("a", "a", .9), ("b", "b", .9)])
    assert tuple(annotate.agreement(same, "label").head()) == (2, 1.0, 100.0)
    one = frame(spark, [("a", "a", .9), ("a", "a", .9), (None, "a", .9)])
    assert tuple(annotate.agreement(one, "label").head()) == (2, None, 100.0)
    none = frame(spark, [(None, "a", .9)])
    assert tuple(annotate.agreement(none, "label").head()) == (0, None, None)


def test_confusion_drops_unlisted_labels(spark):
    df = frame(spark, [("pos", "pos", .9), ("pos", "neg", .9), ("odd", "pos", .9), ("neg", None, .9)])
    got = [tuple(r) for r in annotate.confusion(df, "label", "auto_label", ["pos", "neg"]).collect()]
    assert got == [("pos", 1, 1), ("neg", 0, 0)]


def test_accuracy_of_an_empty_group_is_zero(spark):
    df = frame(spark, [("pos", "pos", .9), ("pos", "neg", .9)])
    got = {r.confidence_group: (r.n, r.accuracy_pct) for r in annotate.accuracy_by_confidence(df).collect()}
    assert got == {"confident": (2, 50.0), "flagged": (0, 0.0)}


def test_null_confidence_is_in_neither_part(spark):
    df = frame(spark, [("pos", "pos", None), ("pos", "pos", .55), ("pos", "pos", .54)])
    assert (annotate.flagged(df).count(), annotate.confident(df).count()) == (1, 1)


def test_task_json_omits_absent_fields(spark):
    df = spark.createDataFrame([(1, "t", "s", "pos", .51), (2, None, None, None, None)],
                               "row_id int, text string, source string, auto_label string, confidence double")
    a, b = [json.loads(j) for j in sorted(annotate.tasks(df, "row_id").toJSON().collect(), key=len, reverse=True)]
    assert a["data"] == {"text": "t", "source": "s"} and a["meta"] == {"confidence": 0.51, "flagged": True}
    result = a["predictions"][0]["result"][0]
    assert result["value"] == {"choices": ["pos"]} and a["predictions"][0]["score"] == 0.51
    assert b["data"] == {"text": ""} and b["meta"] == {} and "predictions" not in b
    bare = annotate.tasks(df.drop("confidence"), "row_id").where("predictions is not null").head()
    assert bare.predictions[0].score == 1.0 and bare.meta.confidence is None


def test_review_round_trip(spark):
    df = frame(spark, [("pos", "neg", .51), (None, "neg", .51), ("pos", "neg", .9), ("neg", "neg", .51)]).withColumn(
        "text", F.lit("t"))
    queue = review.review_queue(df, "row_id")
    assert queue.columns == ["row_id", "text", "label", "auto_label", "confidence"]
    out = review.merge_review(df, review.simulate_review(queue), "row_id")
    got = {r.row_id: (r.label, r.human_reviewed) for r in out.collect()}
    assert got == {0: ("pos", True), 1: ("neg", True), 2: ("neg", None), 3: ("neg", True)}
    assert tuple(review.review_report(df, out, "row_id").head()) == (3, 3, 1)


def test_partial_and_unknown_corrections(spark):
    df = frame(spark, [("pos", "neg", .51), ("pos", "neg", .51)]).withColumn("text", F.lit("t"))
    some = spark.createDataFrame([(1, "pos")], "row_id int, auto_label string")
    got = {r.row_id: (r.auto_label, r.human_reviewed) for r in
           review.merge_review(df, some, "row_id", promote=False, check=True).collect()}
    assert got == {0: ("neg", None), 1: ("pos", True)}
    with pytest.raises(ValueError):
        review.merge_review(df, some.withColumn("row_id", F.lit(77)), "row_id", check=True)


@pytest.mark.parametrize("bound", [0, 20_000])
def test_lexicon_table_of_any_size(spark, monkeypatch, bound):
    monkeypatch.setattr(annotate, "BROADCAST_STEMS", bound)
    texts = ["", None, "abc", "Abcabc é\nabcdefghijklmnopqrst uvw", "x" * 40, "caféx a"]
    stems = ["a", "b", "ab", "abc", "cab", "é", "fé", "c\na", "abcdefghijklmnopqrst", "zz", "xxx", "x" * 20, "é\nab", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string")
    lex = spark.createDataFrame([(s, "pos" if len(s) % 2 else "neg") for s in stems], "stem string, polarity string")
    got = sorted((r.row_id, r.stem) for r in annotate.lexicon_matches(df, lex, "row_id").collect())
    assert got == sorted((i, s) for i, t in enumerate(texts) for s in stems if s and s in (t or "").lower())


def test_labelling_time_is_utc_whatever_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        at = annotate.auto_label(spark.createDataFrame([("t",)], "text string")).head().auto_label_at
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    now = datetime.now(timezone.utc)
    assert abs((now - datetime.strptime(at, "%Y-%m-%dT%H:%M:%S.%f").replace(tzinfo=timezone.utc)).total_seconds()) < 600


def test_class_report_zero_division(spark):
    df = frame(spark, [("a", "b", .9), ("a", "a", .9)])
    got = {r.label: (r.precision, r.recall, round(r.f1, 4), r.support)
           for r in learn.class_report(df, "label", "auto_label").collect()}
    assert got == {"a": (1.0, 0.5, 0.6667, 2), "b": (0.0, 0.0, 0.0, 0)}
    assert learn.scores(df, "label", "auto_label") == {"accuracy": 0.5, "f1_macro": 0.3333}


def test_review_keeps_rows_without_confidence_and_one_row_per_key(spark):
    rows = [(1, "a", "pos", "neg", 0.1), (2, "b", "pos", "pos", None), (3, "c", "neg", "neg", float("nan")), (4, "d", "neg", "pos", 0.9)]
    df = spark.createDataFrame(rows, "row_id int, text string, label string, auto_label string, confidence double")
    twice = spark.createDataFrame([(1, "pos"), (1, "neutral")], "row_id int, auto_label string")
    out = {r.row_id: (r.auto_label, r.human_reviewed) for r in review.merge_review(df, twice, "row_id", promote=False).collect()}
    assert out == {1: ("pos", True), 2: ("pos", None), 3: ("neg", None), 4: ("pos", None)}
    with pytest.raises(ValueError, match="unique"):
        review.merge_review(df, twice, "row_id", check=True)
