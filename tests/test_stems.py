import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.stems import count_stems, stems_in
from corpusmill.operators import annotate


def test_stems_equal_contains(spark):
    rng = random.Random(4)
    stems = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 4))) for _ in range(40)} | {"a b", "\U0001F600", "xyzzy"})
    texts = [None, "", "a b", "\U0001F600é"] + ["".join(rng.choice("abcé ") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    groups = {s: {"pos"} if i % 3 == 0 else {"neg"} if i % 3 == 1 else {"pos", "neg"} for i, s in enumerate(stems)}
    out = df.select("id", stems_in(F.col("t"), stems).alias("s"), count_stems(F.col("t"), groups, ["pos", "neg"]).alias("c")).collect()
    for r in out:
        want = [i for i, s in enumerate(stems) if texts[r.id] and s in texts[r.id]]
        assert r.s == want
        assert [r.c.pos, r.c.neg] == [sum(side in groups[stems[i]] for i in want) for side in ("pos", "neg")]


@pytest.mark.parametrize("bound", [0, 20_000])
def test_table_lexicon_of_odd_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(annotate, "BROADCAST_STEMS", bound)
    lex = spark.createDataFrame([("AB", "pos"), ("ab", "pos"), ("ab", "neg"), ("", "pos"), (None, "neg"), ("b c", "neg")],
                                "stem string, polarity string")
    df = spark.createDataFrame([(1, "xABx"), (2, "b C"), (3, None), (4, "zz")], "row_id int, text string").withColumn("a.b", F.lit(1))
    got = sorted(tuple(r) for r in annotate.lexicon_matches(df, lex, "row_id").collect())
    assert got == [(1, "ab", "neg"), (1, "ab", "pos"), (2, "b c", "neg")]
    out = annotate.auto_label_from_table(df, lex, "row_id").orderBy("row_id").collect()
    assert [(r.auto_label, r.confidence) for r in out] == [("pos", 0.745), ("neg", 0.99), ("pos", 0.51), ("pos", 0.51)]


def test_empty_lexicon(spark):
    lex = spark.createDataFrame([], "stem string, polarity string")
    df = spark.createDataFrame([(1, "text")], "row_id int, text string")
    assert annotate.lexicon_matches(df, lex, "row_id").count() == 0
    assert annotate.auto_label_from_table(df, lex, "row_id").head()["confidence"] == 0.51
