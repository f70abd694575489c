from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import token_rollup
from corpusmill.llm.queries import QUERIES
from corpusmill.llm.tokens import tokenizer_file

KIND = "source string, lang string, version string, tokens long, extra int"


def totals(rollup):
    return {(r["source"], r["lang"], r["version"]): (r["documents"], r["tokens"]) for r in rollup.totals().collect()}


def test_batches_add_up_and_commit_once(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    assert totals(rollup) == {}
    rows = spark.createDataFrame([("a", "en", "1", 5, 0), ("a", "en", "1", 7, 0), (None, "en", "1", None, 0), ("b", None, "1", 3, 0)], KIND)
    assert rollup.commit("load", token_rollup.inserts(rows))
    assert not rollup.commit("load", token_rollup.inserts(rows))
    assert totals(rollup) == {("a", "en", "1"): (2, 12), (None, "en", "1"): (1, 0), ("b", None, "1"): (1, 3)}
    rollup.commit("out", token_rollup.deletes(rows.where("source = 'b' or tokens = 7")))
    rollup.commit("again", token_rollup.revisions(spark.createDataFrame(
        [("a", "en", "1", 5, 9)], "source string, lang string, version string, before long, after long")))
    assert totals(rollup) == {("a", "en", "1"): (1, 9), (None, "en", "1"): (1, 0)}
    assert rollup.commit("empty", token_rollup.inserts(rows.limit(0)))
    assert rollup.committed() == ["again", "empty", "load", "out"]


def test_failed_batch_does_not_count(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    rows = token_rollup.inserts(spark.createDataFrame([("a", "en", "1", 5, 0)], KIND))
    rollup.commit("one", rows)
    (tmp_path / "r" / "one" / "_SUCCESS").unlink()                          # as if the job had died
    assert totals(rollup) == {}
    assert rollup.commit("one", rows) and totals(rollup) == {("a", "en", "1"): (1, 5)}
    with pytest.raises(ValueError):
        rollup.commit("../x", rows)


def test_counts_of_texts(spark):
    ranks, special = tokenizer_file(P.path("byte_bpe_50k.json"))
    df = spark.createDataFrame([("two words",), ("",), (None,), ("x " * 20000,)], "text string")
    judge = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out = df.select(token_rollup.counted(F.col("text"), {"v": (ranks, special, P.PATTERN)}).alias("m")).collect()
    assert [r["m"]["v"] for r in out] == [len(judge.encode(t, add_special_tokens=False).ids) for t in ("two words", "", "", "x " * 20000)]


def test_query_equals_counts_of_what_is_left(spark, small):
    toxic = {r["doc_id"] for r in small("labels").where("toxic = 1").collect()}
    judge, want = Tokenizer.from_file(P.path("byte_bpe_50k.json")), Counter()
    for r in small("documents").collect():
        if r["doc_id"] not in toxic:
            n = len(judge.encode((r["text"] or "").strip(" "), add_special_tokens=False).ids)
            want[r["source"], r["lang"], "documents"] += 1
            want[r["source"], r["lang"], "tokens"] += n
    got = Counter()
    for r in QUERIES["op10_token_rollup"](spark, "/root/testdata/sf0.001").where("version = 'byte_bpe_50k'").collect():
        got[r["source"], r["lang"], "documents"] = r["documents"]
        got[r["source"], r["lang"], "tokens"] = r["tokens"]
    assert got == want
