"""Each stage on its own input, against brute force."""

import hashlib

import corpus_pipeline
import pytest

from test_near_dedup import expected as components
from test_secrets import base
from test_substring_dedup import expected as without_passages
from test_tokens import check_packed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input of the first stage and outputs of all, written and read again."""
    import pathlib
    if not pathlib.Path(SF).exists():
        pytest.skip("test tables are not here")
    folder = tmp_path_factory.mktemp("stages")
    found = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], SF).write.parquet(f"{folder}/{k}")
        found.append(spark.read.parquet(f"{folder}/{k}"))
    return found


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_stay(stages):
    assert all(sorted(s.columns) == sorted(stages[0].columns) for s in stages[1:-1])


def test_rejected_documents_are_the_labelled_bad_ones(spark, stages):
    kept = set(rows(stages[1]))
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        assert (r["doc_id"] in kept) == bool(r["quality"])


def test_one_of_each_group_stays(stages):
    texts = [(k, r["text"]) for k, r in rows(stages[1]).items()]
    assert set(rows(stages[2])) == set(components(texts, 5, 80).values())


def test_passages_go(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(before) == set(after)
    for k, _, n_removed, kept in without_passages([(k, r["text"]) for k, r in before.items()], 13):
        assert after[k]["text"] == (kept if n_removed else before[k]["text"])
        assert after[k]["n_chars"] == len(after[k]["text"])


def test_secrets_go_and_clean_texts_stay(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for k, r in before.items():
        spans = base(r["text"])
        assert ("[SECRET]" in after[k]["text"]) or not spans
        assert not base(after[k]["text"])
        if "[SECRET]" not in after[k]["text"]:
            assert after[k]["text"] == r["text"]


def test_pieces(stages):
    assert check_packed(stages[5].collect(), {k: r["text"] for k, r in rows(stages[4]).items()}, 1024) == 0


def test_run_is_the_chain_of_stages(spark, stages):
    def digest(df):
        return sorted(hashlib.sha256(repr((r["doc_id"], r["start"], r["length"], r["ids_crc32"])).encode()).hexdigest() for r in df.collect())
    assert digest(corpus_pipeline.run(spark, SF)) == digest(stages[5])


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Null and repeated keys, null, empty and long texts, repeated rows, and columns named like the operators' own."""
    folder = tmp_path_factory.mktemp("odd")
    shared = " ".join(f"shared{i}" for i in range(60))
    texts = [(None, shared), (None, shared), (None, "a row without an id that stays for itself"), (1, None), (2, ""), (3, shared),
             (4, shared + " more"), (5, "unique text of five with password=abc123 inside"), (5, "another text of five"), (6, "x y " * 40_000),
             (7, "unique text of seven"), (7, "unique text of seven"), (8, "short"), (None, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'s' AS secrets", "1 AS kept", "2 AS score", "3 AS log_weight", "4 AS _base", "5 AS _key", "6 AS n_chars", "7 AS key",
        "8 AS bucket", "9 AS `odd name`", "10 AS _column3", "11 AS component_id")
    spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return df, str(folder)


def test_odd_rows_and_clashing_columns(spark, odd, tmp_path):
    df, folder = odd
    at, seen = df, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, folder).write.parquet(str(tmp_path / str(k)))
        at = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(at)
    for out in seen[:-1]:
        assert out.columns == df.columns
        for r in out.collect():
            assert [r[c] for c in ("secrets", "kept", "score", "log_weight", "_base", "_key", "key", "bucket", "odd name", "_column3",
                                   "component_id")] == ["s", 1, 2, 3, 4, 5, 7, 8, 9, 10, 11]
    count = lambda out: sorted(((r["doc_id"] or 0, (r["text"] or "")[:12]) for r in out.collect()))
    assert len(seen[0].collect()) == 14
    # Copies of the shared text go, those without an id included; a null text is no copy of another.
    assert count(seen[1]) == sorted([(0, "a row withou"), (0, ""), (1, ""), (2, ""), (3, "shared0 shar"), (5, "unique text "),
                                     (5, "another text"), (6, "x y x y x y "), (7, "unique text "), (7, "unique text "), (8, "short")])
    masked = [r["text"] for r in seen[3].collect() if r["doc_id"] == 5]
    assert sorted(masked) == ["another text of five", "unique text of five with [SECRET] inside"]
    assert all(r["n_chars"] == len(r["text"] or "") or r["text"] is None for r in seen[3].collect())


def test_empty_table(spark, odd):
    df, folder = odd
    at = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, folder)
    assert at.count() == 0
