import random

from corpusmill.llm import substring_dedup

from test_near_dedup import word_list


def expected(rows, window):
    first = {}
    lists = [(k, [w.decode() for w in word_list(t)]) for k, t in rows]
    for k, w in lists:
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            if k is not None and (g not in first or k < first[g]):
                first[g] = k
    out = []
    for k, w in lists:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if k is not None and first[tuple(w[i:i + window])] < k:
                gone[i:i + window] = [True] * window
        out.append((k, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["key"], r["n_words"], r["n_removed"], r["kept_text"]) for r in df.collect()), key=str)


def test_equals_brute_force(spark, docs):
    rng = random.Random(1)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(5, 40))] for _ in range(6)]
    rows = []
    for k in rng.sample(range(1000), 60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.5 else [f"u{rng.randrange(40)}" for _ in range(rng.randint(1, 30))]
        rows.append((k, rng.choice([" ", "\n", "  \t"]).join(words)))
    for window in (13, 4):
        assert got(substring_dedup.removed_passages(docs(rows), window=window)) == expected(rows, window)


def test_repeats_within_a_text_nulls_and_ties(spark, docs):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(1, f"{passage} {passage}"), (2, None), (3, ""), (None, passage), (4, f"start {passage} end"),
            (4, f"start {passage} end"), (5, "same " * 5000), (6, "same " * 30), (7, " ".join(f"p{i}" for i in range(12)))]
    assert got(substring_dedup.removed_passages(docs(rows))) == expected(rows, 13)


def test_runs_and_carried_columns(spark, docs):
    passage = " ".join(f"p{i}" for i in range(15))
    df = docs([(1, passage), (2, f"a b {passage} c"), (3, " untouched  text ")])
    out = {r["doc_id"]: r for r in substring_dedup.without_passages(df).collect()}
    assert out[2]["text"] == "a b c" and out[3]["text"] == " untouched  text " and out[1]["text"] == passage
    assert substring_dedup.without_passages(df).columns == df.columns and out[2]["odd name"] == 1
    runs = {r["key"]: list(r["removed"]) for r in substring_dedup.removed_passages(df).collect()}
    assert runs == {1: [], 2: [2, 17], 3: []}


def test_empty_table(spark, docs):
    assert substring_dedup.removed_passages(docs([])).collect() == []


def test_positions_round_trip():
    import numpy as np
    for at in ([], [0], [3, 4, 70000, 5_000_000], list(range(100))):
        assert substring_dedup._positions(substring_dedup._gaps(np.array(at, np.int64))).tolist() == at
