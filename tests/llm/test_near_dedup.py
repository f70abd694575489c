import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa

from corpusmill.llm import near_dedup
from corpusmill.llm.words import word_slices

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_list(text, lower=False):
    data = (text or "").encode()
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), data) if lower else data)


def shingles(text, n):
    w = word_list(text, lower=True)
    return frozenset(zip(*(w[i:] for i in range(n)))) if len(w) >= n else frozenset([tuple(w)] if w else [])


def expected(rows, n, percent):
    """Components by comparing all pairs."""
    sets = [(k, shingles(t, n)) for k, t in rows if k is not None]
    up = {k: k for k, _ in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if a == b or x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((root(a), root(b)))
            up[high] = low
    return {k: root(k) for k in up}


def got(df):
    return {r["doc_id"]: r["component_id"] for r in df.collect() if r["doc_id"] is not None}


def test_words_of_odd_texts():
    texts = ["a b  c\td", "", None, " x ", "é\xa0z \x0b1\x0c2", "q" * 5000, "\n\n", "a"]
    (words,) = word_slices(pa.array(texts))
    found = [[words.text(k) for k in range(words.first[i], words.first[i + 1])] for i in range(len(texts))]
    assert found == [word_list(t) for t in texts]
    assert words.digests[0] == words.digests[-1]
    assert list(word_slices(pa.array([], pa.string()))) == []


def test_groups_equal_brute_force(spark, docs):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        text = [rng.choice(vocabulary) for _ in range(60)]
        for _ in range(rng.randint(1, 9)):
            copy = list(text)
            for _ in range(rng.randint(0, 7)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + 5, " ".join(copy)))
    rng.shuffle(rows)
    for n in (2, 5):
        out = near_dedup.near_duplicates(docs(rows), shingle=n)
        assert got(out) == expected(rows, n, 80)
        assert {r["doc_id"]: r["n_shingles"] for r in out.collect()} == {k: len(shingles(t, n)) for k, t in rows}


def test_large_group_beyond_a_small_node(spark, docs):
    rng = random.Random(5)
    text = [f"t{i}" for i in range(80)]
    rows = []
    for k in range(150):
        copy = list(text)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(80)] = f"own{rng.randrange(10 ** 6)}"
        rows.append((k, " ".join(copy)))
    assert got(near_dedup.near_duplicates(docs(rows), shingle=2)) == expected(rows, 2, 80)


def test_links_inside_a_large_node_at_the_last_look(spark, docs, monkeypatch):
    """A family that is alike below the threshold stays in one node; its links are far from all pivots."""
    for name, value in (("START_DEPTH", 0), ("MORE_DEPTH", 0), ("TILE", 16)):
        monkeypatch.setattr(near_dedup, name, value, raising=False)
    rng = random.Random(6)
    form = [f"form{i}" for i in range(60)]
    rows = []
    for k in range(90):
        own = [f"own{k}-{i}" for i in range(20)]
        rows += [(2 * k + i, " ".join(form + own[:20 - 2 * i])) for i in range(2)]
    rows += [(1000 + k, " ".join(f"t{i}" for i in range(80 - k % 3))) for k in range(40)]
    rng.shuffle(rows)
    want = expected(rows, 2, 80)
    assert len(set(want.values())) == 91
    assert got(near_dedup.near_duplicates(docs(rows), shingle=2)) == want


def test_nulls_blanks_and_repeats(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "ONE"), (None, "one"), (None, "alone here"), (7, "a b c"),
            (7, "a b c"), (8, "é É"), (9, "x " * 30000)]
    out = near_dedup.near_duplicates(docs(rows), shingle=2).collect()
    assert len(out) == len(rows)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out if r["doc_id"]) == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (7, 2, 7, True),
        (7, 2, 7, True), (8, 1, 8, True), (9, 1, 9, True)]
    assert sorted((r["component_id"] or 0, r["kept"]) for r in out if r["doc_id"] is None) == [(0, True), (4, False)]


def test_empty_table(spark, docs):
    assert near_dedup.near_duplicates(docs([])).collect() == []


def test_rows_that_repeat_a_key_are_one_document(spark, docs):
    rows = [(1, "a b c d"), (5, "a b c d"), (5, "k l m n"), (9, "k l m n")]
    assert got(near_dedup.near_duplicates(docs(rows), shingle=2)) == {1: 1, 5: 1, 9: 1}


def test_trees_reach_the_recall():
    for similarity in (0.7, 0.8, 0.9):
        trees = near_dedup.trees_for(similarity, 0.99999)
        assert near_dedup.lost(similarity, near_dedup.MAX_DEPTH) ** trees <= 1e-5
    sets = next(s for _, s in near_dedup.shingle_sets(pa.array(["a b a b"]), 2))
    assert len(sets) == 2 and (np.diff(sets.astype(float)) > 0).all()


def family(rng, base, n, own, size=80):
    """Texts that share ``base`` and replace about ``own`` of its words each."""
    out = []
    for _ in range(n):
        copy = list(base)
        for at in rng.sample(range(size), own):
            copy[at] = f"own{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


def test_outsiders_of_a_large_class(spark, docs, monkeypatch):
    """A class of near copies, and others that are alike to it just below and above the threshold."""
    for name, value in (("TILE", 16), ("SMALL_NODE", 8), ("TILE_TOKENS", 2_000)):
        monkeypatch.setattr(near_dedup, name, value)
    rng = random.Random(8)
    base = [f"t{i}" for i in range(80)]
    texts = family(rng, base, 120, 2) + [t for own in (6, 7, 8, 9, 10, 12) for t in family(rng, base, 12, own)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    for n in (1, 2):
        want = expected(rows, n, 80)
        assert 1 < len(set(want.values())) < len(rows)
        assert got(near_dedup.near_duplicates(docs(rows), shingle=n)) == want


def test_recall_of_pairs_at_the_threshold(spark, docs):
    """Pairs between 0.80 and 0.85, measured against all pairs of their own, far from any group."""
    rng = random.Random(9)
    rows = []
    for k in range(400):
        base = [f"p{k}-{i}" for i in range(100)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:80 + k % 5] + [f"q{k}"] * (k % 2)))]
    alike = [k for k in range(400) if (lambda x, y: 80 * len(x | y) <= 100 * len(x & y) <= 85 * len(x | y))(
        shingles(rows[2 * k][1], 1), shingles(rows[2 * k + 1][1], 1))]
    assert len(alike) >= 300
    found = got(near_dedup.near_duplicates(docs(rows), shingle=1))
    assert sum(found[2 * k + 1] == 2 * k for k in alike) >= 0.99 * len(alike)


def test_tile_links_equal_plain_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(40)]
    rows = [(7, 0, 0, int(k >= 25), k, s.astype(np.int64)) for k, s in enumerate(sets)] + [(8, 0, 0, 0, 99, sets[0])]
    batch = pa.RecordBatch.from_arrays(
        [*(pa.array([r[c] for r in rows], pa.int64()) for c in range(5)), pa.array([r[5] for r in rows], pa.list_(pa.int64()))],
        ["class", "i", "j", "side", "id", "tokens"])
    found = [x for b in near_dedup._tile_links(50)([batch.slice(0, 30), batch.slice(30)]) for x in zip(*(c.to_pylist() for c in b.columns))]
    like = {a: [b for b in range(25, 40) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 50 * len(np.union1d(sets[a], sets[b]))]
            for a in range(25)}
    assert {a for a, _ in found} == {a for a in like if like[a]} and all(b in like[a] for a, b in found)


def test_pairs_meet_in_tiles(spark, monkeypatch):
    """All listed pairs that are alike are confirmed, however small tiles are, and a partner goes to a tile once."""
    from corpusmill.llm.tables import Scratch
    rng = random.Random(2)
    texts = {k: " ".join(f"w{rng.randrange(3) if rng.random() < .15 else j}" for j in range(40)) for k in range(60)}
    pairs = [p for p in itertools.combinations(texts, 2) if rng.random() < .5]
    want = {(a, b) for a, b in pairs if 100 * len(shingles(texts[a], 2) & shingles(texts[b], 2))
            >= 60 * len(shingles(texts[a], 2) | shingles(texts[b], 2))}
    assert 0 < len(want) < len(pairs)
    scratch = Scratch(spark, "tiles")
    source = spark.createDataFrame(list(texts.items()), "id long, text string")
    about = spark.createDataFrame([(k, 0, 39, k % 2) for k in texts], "id long, sketch long, n_shingles long, alike long")
    join = near_dedup._Join(scratch, scratch.write_by(source.repartition(3, "id"), "id", 3, "texts"), 3, about, 2, 60)
    frame = spark.createDataFrame(pairs, "a long, b long")
    sets = join.read(frame.selectExpr("a AS id").union(frame.select("b")).distinct(), "t")
    assert len({r["id"] for r in sets.collect()}) == sets.count()
    for tile in (512, 4):
        monkeypatch.setattr(near_dedup, "TILE", tile)
        monkeypatch.setattr(near_dedup, "TILE_PAIRS", 16_384 if tile > 4 else 50)
        found = join.confirmed(frame, sets)
        assert sorted((r.a, r.b) for r in found.collect()) == sorted(want)
    scratch.keep_only()
    assert not scratch.tables


def test_tables_dealt_out_by_a_column_stay_where_they_are(spark):
    """A join on the column moves the other side only."""
    from corpusmill.llm.tables import Scratch
    scratch = Scratch(spark, "dealt")
    rows = scratch.write_by(spark.range(100).selectExpr("id", "'x' AS text").repartition(4, "id"), "id", 4, "rows")
    joined = rows.join(spark.range(0, 100, 3).hint("shuffle_hash"), "id", "left_semi")
    assert joined.count() == 34
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    name = scratch.tables["rows"]
    assert spark.catalog.tableExists(name)
    scratch.drop("rows")
    assert not spark.catalog.tableExists(name)


def test_pairs_well_below_the_threshold_are_left_out_by_prints(spark, docs):
    """Of a family that is alike at about 0.6, few pairs travel with their sets; no pair that is linked is left out."""
    from corpusmill.llm.tables import Scratch
    rng = random.Random(12)
    base = [f"t{i}" for i in range(200)]
    texts = dict(enumerate(family(rng, base, 50, 50, 200) + family(rng, base, 50, 6, 200)))
    scratch = Scratch(spark, "prints")
    source = docs(list(texts.items())).selectExpr("doc_id AS id", "text")
    schema = "id long, n_shingles long, low long, high long, sketch long, minima binary, prints array<long>"
    about = source.selectExpr("id AS key", "text").mapInArrow(near_dedup._signatures(1), schema.replace("id", "key", 1))
    about = about.selectExpr("key AS id", "sketch", "n_shingles", "1L AS alike", "prints")
    join = near_dedup._Join(scratch, scratch.write_by(source.repartition(3, "id"), "id", 3, "texts"), 3, about, 1, 80)
    pairs = list(itertools.combinations(texts, 2))
    alike = {(a, b) for a, b in pairs if (lambda x, y: 100 * len(x & y) >= 80 * len(x | y))(
        shingles(texts[a], 1), shingles(texts[b], 1))}
    join.check(spark.createDataFrame(pairs, "a long, b long"), "all")
    compared = {(r.a, r.b) for r in spark.read.parquet(f"{scratch.folder}/all").collect()}
    assert alike <= compared and len(compared) < len(alike) + 0.2 * (len(pairs) - len(alike))
    scratch.keep_only()


def test_prints_of_linked_pairs_differ_as_rarely_as_recall_allows():
    for similarity, recall in ((0.7, 0.999), (0.8, 0.99999), (0.9, 0.99999)):
        p, n = (1 - similarity) * 15 / 16, near_dedup.FUNCTIONS
        most = near_dedup.most_differing(similarity, recall)
        beyond = sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(most + 1, n + 1))
        trees = near_dedup.lost(similarity, near_dedup.MAX_DEPTH) ** near_dedup.trees_for(similarity, recall)
        assert beyond + trees <= 1 - recall and n * p < most < n
