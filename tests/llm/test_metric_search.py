import random

import numpy as np
import pytest

from corpusmill.llm import metric_search


def expected(rows, k, chosen):
    v = {i: [int(np.floor(64 * float(np.float32(x)))) for x in e] for i, e in rows
         if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    out = []
    for q in filter(chosen, v):
        scored = sorted((-sum(a * b for a, b in zip(v[q], e)), i) for i, e in v.items() if i != q and len(e) == len(v[q]))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS cell")
    return sorted(map(tuple, metric_search.top_k(df, lambda i: i % 20 == 0, k).collect()))


@pytest.mark.parametrize("page,block", [(4096, 1024), (40, 7)])
def test_equals_brute_force(spark, monkeypatch, page, block):
    monkeypatch.setattr(metric_search, "PAGE", page)
    monkeypatch.setattr(metric_search, "BLOCK", block)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 520)]                       # ties
    assert search(spark, rows) == expected(rows, 20, lambda i: i % 20 == 0)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (100, []),
            (None, [1.0, 1.0]), (120, [1.0, 2.0, 3.0]), (3, [0.0, 0.0]), (5, [-1.0, 2.5]), (140, [3e6, 1.0]), (160, [1.0, 1.0]), (7, []), (8, [-3e6, 7e6]), (180, [3e7, -1e4])]
    assert search(spark, rows) == expected(rows, 20, lambda i: i % 20 == 0)
    assert search(spark, rows, k=1) == expected(rows, 1, lambda i: i % 20 == 0)
    assert search(spark, []) == [] and search(spark, [(20, [1.0])]) == []


def test_repeated_rows_are_candidates_of_others_only(spark):
    out = search(spark, [(20, [1.0]), (1, [2.0]), (1, [2.0])])
    assert out == [(20, 1, 1, 8192), (20, 2, 1, 8192)]
    assert all(q != v for q, _, v, _ in search(spark, [(20, [1.0]), (20, [1.0]), (1, [2.0])]))


def test_bounds_save_products():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16)) * 60
    v = np.floor(centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16)))
    tree, q, names = metric_search.Tree(np.arange(3000), v), v[:40], np.arange(40)
    best = metric_search.Best(40, 20)
    tree.search(q, names, best)
    scores = (q @ v.T).astype(int)
    for i in range(40):
        want = sorted((-scores[i, j], j) for j in range(3000) if j != i)[:20]
        assert [(-s, j) for s, j in zip(best.score[i].tolist(), best.id[i].tolist())] == want
    assert tree.products < 0.5 * scores.size


def test_large_components_are_exact_or_an_error(spark):
    """Products beyond 2^53 and beyond what doubles tell apart; a score or a component beyond 64 bits is no silent loss."""
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-2 ** 21, 2 ** 21)) * 2 ** rng.choice([0, 2]) for _ in range(6)]) for i in range(120)]
    assert search(spark, rows) == expected(rows, 20, lambda i: i % 20 == 0)
    for bad in (1e30, 3e12):
        with pytest.raises(Exception, match="does not fit a long"):
            search(spark, [*rows, (500, [bad, 0.0, 0.0, 0.0, 0.0, bad])])


def test_pages_out_of_reach_stay(spark, monkeypatch):
    """Far clusters: a block meets few pages, and the result is the same."""
    for name, value in (("PAGE", 40), ("BLOCK", 5), ("GROUP", 1), ("CHUNK", 7)):
        monkeypatch.setattr(metric_search, name, value)
    rng = random.Random(6)
    rows = []
    for c in range(8):
        centre = [100.0 * (k == c) for k in range(8)]
        rows += [(len(rows) + i, [x + rng.gauss(0, 0.1) for x in centre]) for i in range(60)]
    pairs = []
    inner = metric_search._within_reach

    def kept(*args):
        pairs.append(inner(*args))
        return pairs[-1]
    monkeypatch.setattr(metric_search, "_within_reach", kept)
    assert search(spark, rows) == expected(rows, 20, lambda i: i % 20 == 0)
    (met,) = pairs
    blocks = met.select("own_cell", "own_part").distinct().count()
    assert met.count() < 0.5 * blocks * 12                                  # of 12 pages at least
