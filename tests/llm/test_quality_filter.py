import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import quality_filter


def test_kth_largest(spark):
    values = [5.0, -3.5, 5.0, 1e9, 0.25, 0.25, -1e-9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in range(1, len(values) + 1):
        assert quality_filter.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]


def test_cut_between():
    good = np.array([False, False, True, True])
    assert quality_filter.cut_between(np.array([-9.0, -7, 1, 2]), good) == -3
    assert quality_filter.cut_between(np.array([1.0, 2]), np.array([True, True])) == -np.inf
    assert quality_filter.cut_between(np.array([]), np.array([], bool)) == -np.inf


def test_held_out_accuracy(small):
    """Fitted on the labels of even ids, judged on those of odd ones."""
    labels = small("labels")
    out = quality_filter.resample(small("documents"), labels.where("doc_id % 2 = 0"))
    rows = out.join(labels.where("doc_id % 2 = 1"), "doc_id").select("kept", "quality").collect()
    assert len(rows) > 20
    assert sum(r["kept"] == bool(r["quality"]) for r in rows) >= 0.95 * len(rows)


def test_fixed_k_and_determinism(spark, small):
    docs = small("documents")
    one = {r["doc_id"] for r in quality_filter.resample(docs, small("labels"), k=50).where("kept").collect()}
    two = {r["doc_id"] for r in quality_filter.resample(docs.repartition(7), small("labels"), k=50).where("kept").collect()}
    assert one == two and len(one) == 50


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "a b"), (3, "x " * 9000), (3, "x " * 9000)]])
def test_odd_rows(spark, docs, rows):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (3, 1)], "doc_id long, quality int")
    df = docs(rows)
    out = quality_filter.resample(df, labels)
    assert set(df.columns) | {"log_weight", "score"} == set(out.columns)
    found = out.collect()
    assert len(found) == len(rows) and all(r["kept"] is not None for r in found)
    assert all(r["log_weight"] == 0 for r in found if not r["text"])


# -- weights and draws by brute force ---------------------------------------------------

MASK = (1 << 64) - 1
BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def plain_mix(x):
    x &= MASK
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_digest(word):
    return plain_mix(sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(word)) + len(word) * STEP)


def plain_shape(word, before):
    kinds = [65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in word]
    runs = [k for i, k in enumerate(kinds) if not i or kinds[i - 1] != k]
    shape = plain_mix(sum((k + 7) * pow(BASE, i, 1 << 64) for i, k in enumerate(runs)))
    return plain_mix(plain_mix(shape + 99) if word == before else shape)


def plain_buckets(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    digests = [plain_digest(w) for w in words]
    shapes = [plain_shape(w, words[i - 1] if i else None) for i, w in enumerate(words)]
    out = []
    for salt, stream in ((1, digests), (2, shapes)):
        out += [plain_mix(x + salt) % quality_filter.BUCKETS for x in stream]
        out += [plain_mix(a * 31 + b + salt + 4) % quality_filter.BUCKETS for a, b in zip(stream, stream[1:])]
    return out


def test_weights_equal_plain_counts(spark, docs):
    rng = random.Random(1)
    vocabulary = ["word", "Word", "WORD", "x1", "2024", "!!!", "été", "a-b", "the", "of", "$$", "ÀÉ"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(80)] + [
        (90, None), (91, " \n"), (92, "the the the\tthe"), (93, "q" * 5_000)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 80, 2)] + [(4, 0), (4, 1)], "doc_id long, quality int")
    good = {i for i in range(0, 80, 2) if i % 3 and i != 4}
    counts = {k: Counter(plain_buckets(t)) for k, t in rows}
    raw, target = Counter(), Counter()
    for k, c in counts.items():
        raw.update(c)
        if k in good:
            target.update(c)
    b, r, t = quality_filter.BUCKETS, raw.total(), target.total()
    ratio = lambda x: math.log((target[x] + 1) / (t + b)) - math.log((raw[x] + 1) / (r + b))
    want = {k: sum(n * ratio(x) for x, n in c.items()) for k, c in counts.items()}
    out = {x["doc_id"]: x["log_weight"] for x in quality_filter.resample(docs(rows), labels).collect()}
    assert out == pytest.approx(want, abs=1e-9)


def test_draws_follow_weights(spark):
    """Noise is Gumbel's, so of two documents the one of three times the weight wins three times of four."""
    df = spark.range(8000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    scored = quality_filter._scored(df, "doc_id", "text", np.zeros(quality_filter.BUCKETS), 42)
    noise = np.array([r["score"] for r in scored.orderBy("doc_id").collect()])
    share = (np.argsort(np.argsort(noise)) + 0.5) / len(noise)
    assert np.abs(np.exp(-np.exp(-noise)) - share).max() < 0.02
    pairs = noise.reshape(-1, 2) + [0.0, math.log(3)]
    assert abs((pairs[:, 1] > pairs[:, 0]).mean() - 0.75) < 0.025


def test_kept_are_the_k_highest_scores(spark, small):
    out = quality_filter.resample(small("documents"), small("labels"), k=37).select("score", "kept").collect()
    cut = sorted((r["score"] for r in out), reverse=True)[36]
    assert all(r["kept"] == (r["score"] >= cut) for r in out)
