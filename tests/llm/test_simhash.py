import random
import re

import pyarrow as pa
import pytest
import xxhash

from corpusmill.llm import simhash
from corpusmill.llm.tables import Scratch

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, n=3):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """{key: smallest key reached} by comparing all pairs; keys are unique."""
    up = {k: k for k, _ in prints}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= 2:
                low, high = sorted((root(a), root(b)))
                up[high] = low
    return {k: root(k) for k in up}


def corpus(rng, n):
    words = [f"w{i}" for i in range(300)] + ["Été", "ÀB", "x y"]
    rows = []
    while len(rows) < n:
        text = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 40, 400]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(text)
            if copy and rng.random() < 0.8:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), rng.choice([" ", "\t", "  \n"]).join(copy)))
    return rows


def test_fingerprints_of_odd_texts():
    texts = ["a B  c\td", "", None, " x ", "one two", "é\xa0z \x0b1\x0c2 3", "\n\n", "Q " * 3000, "A b C D"]
    got = {r: v % 2**64 for r, v in simhash.fingerprint_of(pa.array(texts), 3)}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_long_texts_are_counted_in_pieces(monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice("abcdefgh") for _ in range(500))
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert dict(simhash.fingerprint_of(pa.array([text]), 3))[0] % 2**64 == plain_fingerprint(text)


def test_groups_equal_brute_force(spark, docs):
    rows = corpus(random.Random(7), 250) + [(1000, None), (1001, ""), (1002, " \n")]
    out = {r["doc_id"]: r for r in simhash.near_duplicates(docs(rows)).collect()}
    prints = [(k, plain_fingerprint(t)) for k, t in rows]
    assert {k: r["fingerprint"] for k, r in out.items()} == {k: f"{f:016x}" for k, f in prints}
    assert {k: r["component_id"] for k, r in out.items()} == plain_groups(prints)


@pytest.mark.parametrize("crowd", [1, 3, 1024])
def test_links_equal_brute_force_however_crowded(spark, crowd, monkeypatch):
    """Fingerprints in small balls, on both halves and with the highest bits set."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(crowd)
    found = {0, (1 << 64) - 1, 1 << 63, 1 << 31, 1 << 32}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(15):
            found.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    signed = [(v - 2**64 if v >> 63 else v,) for v in found]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long"), Scratch(spark, "test")).collect()
    got = {frozenset((a % 2**64, b % 2**64)) for a, b in links}
    assert got == {frozenset((a, b)) for a in found for b in found if a < b and (a ^ b).bit_count() <= 2}


def test_keys_that_are_null_or_repeat(spark):
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "other words stand here now"), (None, "alone in all of this"), (7, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS fingerprint", "1 AS fp", "2 AS key")
    got = sorted(((r[0], r[2]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (None, None), (7, 7), (9, 7)], key=str)


def test_empty_table(docs):
    out = simhash.near_duplicates(docs([]))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_whole_small_table(small):
    rows = [tuple(r) for r in small("documents").select("doc_id", "text").collect()]
    out = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(small("documents")).collect()}
    assert out == plain_groups([(k, plain_fingerprint(t)) for k, t in rows])
