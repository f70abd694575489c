import hashlib
import random

import numpy as np

from corpusmill.llm import edit_fingerprint as ef
from corpusmill.llm.words import mix


def walked(text):
    """The same fingerprint, one character at a time."""
    level, out, i, step = int(ef.level_of(len(text))), "", 0, 0
    digest = mix(np.array([ord(c) for c in text] or [0], np.uint64) + np.uint64(77)).tolist()
    chunks = {}
    while i < len(text):
        first = step - step % ef._CHUNK
        if first not in chunks:
            chunks[first] = ef._moves(first), ef._priority(np.arange(first, first + ef._CHUNK))
        moves, priority = chunks[first]
        if priority[step - first] >= level:
            out += f"{digest[i] >> 32 & 255:02x}"
        i += int(moves[step - first][digest[i] & (ef.CLASSES - 1)])
        step += 1
    return f"{level}:{out}"


def test_fingerprints_equal_plain_walks():
    rng = random.Random(1)
    texts = ["", "a", "é\U0001F600", "x" * 3000, "hello world " * 30]
    texts += ["".join(rng.choice("abcdefgh  ") for _ in range(rng.randint(1, 4000))) for _ in range(30)]
    assert ef.fingerprints(texts) == [walked(t) for t in texts]
    assert ef.fingerprints([]) == []


def test_likeness():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(2000))
    other = "".join(rng.choice("abcdefghijklmnop ") for _ in range(2000))
    one = text[:1990] + "z" + text[1990:]
    half = ef.edited(text, other)
    a, b, c, d = ef.fingerprints([text, other, one, half])
    assert ef.likeness(a, a) == 1 and ef.likeness(a, b) < 0.25 and ef.likeness(a, c) > 0.9
    assert 0.4 < ef.likeness(a, d) < 0.75
    assert ef.likeness("0:", "0:") == 1 and ef.likeness("0:", a) == 0
    longer = ef.fingerprints([text + other[:60] * 2])[0]                  # another level, the same start
    assert ef.likeness(a, longer) > 0.8


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    return {k: (len(t or ""), ef.edited(t or "", order[(i + 1) % len(order)][1] or ""), order[(i + 1) % len(order)][1] or "")
            for i, (k, t) in enumerate(order)}


def test_next_document_across_ranges(spark, docs, monkeypatch):
    monkeypatch.setattr(ef, "FLUSH_CHARS", 300)
    rng = random.Random(3)
    rows = [(k, None if k % 17 == 0 else "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 80))))
            for k in rng.sample(range(-500, 5000), 120)]
    want = expected(rows)
    out = ef.compared_to_next(docs(rows).repartition(5)).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        n, changed, following = want[r["doc_id"]]
        own, new, after = ef.fingerprints([texts[r["doc_id"]] or "", changed, following])
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (n, own, new)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert (r["near_edited"], r["near_next"]) == (ef.likeness(own, new), ef.likeness(own, after))


def test_few_null_and_repeated_keys(spark, docs):
    assert ef.compared_to_next(docs([])).collect() == []
    (one,) = ef.compared_to_next(docs([(5, "abcd")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1
    out = ef.compared_to_next(docs([(None, "x"), (1, "abcd"), (1, "abcd"), (2, "q" * 70000), (None, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in out) == [(0, 0), (0, 1), (1, 4), (1, 4), (2, 70000)]


def test_near_classes(spark, docs):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefghij ") for _ in range(900)) for _ in range(4)]
    rows = [(i, b) for i, b in enumerate(base)] + [(10 + i, b) for i, b in enumerate(base)]
    rows += [(20 + i, b[:880] + "!" + b[880:]) for i, b in enumerate(base)] + [(None, base[0]), (30, None), (31, "")]
    out = ef.near_classes(docs(rows)).collect()
    assert len(out) == len(rows)
    found = {r["doc_id"]: r["class_id"] for r in out}
    assert found == {**{10 * j + i: i for j in range(3) for i in range(4)}, None: None, 30: 30, 31: 30}
    assert ef.near_classes(docs([])).collect() == []


def chains(prints, least):
    """{key: class} by comparing all pairs of (key, fingerprint)."""
    up = {k: k for k, _ in prints}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if x == y or ef.likeness(x, y) >= least:
                low, high = sorted((root(a), root(b)))
                up[high] = low
    return {k: root(k) for k in up}


def test_classes_of_crowded_bands(spark, docs, monkeypatch):
    """Families around one opening: links far from a band's ends, with and without tiles."""
    rng = random.Random(7)
    letters = "abcdefghij "
    base = "".join(rng.choice(letters) for _ in range(700))
    rows = []
    for family in range(14):
        own = base[:460] + "".join(rng.choice(letters) for _ in range(240))
        for _ in range(9):
            at = rng.randrange(600)
            rows.append((rng.randrange(10 ** 9), own[:at] + rng.choice("xyz") + own[at + rng.randint(0, 1):]))
    prints = list(zip([k for k, _ in rows], ef.fingerprints([t for _, t in rows])))
    want = chains(prints, 0.8)
    assert 2 < len(set(want.values())) < len(rows) / 2
    for small, tile in ((32, 512), (3, 8)):
        monkeypatch.setattr(ef, "SMALL_BAND", small)
        monkeypatch.setattr(ef, "TILE", tile)
        assert {r["doc_id"]: r["class_id"] for r in ef.near_classes(docs(rows)).collect()} == want


def test_bands_find_pairs_at_the_threshold():
    """Measured on pairs alike to 0.80 to 0.85, for a corpus of a million texts."""
    rng = random.Random(8)
    length, count = ef.bands_for(10 ** 6, 0.8)
    assert length >= 5 and (1 - 0.8 ** length) ** count <= ef.LOST
    hits = pairs = 0
    while pairs < 150:
        text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randint(60, 3000)))
        copy = list(text)
        for _ in range(rng.randint(1, max(1, len(text) // 60))):
            copy[rng.randrange(len(copy))] = rng.choice("XYZ")
        a, b = ef.fingerprints([text, "".join(copy)])
        if 0.8 <= ef.likeness(a, b) <= 0.85:
            pairs += 1
            hits += not set(ef._bands(a, length, count)).isdisjoint(ef._bands(b, length, count))
    assert hits >= 0.98 * pairs
