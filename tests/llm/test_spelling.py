import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import spelling


def plain_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(rows, drop_every=None, min_length=6, min_count=5, ratio=5):
    counts = Counter()
    for key, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [v for v in words if plain_near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        return root(form[w]) if form[w] is not None else w
    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def got(df):
    out = df.collect()
    assert len({r["word"] for r in out}) == len(out)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out}


def variants(rng, word):
    at, letter = rng.randrange(len(word)), rng.choice("abàé÷ÿ")
    return rng.choice([word[:at] + word[at + 1:], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1:], word + letter])


def vocabulary(rng, n):
    words = set()
    while len(words) < n:
        word = "".join(rng.choice("abcdé") for _ in range(rng.randint(6, 11)))
        words.add(word)
        for _ in range(rng.randint(0, 6)):
            word = variants(rng, word)
            words.add(word)
    return sorted(words)


def test_index_equals_comparing_all_pairs():
    words = vocabulary(random.Random(1), 400) + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "bbbbbb"]
    found = [tuple(p) for p in spelling.one_error_apart(words).tolist()]
    assert len(found) == len(set(found))
    assert set(found) == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if plain_near(a, b)}


def test_index_of_very_long_words():
    word = "abcdefgh" * 4_000
    words = [word, word[:-1], word + "x", word[:9_000] + "é" + word[9_001:], "short", word[::-1]]
    pairs = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i != j and plain_near(a, b)}
    assert set(map(tuple, spelling.one_error_apart(words).tolist())) == pairs and pairs


def test_queries_run_in_pieces(monkeypatch):
    words = vocabulary(random.Random(2), 150)
    whole = set(map(tuple, spelling.one_error_apart(words).tolist()))
    monkeypatch.setattr(spelling, "CELLS", 500)
    assert set(map(tuple, spelling.one_error_apart(words).tolist())) == whole


@pytest.mark.parametrize("block, together", [(1 << 15, 4_096), (60, 10)])
def test_tiles_find_each_pair_once(spark, monkeypatch, block, together):
    """Small blocks: buckets are cut and meet in tiles."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    words = [w for w in vocabulary(random.Random(3), 500) if len(w) >= 6]
    df = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long").repartition(3)
    out = [tuple(r) for r in spelling.near_words(df).collect()]
    assert len(out) == len(set(out))
    assert set(out) == {(a, b, 5 + j) for a in words for j, b in enumerate(words) if plain_near(a, b)}


@pytest.mark.parametrize("drop_every", [None, 3, 199])
def test_groups_equal_brute_force(spark, docs, drop_every):
    rng = random.Random(drop_every or 0)
    words = vocabulary(rng, 60)
    weights = [rng.choice([1, 3, 15, 75, 400]) for _ in words]
    rows = [(i if i else None, rng.choice([" ", ", ", "1", "-"]).join(rng.choices(words, weights, k=120)).title()) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "× ÷ ÀÉß 12"), (73, rows[3][1]), (3, rows[3][1])]
    out = got(spelling.spelling_groups(docs(rows), drop_every=drop_every))
    assert out == plain_groups(rows, drop_every)
    assert any(form for form, *_ in out.values())


def test_forms_are_followed_to_the_last(spark, docs):
    chain = [("abcdef", 5), ("abcdeg", 25), ("abcdeh", 130), ("abcdehi", 700), ("abcdehij", 3600)]
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(chain)]
    out = got(spelling.spelling_groups(docs(rows)))
    assert out == plain_groups(rows)
    assert {w: root for w, (_, root, *_) in out.items()}["abcdeg"] == "abcdehij"


def test_nothing_to_find(docs):
    for rows in ([], [(1, None)], [(1, "too few words here")]):
        out = spelling.spelling_groups(docs(rows))
        assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0


def test_bits_beyond_one_word():
    """More than 64 index words, with a length no other word has."""
    words = [f"{a}{b}cdefg" for a in "abcdefghijkl" for b in "abcdefghijkl"] + ["z" * 40]
    found = spelling.one_error_apart(words)
    assert len(found) == 144 * 22 and np.all(found < 144)
