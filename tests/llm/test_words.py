import random

import numpy as np
import pyarrow as pa

from corpusmill.llm import quality_filter, words


def found(texts):
    return [(w.digests.tolist(), quality_filter._shapes(w).tolist()) for w in words.word_slices(pa.array(texts))]


def test_digests_do_not_depend_on_the_parts_that_are_looked_at(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join("aB9é"[rng.randrange(4)] * rng.randint(1, 9) for _ in range(rng.randint(0, 40))) for _ in range(50)]
    texts += [None, "", " ", "x" * 3000, "a" * 100 + "B" * 100 + " a"]
    whole = found(texts)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(words, "DIGEST_BYTES", size)
        assert found(texts) == whole
    assert whole[0][0][0] == words.digests(np.frombuffer(texts[0].split(" ")[0].encode(), np.uint8), np.array([0]), np.array(
        [len(texts[0].split(" ")[0].encode())]))[0]


def test_a_slice_of_text_needs_powers_for_a_part_of_it_only(monkeypatch):
    for name in ("up", "down"):
        monkeypatch.setattr(words._Powers, name, np.ones(1, np.uint64))
    found(["some words " * 200_000])
    assert len(words._Powers.up) <= 2 * words.DIGEST_BYTES < words.SLICE_BYTES
