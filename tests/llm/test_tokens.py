import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from corpusmill.llm import bpe, packing
from corpusmill.llm.tokens import Encoder, ranks_of, tokenizer_file

ODD = ["", " ", "\n\n  a", "a\tb  c d", "x<|endoftext|>y <|endoftext|>", "a  b\n \n c ", "\x1c!\x1c a", "don't  stop'll",
       "a b", "\U0001F600 z\r\n q", "trailing  ", "a\x85b c​ d", "é" * 700, "x" * 5000, "a" + "́" * 50, "!?" * 400]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(ranks_of(P.path("byte_bpe_multi_50k.tiktoken")))


def test_perfect_hash_is_minimal_and_exact(vocabulary):
    h = vocabulary.hash
    assert sorted(h.key_of_slot.tolist()) == list(range(h.n))
    assert h.find(vocabulary.tokens).tolist() == list(range(h.n))
    assert (h.find([b"surely not a token %d" % i for i in range(50)]) == -1).all()


def test_codec_equals_tiktoken(vocabulary, small):
    plain = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    pattern, codec = regex.compile(P.PATTERN), bpe.Codec(vocabulary)
    for text in ODD + [r["text"] for r in small("documents").limit(60).collect()]:
        ids = np.concatenate([np.zeros(0, np.uint32), *[codec.ids(p) for p in bpe.pieces_of(text, pattern)]])
        assert ids.tolist() == plain.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    assert codec.split and codec.whole


def test_encoded_rows(spark, vocabulary, docs):
    plain = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a"), (3, None)]
    df = docs(rows).withColumnRenamed("component_id", "n_tokens")
    out = bpe.encoded(df, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = plain.encode_ordinary(r["text"] or "")
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids) and r["odd name"] == 1
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.encoded(docs([]), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect() == []


def test_long_text_in_parts(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 7)
    pattern = regex.compile(P.PATTERN)
    text = "some words, 12 of them; and more  spaces\n\n here"
    assert [x for p in bpe.pieces_of(text, pattern) for x in p] == pattern.findall(text)


def test_encoder_equals_tokenizers(small):
    encoder = Encoder(*tokenizer_file(P.path("byte_bpe_50k.json")), P.PATTERN)
    judge = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for text in ODD + [r["text"] for r in small("documents").limit(60).collect()]:
        assert encoder.encode(text) == judge.encode(text, add_special_tokens=False).ids
    assert tokenizer_file(P.path("byte_bpe_50k.json"))[0] == ranks_of(P.path("byte_bpe_50k.tiktoken"))


def check_packed(pieces, texts, capacity):
    """Every id lies in one piece; sequences have no gap and at most ``capacity`` ids. Returns the padding."""
    judge = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(texts)
    for k, text in texts.items():
        ids = np.array(judge.encode(text or "", add_special_tokens=False).ids + [0], np.uint32)
        at = 0
        for p in sorted(by_doc[k], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            part = ids[at:at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(part.astype("<u4").tobytes())
            assert "ids" not in p.asDict() or list(p["ids"]) == part.tolist()
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_packing_whole_table(spark, small):
    df = small("documents")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    pieces = packing.pack(df.repartition(3), P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    assert check_packed(pieces, texts, 1024) == 0


def test_packing_odd_rows(spark, docs):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (3, "a"), (4, "word " * 5000), (5, "<|endoftext|>")]
    rows += [(k, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 90)))) for k in range(10, 60)]
    pieces = packing.pack(docs(rows), P.path("byte_bpe_50k.json"), P.PATTERN, capacity=64, ids=False).collect()
    assert check_packed(pieces, dict(rows), 64) == 0
    twice = packing.pack(docs([(None, "a b"), (7, "c"), (7, "c")]), P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    assert sum(p["length"] for p in twice) == 3 + 2 + 2
    assert packing.pack(docs([]), P.path("byte_bpe_50k.json"), P.PATTERN).collect() == []


def test_cuts_fill_their_classes():
    for capacity in (1024, 1000, 7):
        for n in (1, 2, 5, 999, 1024, 5000):
            assert sum(x for _, x in packing.cuts(n, capacity)) == n
            assert all(k * x <= capacity for k, x in packing.cuts(n, capacity))
