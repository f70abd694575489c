import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusmill.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def turn_digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def plain_trie(rows, shared=None):
    """Node rows by spelling out every prefix of every conversation."""
    own = defaultdict(list)
    for key, turn, role, text in rows:
        if key is not None:
            own[key].append((turn is not None, turn or 0, turn_digest(role or "", text or ""), role or "", text or ""))
    own = {k: [t[3:] for t in sorted(v)] for k, v in own.items()}
    convs = {}
    for c, turns in own.items():
        if shared:
            h = zlib.crc32(str(c).encode()) % shared[1]
            turns = own.get(c - c % shared[0], [])[:h] + turns[h:]
        convs[c] = tuple(turns)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        own_saved = (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own_saved
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if convs[c] == p).encode()).hexdigest())
        for p, m in members.items())


def got(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def conversations(rng, n, longest=7):
    said = [(r, t) for r in ("user", "assistant", None) for t in ("a b", "c", "", None, "d  e\tf g")]
    rows = []
    for c in range(n):
        if rows and rng.random() < 0.5:                       # a copy of another's beginning
            other = rng.randrange(c)
            turns = [r[2:] for r in rows if r[0] == other][:rng.randint(0, longest)]
        else:
            turns = []
        turns += [rng.choice(said) for _ in range(rng.randint(0 if turns else 1, longest - min(len(turns), longest - 1)))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("sizes", [
    {}, {"block_rows": 1}, {"block_rows": 3}, {"block_turns": 10}, {"chunk": 1}, {"chunk": 2, "block_rows": 4}, {"chunk": 3}])
@pytest.mark.parametrize("shared", [None, (20, 4)])
def test_nodes_equal_spelled_out_prefixes(spark, sizes, shared):
    rows = conversations(random.Random(11), 90)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(prefix_trie.conversation_trie(df, shared=shared, **sizes)) == plain_trie(rows, shared)


def test_long_conversations_are_cut(spark):
    rng = random.Random(2)
    base = [(rng.choice("ua"), rng.choice("xyz") * 2) for _ in range(60)]
    rows = []
    for c, (n, own) in enumerate([(60, 0), (60, 5), (33, 20), (32, 0), (32, 0), (16, 16), (8, 0), (60, 5), (0, 40)]):
        turns = base[:n] + [(str(c % 7), "w v")] * own
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA)
    for chunk in (4, 8, 16, 60, 1_024):
        assert got(prefix_trie.conversation_trie(df, chunk=chunk, block_rows=3)) == plain_trie(rows)


def test_many_equal_conversations(spark):
    rows = [(c, i, "user", f"turn {i}") for c in range(300) for i in range(3 if c < 250 else 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(prefix_trie.conversation_trie(df, block_rows=17)) == plain_trie(rows)


def test_odd_turns(spark):
    """Null turns, roles, texts and keys, equal turn numbers, repeated rows, negative ids, long texts."""
    rows = [(1, None, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "c"), (1, 0, "user", "c"), (2, None, None, None),
            (None, 1, "user", "z"), (-7, 3, "user", "w " * 50_000), (2, 5, "1:", "x"), (20, 1, "user", "a"), (23, 1, "q", "only"),
            (40, 9, "", ""), (41, 1, "user", "b"), (21, None, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'k' AS key", "2 AS pos", "3 AS `rank`")
    assert got(prefix_trie.conversation_trie(df)) == plain_trie(rows)
    assert got(prefix_trie.conversation_trie(df.where("conv_id > 0"), shared=(20, 4))) == plain_trie(
        [r for r in rows if (r[0] or 0) > 0], (20, 4))


def test_empty_table(spark):
    out = prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert out.count() == 0
