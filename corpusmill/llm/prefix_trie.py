"""Trie of conversations that share their first turns.

Turns are digests. Conversations, as sequences of digests, are sorted over the cluster; neighbours of
a sorted run share a prefix of some length (LCP). In every block of the sorted run a union-find takes
the LCP edges in descending depth: where two components merge, a branching node is created, or the
component whose top has that depth gets one child more. What is between a node and its parent is a
chain of nodes with the same members. Nodes that hold neither the first nor the last conversation of
their block are complete. The others are the block's contracted forest: two spines, whose nodes have
the sums of what is complete below them. Spines of all blocks are merged by the digest of the prefix,
and sums over subtrees of the merged nodes take as many rounds as the depth has binary digits.

Conversations of more than ``CHUNK`` turns are cut: a chunk is a row of the trie below the node where the
chunk before it ends, and its spine is merged like those of a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.ranks import ranked
from corpusmill.llm.tables import Scratch

CHUNK = 1_024                # turns of a row
BLOCK_ROWS = 50_000          # rows that one union-find takes
BLOCK_TURNS = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256().hexdigest()


def turns_of(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, turn, digest, words) of every turn; texts don't travel any further."""
    who, what = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    said = F.concat(F.length(who).cast("string"), F.lit(":"), who, what)
    return df.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.unhex(F.left(F.sha2(said, 256), F.lit(32))).alias("digest"),
        F.regexp_count(what, F.lit(WORD)).cast("long").alias("words"))


def steps_of(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(key, pos, digest, words) with positions from 1, and (key, n): conversations with their lengths.

    Positions come from the order of all turns, so one very long conversation is sorted by many tasks.
    """
    at = ranked(turns, ["key", "turn", "digest"])
    sizes = scratch.write(at.groupBy("key").agg(F.min("rank").alias("first"), F.count("*").alias("n")), "sizes")
    steps = at.join(sizes, "key").select("key", (F.col("rank") - F.col("first") + 1).alias("pos"), "digest", "words")
    return scratch.write(steps, "steps"), sizes.select("key", "n")


def with_shared_heads(steps: DataFrame, sizes: DataFrame, group: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with its first h turns taken from conversation c - c % ``group``.

    h is the crc32 of c, written in decimal, modulo ``most``. The other conversation gives what it has.
    """
    h = F.crc32(F.col("key").cast("string").cast("binary")) % most
    convs = sizes.select("key", "n", h.alias("h"), (F.col("key") - F.col("key") % group).alias("base"))
    there = sizes.select(F.col("key").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(there, "base", "left").select(
        "key", "n", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("k"))
    own = steps.join(convs.select("key", "h", "k"), "key").where("pos > h").select(
        "key", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "digest", "words")
    heads = steps.where((F.col("pos") < most) & (F.col("key") % group == 0)).withColumnRenamed("key", "base")
    lent = heads.join(convs.select("key", "base", "h"), "base").where("pos <= h").select("key", "pos", "digest", "words")
    return own.union(lent), convs.select("key", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))


# -- rows of the trie ----------------------------------------------------------------

def _after(token: bytes, chunk_hash: str) -> bytes:
    """Digest of the node that ends a full chunk."""
    return hashlib.sha256(token + bytes.fromhex(chunk_hash)).digest()[:16]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, chunk, token) of the chunks of cut conversations; ``hashes`` are those of their chunks, in order."""
    for batch in batches:
        out = []
        for key, hashes in zip(batch.column("key").to_pylist(), batch.column("hashes").to_pylist()):
            token = b""
            for k, h in enumerate(hashes):
                out.append((key, k, token))
                token = _after(token, h["hash"])
        keys, chunks, tokens = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(chunks, pa.int64()), pa.array(tokens, pa.binary())], ["key", "chunk", "token"])


def _hash(digests: Column) -> Column:
    return F.sha2(F.array_join(F.transform(digests, F.hex), ""), 256)


def _rows(steps: DataFrame, convs: DataFrame, chunk: int, scratch: Scratch) -> DataFrame:
    """(token, chunk, key, more, digests, words): one row per conversation and ``chunk`` turns."""
    number = F.floor((F.col("pos") - 1) / chunk).cast("long")
    turns = F.sort_array(F.collect_list(F.struct("pos", "digest", "words")))
    rows = steps.groupBy("key", number.alias("chunk")).agg(turns.alias("t")).select(
        "key", "chunk", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"))
    none = convs.where("n = 0").select("key", F.lit(0).cast("long").alias("chunk"),
                                       F.array().cast("array<binary>").alias("digests"), F.array().cast("array<bigint>").alias("words"))
    rows = rows.union(none)
    cut = convs.where(F.col("n") > chunk).select("key", "n")
    if cut.isEmpty():
        return rows.select(F.lit(b"").alias("token"), "chunk", "key", F.lit(False).alias("more"), "digests", "words")
    rows = scratch.write(rows, "chunks")
    hashes = rows.join(cut, "key", "left_semi").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("chunk", _hash(F.col("digests")).alias("hash")))).alias("hashes"))
    tokens = hashes.mapInArrow(_tokens, "key long, chunk long, token binary")
    rows = rows.join(tokens, ["key", "chunk"], "left").join(cut, "key", "left")
    more = F.coalesce((F.col("chunk") + 1) * chunk < F.col("n"), F.lit(False))
    return rows.select(F.coalesce("token", F.lit(b"")).alias("token"), "chunk", "key", more.alias("more"), "digests", "words")


# -- the forest of a block -------------------------------------------------------------

_FOUND = ("kind int, key long, depth long, parent_key long, id binary, parent binary, n long, children long, leaves long, "
          "saved long, words long, ends string")
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.string()]
DONE, SPINE, END = 0, 1, 2


def _common(a: list, b: list) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class Forest:
    """Nodes of one block of sorted rows (token, chunk, key, more, digests, words)."""

    def __init__(self, rows: list[tuple], chunk: int):
        self.rows, self.chunk, self.ids = rows, chunk, {}
        n = len(rows)
        self.depth = [len(r[4]) for r in rows]
        self.count, self.least = [1] * n, [r[2] for r in rows]
        self.ends = [[] if r[3] else [r[2]] for r in rows]
        self.kids: list[list[int]] = [[] for _ in rows]
        # A row whose prefixes are merged with other blocks or chunks; None for complete nodes.
        self.spine = [r if r in (0, n - 1) or rows[r][3] or not self.depth[r] else None for r in range(n)]
        self.row = list(range(n))
        self.tops = self._united()

    def _united(self) -> list[int]:
        """Merge components along LCP edges in descending depth; the tops that are left."""
        rows, up = self.rows, list(range(len(self.rows)))
        top = list(range(len(rows)))

        def find(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x
        edges = [(-_common(rows[i - 1][4], rows[i][4]), i) for i in range(1, len(rows)) if rows[i - 1][0] == rows[i][0]]
        for depth, i in sorted(edges):
            a, b = find(i - 1), find(i)
            x, y = top[a], top[b]
            if self.depth[x] == -depth:
                node = x
                if self.depth[y] == -depth:
                    self.ends[x] += self.ends[y]
                    self.kids[x] += self.kids[y]
                else:
                    self.kids[x].append(y)
                self._add(x, y)
            elif self.depth[y] == -depth:
                node = y
                self.kids[y].append(x)
                self._add(y, x)
            else:
                node = len(self.depth)
                for column, value in ((self.depth, -depth), (self.count, 0), (self.least, self.least[x]), (self.ends, []),
                                      (self.kids, [x, y]), (self.spine, None if depth else self.row[x]), (self.row, self.row[x])):
                    column.append(value)
                self._add(node, x)
                self._add(node, y)
            up[b], top[a] = a, node
        return [top[r] for r in range(len(rows)) if up[r] == r]

    def _add(self, x: int, y: int) -> None:
        self.count[x] += self.count[y]
        self.least[x] = min(self.least[x], self.least[y])
        if self.spine[x] is None:
            self.spine[x] = self.spine[y]

    def _id(self, row: int, depth: int) -> bytes:
        """Digest of the first ``depth`` turns of a row, and of what its chunk stands below."""
        if row not in self.ids:
            token, _, _, _, digests, _ = self.rows[row]
            found, running = [token], hashlib.sha256(token)
            for d in digests[:self.chunk - 1]:
                running.update(d)
                found.append(running.copy().digest()[:16])
            if len(digests) == self.chunk:
                whole = hashlib.sha256(b"".join(digests).hex().upper().encode()).hexdigest()
                found.append(_after(token, whole))
            self.ids[row] = found
        return self.ids[row][depth]

    def found(self) -> Iterator[tuple]:
        """Complete nodes, spine nodes and conversations that end in a spine node."""
        parent = {k: v for v in self._alive() for k in self.kids[v]}
        sums = {}
        for v in sorted(self._alive(), key=lambda v: -self.depth[v]):
            row = self.rows[self.row[v]]
            base, words, least, n = row[1] * self.chunk, row[5], self.least[v], self.count[v]
            done = [k for k in self.kids[v] if self.spine[k] is None]
            children, leaves = len(done), sum(sums[k][0] for k in done)
            saved = sum(sums[k][1] for k in done)
            low = self.depth[parent[v]] if v in parent else -1
            if self.spine[v] is not None:
                at = self.spine[v]
                for d in range(self.depth[v], low, -1):
                    yield (SPINE, least, base + d, None, self._id(at, d), self._id(at, d - 1) if d else None,
                           n if d or not row[1] else 0, children, leaves, saved, words[d - 1] if d else 0, None)
                    children = leaves = saved = 0
                for key in self.ends[v]:
                    yield END, key, None, None, self._id(at, self.depth[v]), None, None, None, None, None, None, None
                continue
            ends = hashlib.sha256(",".join(map(str, sorted(self.ends[v]))).encode()).hexdigest()
            leaves = leaves or 1
            for d in range(self.depth[v], max(low, 0), -1):
                saved += (n - 1) * words[d - 1]
                above, merged = least, None
                if d == low + 1 and v in parent:
                    over = parent[v]
                    above, merged = (self.least[over], None) if self.spine[over] is None else (None, self._id(self.spine[over], low))
                elif d == 1:
                    above, merged = None, row[0]
                yield DONE, least, base + d, above, None, merged, n, children, leaves, saved, None, ends
                children, ends = 1, EMPTY
            sums[v] = leaves, saved
            if v not in parent:
                yield SPINE, least, base, None, row[0], None, 0 if row[1] else n, 1, leaves, saved, 0, None

    def _alive(self) -> list[int]:
        out, left = [], list(self.tops)
        while left:
            v = left.pop()
            out.append(v)
            left += self.kids[v]
        return out


def _forests(chunk: int, block_rows: int, block_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0

        def flush():
            columns = zip(*Forest(held, chunk).found())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)],
                                              [c.split()[0] for c in _FOUND.split(", ")])
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                held.append(row)
                turns += len(row[4])
                if len(held) >= block_rows or turns >= block_turns:
                    yield flush()
                    held, turns = [], 0
        if held:
            yield flush()
    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, ends) from rows (id, key) sorted by both: keys go through the digest one by one."""
    last, digest = None, None
    for batch in batches:
        out = []
        for id, key in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist()):
            if id != last:
                if last is not None:
                    out.append((last, digest.hexdigest()))
                last, digest = id, hashlib.sha256(str(key).encode())
            else:
                digest.update(f",{key}".encode())
        if out:
            yield _ends_batch(out)
    if last is not None:
        yield _ends_batch([(last, digest.hexdigest())])


def _ends_batch(rows) -> pa.RecordBatch:
    ids, ends = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(ends, pa.string())], ["id", "ends"])


# -- merging ---------------------------------------------------------------------------

def _subtree_sums(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, leaves, saved) summed over the subtrees of a table (id, up, leaves, saved).

    After round r a node has the sums of all nodes less than 2^r below it, and ``up`` is 2^r above.
    """
    turn = 0
    while not nodes.where("up is not null").isEmpty():
        lifted = nodes.where("up is not null").groupBy(F.col("up").alias("id")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = nodes.select(F.col("id").alias("up"), F.col("up").alias("upper"))
        nodes = scratch.write(
            nodes.join(lifted, "id", "left").join(above, "up", "left").select(
                "id", F.col("upper").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), f"sums{turn}")
        turn += 1
    return nodes.select("id", "leaves", "saved")


def trie(steps: DataFrame, convs: DataFrame, scratch: Scratch, chunk: int = CHUNK, block_rows: int = BLOCK_ROWS,
         block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Nodes of the trie of ``steps`` (key, pos, digest, words) of the conversations ``convs`` (key, n)."""
    order = ["token", "digests", "key"]                       # the key parts equal conversations
    rows = _rows(steps, convs, chunk, scratch)
    found = scratch.write(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("token", "chunk", "key", "more", "digests", "words")
            .mapInArrow(_forests(chunk, block_rows, block_turns), _FOUND), "found")
    spine = found.where(F.col("kind") == SPINE).groupBy("id").agg(
        F.min("key").alias("key"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.max("words").alias("words"))
    spine = scratch.write(spine, "spine")
    below = spine.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("below"))
    spine = scratch.write(spine.join(below, "id", "left").withColumn("children", F.col("children") + F.coalesce("below", F.lit(0))),
                          "merged")
    own = spine.select(
        "id", F.col("parent").alias("up"), (F.col("leaves") + (F.col("children") == 0).cast("long")).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("words")).alias("saved"))
    sums = _subtree_sums(own, scratch)
    ends = (found.where(F.col("kind") == END).select("id", "key").repartition("id").sortWithinPartitions("id", "key")
                 .mapInArrow(_digested, "id binary, ends string"))
    above = spine.select(F.col("id").alias("parent"), F.col("key").alias("above"))
    merged = (spine.drop("leaves", "saved").join(sums, "id").join(ends, "id", "left").join(above, "parent", "left")
                   .select("key", "depth", F.col("above").alias("parent_key"), "n", "children", "leaves", "saved",
                           F.coalesce("ends", F.lit(EMPTY)).alias("ends")))
    done = (found.where(F.col("kind") == DONE).join(above, "parent", "left")
                 .select("key", "depth", F.coalesce("parent_key", "above").alias("parent_key"), "n", "children", "leaves",
                         "saved", "ends"))
    return merged.union(done)


def _named(nodes: DataFrame, key: str) -> DataFrame:
    return nodes.select(
        F.col("key").alias(key), "depth", F.col("parent_key").alias(f"parent_{key}"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"))


def conversation_trie(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                      shared: tuple[int, int] | None = None, **sizes) -> DataFrame:
    """One row per distinct sequence of first turns (role, text) of the conversations in ``df``, and one for the root.

    Columns: ``key`` (smallest conversation that starts so), depth, parent_<key>, n_convs, n_children, n_leaves (childless
    nodes of the subtree), saved_tokens (over the subtree, words of a node's last text times conversations but one) and
    ends_sha256 (digest of the conversations that end there, ascending, comma-joined). With ``shared`` = (g, m) every conversation
    c takes its first h turns from c - c % g, where h is the crc32 of c modulo m.

    Turns follow ``turn`` (null first), then a digest of role and text; null role or text is empty; repeated rows are
    turns of their own. Rows without a key are left out. Texts of any length are one digest. Other columns are
    ignored. An empty table has no node, not even a root.
    """
    scratch = Scratch(df.sparkSession, "trie")
    steps, convs = steps_of(turns_of(df, key, turn, role, text), scratch)
    if shared:
        steps, convs = with_shared_heads(steps, convs, *shared)
        convs = scratch.write(convs, "convs")
    return _named(trie(steps, convs, scratch, **sizes), key)
