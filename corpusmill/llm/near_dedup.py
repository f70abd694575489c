"""Near-duplicate groups: chosen-path set similarity join over word shingles.

A document is the set of its distinct word shingles. Minwise hash functions choose tokens of the
set. A tree starts with all documents in one node; every node picks one function, and with chance
``EXTRA`` a second one, and a document goes on to the child named by (function, chosen token). Two sets of similarity J
go together along one branch with probability J, so pairs well below the threshold thin out with every
level, while a pair at the threshold is lost by a tree with the chance of ``lost`` below. Independent
trees are repeated until the chance of losing a pair falls below ``1 - recall``.

Nodes are looked at after some levels. Small ones are compared exhaustively. In a node beyond
``SMALL_NODE`` every member is compared with four members (the extremes of four orders of the ids),
and linked members are contracted to one class. A group of thousands of near copies thereby costs a few
comparisons a member, and all pairs of it are never formed. Where other members stand beside a class that
has a good part of a node, they are compared with that whole class, once for all nodes: the full sets of
both meet in tiles of about ``TILE`` by ``TILE``, and only links come out. What is left of a node without such classes
is small, or grows further. Where it is still large and holds several classes when the trees end, all pairs of
different classes are compared, in tiles as well.
Every link is confirmed on the full sets; copies with equal sets are one vertex from the start. Before, pairs of
a family that is alike well below the threshold are left out by their prints: four bits of each chosen token. As many
differ by chance in a pair at the threshold only with what the trees leave of ``1 - recall``.

Texts are dealt out by id once; the sets that a check needs are made where the texts are. A set then goes to the tiles
where it has partners, once to each: partners that are alike share a minwise token, and with it a tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.graph import components
from corpusmill.llm.tables import Scratch
from corpusmill.llm.words import mix, seeded, word_slices

EXTRA = 0.4                  # chance that a node picks a second function
START_DEPTH = 3              # levels before nodes are looked at first
MORE_DEPTH = 4               # levels to the next look
LOOKS = 2
MAX_DEPTH = START_DEPTH + (LOOKS - 1) * MORE_DEPTH
SMALL_NODE = 32              # members up to which a node is compared exhaustively
TILE = 512                   # members, about, of a side of a tile
TILE_TOKENS = 300_000        # tokens, about, of their sets
TILE_PAIRS = 16_384          # pairs, about, that a tile confirms
BUCKET_SHINGLES = 4_000_000  # of the texts that are dealt out together
MOST_CLASSES = 64            # classes of a node that others are compared with as a whole
FUNCTIONS = 128              # minwise functions to pick from
SKETCH_BITS = 64
PRINT_BITS = 4               # of every function's minimum
ORDERS = (0, -1, 0x5555555555555555, 0x3333333333333333)     # of ids, by exclusive or

_MULTIPLY = (seeded(11, FUNCTIONS) >> np.uint64(31)).astype(np.uint32) | np.uint32(1)
_ADD = (seeded(12, FUNCTIONS) >> np.uint64(32)).astype(np.uint32)


def lost(similarity: float, depth: int) -> float:
    """Chance that one tree parts a pair of this similarity within ``depth`` levels."""
    q = 0.0
    for _ in range(depth):
        u = 1 - similarity + similarity * q
        q = (1 - EXTRA) * u + EXTRA * u * u
    return q


def trees_for(similarity: float, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost(similarity, MAX_DEPTH))))


def most_differing(similarity: float, recall: float) -> int:
    """Prints that may differ in a pair: more do so at this similarity with what ``recall`` allows beyond the trees' loss."""
    allowed = max(1 - recall - lost(similarity, MAX_DEPTH) ** trees_for(similarity, recall), 1e-11)
    p, most, beyond = (1 - similarity) * (1 - 2 ** -PRINT_BITS), FUNCTIONS, 0.0
    while most and (beyond := beyond + math.comb(FUNCTIONS, most) * p ** most * (1 - p) ** (FUNCTIONS - most)) <= allowed:
        most -= 1
    return most


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct digests of its shingles); a row of fewer words has one shingle."""
    for words in word_slices(column, lower=True):
        grams, _, bounds = words.ngrams(n)
        for i in range(len(bounds) - 1):
            if bounds[i] < bounds[i + 1]:
                yield words.rows.start + i, np.unique(grams[bounds[i]:bounds[i + 1]])
            else:
                own = words.digests[words.first[i]:words.first[i + 1]]
                whole = np.uint64(0)
                with np.errstate(over="ignore"):
                    for k, d in enumerate(own):
                        whole = whole * np.uint64(0x9FB21C651E98DF25) + d + np.uint64(k + 1)
                yield words.rows.start + i, mix(np.array([whole])) if len(own) else own


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            low, high = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            marks, minima, prints = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows, [None] * batch.num_rows
            held, rows, total = [], [], 0
            with np.errstate(over="ignore"):
                def flush():
                    tokens = (np.concatenate(held) >> np.uint64(32)).astype(np.uint32)
                    begins = np.concatenate([[0], np.cumsum([len(x) for x in held])[:-1]])
                    table = np.empty((len(held), FUNCTIONS), np.uint32)
                    for f in range(FUNCTIONS):
                        table[:, f] = np.minimum.reduceat(tokens * _MULTIPLY[f] + _ADD[f], begins)
                    bits = (table[:, :SKETCH_BITS] >> np.uint32(3)) & np.uint32(1)
                    sketch = (bits.astype(np.uint64) << np.arange(SKETCH_BITS, dtype=np.uint64)).sum(
                        axis=1, dtype=np.uint64)
                    own = ((table >> np.uint32(8)) & np.uint32((1 << PRINT_BITS) - 1)).astype(np.uint64)
                    own = own.reshape(len(held), -1, 64 // PRINT_BITS) << np.arange(0, 64, PRINT_BITS, dtype=np.uint64)
                    own = own.sum(axis=2, dtype=np.uint64).view(np.int64)
                    for k, row in enumerate(rows):
                        minima[row], prints[row] = table[k].tobytes(), own[k]
                        marks[row] = sketch[k].view(np.int64)
                    held.clear()
                    rows.clear()
                for row, tokens in shingle_sets(batch.column("text"), n):
                    sizes[row] = len(tokens)
                    if not len(tokens):
                        continue
                    low[row] = np.add.reduce(mix(tokens)).view(np.int64)
                    high[row] = np.add.reduce(mix(tokens ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)
                    held.append(tokens)
                    rows.append(row)
                    total += len(tokens)
                    if total > 200_000:
                        flush()
                        total = 0
                if held:
                    flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes), pa.array(low), pa.array(high), pa.array(marks),
                 pa.array(minima, pa.binary()), pa.array(prints, pa.list_(pa.int64()))],
                ["key", "n_shingles", "low", "high", "sketch", "minima", "prints"])
    return run


def _children(nodes: np.ndarray, rows: np.ndarray, minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child nodes and their rows; functions are picked by the node alone."""
    out_nodes, out_rows = [], []
    with np.errstate(over="ignore"):
        for j in range(2):
            pick = mix(nodes + np.uint64(j + 1))
            if j:
                again = (pick >> np.uint64(40)).astype(np.float64) < EXTRA * (1 << 24)
                pick, rows = pick[again], rows[again]
            f = (pick % np.uint64(FUNCTIONS)).astype(np.int64)
            out_nodes.append(mix(pick ^ mix(minima[rows, f].astype(np.uint64) + (f.astype(np.uint64) << np.uint64(40)))))
            out_rows.append(rows)
    return np.concatenate(out_nodes), np.concatenate(out_rows)


_ABOUT = ["id", "sketch", "n_shingles", "class"]


def _grow(levels: int, roots: np.ndarray | None = None):
    """Nodes ``levels`` further down, as an array for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            minima = np.frombuffer(b"".join(batch.column("minima").to_pylist()), np.uint32).reshape(n, FUNCTIONS)
            if roots is None:
                nodes, rows = batch.column("node").to_numpy().view(np.uint64), np.arange(n)
            else:
                nodes, rows = np.tile(roots, n), np.repeat(np.arange(n), len(roots))
            for _ in range(levels):
                nodes, rows = _children(nodes, rows, minima)
            order = np.argsort(rows, kind="stable")
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
            arrays = pa.ListArray.from_arrays(pa.array(offsets), pa.array(nodes[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), arrays], ["id", "nodes"])
    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None] * batch.num_rows
            for row, tokens in shingle_sets(batch.column("text"), n):
                found[row] = tokens.view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.int64()))], ["id", "tokens"])
    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80, recall: float = 0.99999) -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept.

    Documents are linked when ``100 * |intersection| >= percent * |union|`` of their distinct
    shingles of ``shingle`` words (A-Z lower-cased; fewer words are one shingle). ``component_id``
    is the smallest key that links reach, ``kept`` marks the document that has it.

    Null and blank texts have no shingles and stay alone. Rows that repeat a key are texts of one
    document. A row with a null key belongs to the group of an equal set, but links nothing more;
    without an equal set its component is null and it is kept. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "near")
    source = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    signed = scratch.write(source.mapInArrow(
        _signatures(shingle), "key long, n_shingles long, low long, high long, sketch long, minima binary, prints array<long>"),
        "signed")
    rows = scratch.write(signed.select("key", "n_shingles", "low", "high"), "rows")
    filled = rows.where("n_shingles > 0")
    classes = scratch.write(filled.groupBy("low", "high").agg(F.min("key").alias("id")), "classes")
    # The first row of each class is its vertex; equal rows of a class have equal minima.
    vertices = scratch.write(
        signed.where("n_shingles > 0").join(classes.where("id is not null"), ["low", "high"])
              .where("key = id").select("id", "low", "high", "n_shingles", "sketch", "minima", "prints")
              .dropDuplicates(["id", "low", "high"]), "vertices")
    scratch.drop("signed")
    names = scratch.write(vertices.withColumn("alike", F.xxhash64(F.substring("minima", 1, 4))).drop("minima"), "names")

    similarity = percent / 100
    size = names.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_SHINGLES))
    texts = source.select(F.col("key").alias("id"), "text").repartition(buckets, "id")
    texts = scratch.write_by(texts.join(names.select("id").hint("shuffle_hash"), "id", "left_semi"), "id", buckets, "texts")
    join = _Join(scratch, texts, buckets, names.select("id", "sketch", "n_shingles", "alike", "prints"), shingle, percent, recall)
    join.link(_one_key(filled, classes), "key")
    roots = seeded(77, trees_for(similarity, recall))
    schema = "id long, nodes array<long>"
    entries = vertices.select("id", "minima").mapInArrow(_grow(START_DEPTH, roots), schema)
    left = None
    for look in range(LOOKS):
        entries = entries.select("id", F.explode("nodes").alias("node"))
        large, left = join.look(scratch.write(join.shared(entries, look), f"nodes{look}"), left, look)
        scratch.drop(f"entries{look}")
        if look == LOOKS - 1 or large is None:
            break
        # Dealt out by document: the members of a large node don't grow their branches in one task.
        entries = scratch.write(
            large.select("id", "node").join(vertices.select("id", "minima"), "id").repartition(F.col("id"), F.col("node"))
                 .mapInArrow(_grow(MORE_DEPTH), schema), f"entries{look + 1}")
    scratch.drop("vertices")
    if large is not None:
        left = left.union(_tiled(large, similarity)).distinct()
    if left is not None:
        join.check(left, "last", apart=True)

    named = names.select("low", "high", "id").join(join.found, "id", "left").select(
        "low", "high", F.coalesce("component", "id").alias("component"))
    named = named.groupBy("low", "high").agg(F.min("component").alias("component"))
    out = rows.select("key", "n_shingles", "low", "high").join(
        named, (rows["low"] == named["low"]) & (rows["high"] == named["high"]) & (rows["n_shingles"] > 0), "left")
    component = F.coalesce("component", "key")
    out = scratch.write(out.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"),
                                   F.col("key").eqNullSafe(component).alias("kept")), "result")
    scratch.keep_only("result")
    return out


class _Join:
    """Links found so far: pairs that were compared, and classes of linked ids."""

    def __init__(self, scratch: Scratch, texts: DataFrame, buckets: int, vertices: DataFrame, shingle: int, percent: int,
                 recall: float = 0.99999):
        self.scratch, self.texts, self.buckets, self.vertices = scratch, texts, buckets, vertices
        self.shingle, self.percent = shingle, percent
        self.similarity = percent / 100
        self.most = most_differing(self.similarity, recall)
        self.found = vertices.sparkSession.createDataFrame([], "id long, component long")
        self.tested: DataFrame | None = None

    def shared(self, entries: DataFrame, number: int) -> DataFrame:
        """Entries (id, node) of nodes with several classes, with what is known of the members, and their number.

        Ids and nodes alone travel; most nodes have one member.
        """
        stats = entries.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
        kept = entries.join(stats, "node").join(self.vertices.drop("prints"), "id")
        if number:
            return _mixed(kept, self.found).select(*_ABOUT, "node", "members")
        return kept.withColumn("class", F.col("id")).select(*_ABOUT, "node", "members")

    def look(self, nodes: DataFrame, left: DataFrame | None, number: int) -> tuple[DataFrame | None, DataFrame | None]:
        """Compare within nodes, and the pairs ``left`` by the look before.

        Returns entries of nodes that are still large and mixed, and pairs that are left to compare.
        """
        stars, near = _stars(nodes, self.vertices, self.similarity), _exhaustive(nodes, self.similarity)
        if number:
            self.check(stars.union(near).union(left).distinct(), f"pairs{number}")
        else:
            # One link makes a member part of its class: most others needn't be confirmed then.
            stars = self.scratch.write(stars, "stars")
            self.check(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first", apart=True)
            self.check(stars, "others")
            self.scratch.drop("stars")
            self.check(near, "near")
        mixed = self.scratch.write(_mixed(nodes.where(F.col("members") > SMALL_NODE), self.found).select(*_ABOUT, "node"), f"mixed{number}")
        self.scratch.drop(f"nodes{number}")
        if mixed.isEmpty():
            return None, None
        sizes = mixed.groupBy("node").agg(F.count("*").alias("size"))
        big = self.scratch.write(
            mixed.groupBy("node", "class").agg(F.count("*").alias("n")).join(sizes, "node")
                 .where((F.col("n") > SMALL_NODE) & (F.col("n") * MOST_CLASSES > F.col("size"))).select("node", "class"), f"big{number}")
        x, c = mixed.alias("x"), big.alias("c")
        self.compare_with_classes(x.join(c, (F.col("x.node") == F.col("c.node")) & (F.col("x.class") != F.col("c.class"))).select(
            "x.id", "c.class").distinct(), str(number))
        rest = self.scratch.write(_crowded(mixed.join(big, ["node", "class"], "left_anti")), f"rest{number}")
        self.scratch.drop(f"mixed{number}")
        large = rest.where(F.col("members") > SMALL_NODE).select(*_ABOUT, "node")
        return None if large.isEmpty() else large, _exhaustive(rest, self.similarity)

    def compare_with_classes(self, met: DataFrame, name: str) -> None:
        """Links of documents to the classes in ``met`` (id, class), by the full sets of both.

        A class and its documents are dealt by digest to blocks, and each block of the one meets each of the other.
        """
        met = self.scratch.write(met, f"met{name}")
        if met.isEmpty():
            return
        members = _classed(self.vertices.select("id"), self.found, "id", "class").join(met.select("class").distinct(), "class")
        sides = met.select("class", "id", F.lit(0).alias("side")).union(members.select("class", "id", F.lit(1)))
        sides = self.scratch.write(sides, f"sides{name}")
        sets = self.read(sides.select("id").distinct(), f"met{name}")
        sized = sides.join(self.vertices.select("id", "n_shingles"), "id")
        blocks = sized.groupBy("class").agg(*[
            F.greatest(F.ceil(F.count_if(F.col("side") == k) / TILE), F.ceil(
                F.sum(F.when(F.col("side") == k, F.col("n_shingles"))) / TILE_TOKENS)).cast("int").alias(f"b{k}") for k in (0, 1)])
        own = F.when(F.col("side") == 0, F.col("b0")).otherwise(F.col("b1"))
        other = F.when(F.col("side") == 0, F.col("b1")).otherwise(F.col("b0"))
        k = F.pmod(F.xxhash64("id"), own).cast("int")
        tiles = sides.join(blocks, "class").select(
            "class", "side", "id", k.alias("k"), F.explode(F.sequence(F.lit(0), other - 1)).alias("o"))
        tiles = tiles.select("class", F.when(F.col("side") == 0, F.col("k")).otherwise(F.col("o")).alias("i"),
                             F.when(F.col("side") == 0, F.col("o")).otherwise(F.col("k")).alias("j"), "side", "id")
        full = tiles.join(sets, "id").select("class", "i", "j", "side", "id", "tokens")
        tile = ["class", "i", "j"]
        links = full.repartition(*tile).sortWithinPartitions(*tile, "side").mapInArrow(_tile_links(self.percent), "a long, b long")
        self.link(links, f"met{name}")
        self.scratch.drop(f"met{name}-sets")

    def read(self, ids: DataFrame, name: str) -> DataFrame | None:
        """The full sets of the documents in ``ids``, dealt out by id; None if there are no ids."""
        ids = self.scratch.write(ids, f"{name}-ends")
        if ids.isEmpty():
            return None
        found = self.texts.join(ids.hint("shuffle_hash"), "id", "left_semi").mapInArrow(
            _sets(self.shingle), "id long, tokens array<long>")
        return self.scratch.write_by(found, "id", self.buckets, f"{name}-sets")

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough.

        Pairs meet in tiles: first ids that share a minwise token are in the same tiles, up to a number of them and of their
        pairs, and a second id goes once to each tile where it has partners.
        """
        about = self.vertices.groupBy("id").agg(F.min("alike").alias("alike"), F.sum("n_shingles").alias("size"))
        firsts = pairs.groupBy(F.col("a").alias("id")).agg(F.collect_list("b").alias("others")).join(about, "id")
        blocks = firsts.groupBy("alike").agg(
            F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("size") / TILE_TOKENS)).cast("int").alias("na"),
            F.ceil(F.sum(F.size("others")) / TILE_PAIRS).cast("int").alias("nb"))
        dealt = firsts.join(blocks, "alike").select("alike", F.pmod(F.xxhash64("id"), "na").cast("int").alias("i"), "nb", "id", "others")
        tile = ["alike", "i", "j"]
        held = dealt.select("alike", "i", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("j"), F.lit(0).alias("side"), "id",
                            F.lit(None).cast("array<long>").alias("partners"))
        seconds = dealt.select("alike", "i", "nb", F.col("id").alias("a"), F.explode("others").alias("id"))
        seconds = seconds.withColumn("j", F.pmod(F.xxhash64("id"), "nb").cast("int")).groupBy(*tile, "id").agg(
            F.collect_list("a").alias("partners"))
        sides = held.unionByName(seconds.withColumn("side", F.lit(1)))
        full = sides.join(sets, "id").select(*tile, "side", "id", "partners", "tokens")
        return full.repartition(*tile).sortWithinPartitions(*tile, "side").mapInArrow(_pair_links(self.percent), "a long, b long")

    def promising(self, pairs: DataFrame) -> DataFrame:
        """Pairs with no more differing prints than linked ones have; of an id with several sets, any may be like the other."""
        ends = [self.vertices.select(F.col("id").alias(side), F.col("prints").alias(f"prints_{side}")) for side in "ab"]
        differing = sum(F.bit_count(_nibbles(F.col("prints_a")[k].bitwiseXOR(F.col("prints_b")[k])))
                        for k in range(FUNCTIONS * PRINT_BITS // 64))
        return pairs.join(ends[0], "a").join(ends[1], "b").where(differing <= self.most).select("a", "b").distinct()

    def check(self, pairs: DataFrame, name: str, apart: bool = False) -> None:
        """Confirm the pairs of different classes that weren't compared before, and merge what they link.

        With ``apart`` the pairs were picked by class already.
        """
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = self.scratch.write(self.promising(pairs if apart else _apart(pairs, self.found)), name)
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        sets = self.read(_ends(pairs), name)
        if sets is not None:
            self.link(self.confirmed(pairs, sets), name)
            self.scratch.drop(f"{name}-sets")

    def link(self, links: DataFrame, name: str) -> None:
        """Merge the classes that links connect."""
        links = self.scratch.write(links, f"{name}-confirmed")
        if not links.isEmpty():
            self.found = components(_grown(links, self.found), self.scratch, f"{name}-links")


def _nibbles(x: Column) -> Column:
    """The lowest bit of each four is set if any of them is."""
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    return x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111))


def _one_key(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the sets of rows that repeat a key."""
    owned = rows.join(classes, ["low", "high"]).select("key", "id").where("key is not null")
    repeated = owned.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("c")).where("a <> c")
    return owned.join(repeated, "key").select("a", F.col("id").alias("b")).where("a <> b")


def _crowded(entries: DataFrame) -> DataFrame:
    """Entries of nodes that hold several classes, with the node's number of members."""
    stats = entries.groupBy("node").agg(F.count("*").alias("members"), F.min("class").alias("c0"), F.max("class").alias("c1"))
    return entries.join(stats.where("c0 <> c1").select("node", "members"), "node")


def _tile_links(percent: int):
    """One link at most for each document (side 0) of a tile to a member of its class (side 1)."""
    def linked(docs: list, members: list) -> Iterator[tuple[int, int]]:
        if not docs or not members:
            return
        sizes = np.array([len(t) for _, t in members])
        owner = np.repeat(np.arange(len(members)), sizes)
        tokens = np.concatenate([t for _, t in members])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        for id, own in docs:
            low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            counts = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
            shared = np.bincount(owner[at], minlength=len(members))
            hits = np.flatnonzero(100 * shared >= percent * (len(own) + sizes - shared))
            if len(hits):
                yield id, members[hits[0]][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sides = None, ([], [])

        def links():
            found = list(linked(*sides))
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])
        for batch in batches:
            lists = batch.column("tokens")
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for n, row in enumerate(zip(*(batch.column(c).to_pylist() for c in ("class", "i", "j", "side", "id")))):
                if row[:3] != last:
                    if last is not None:
                        yield links()
                    last, sides = row[:3], ([], [])
                sides[row[3]].append((row[4], values[offsets[n]:offsets[n + 1]].copy()))
        if last is not None:
            yield links()
    return run


def _pair_links(percent: int):
    """The pairs of a tile that are linked: ids of side 0, and ids of side 1 with their partners on side 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, firsts = None, {}
        for batch in batches:
            lists, out = batch.column("tokens"), []
            values, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            for n, (*tile, side, id, partners) in enumerate(zip(*(
                    batch.column(c).to_pylist() for c in ("alike", "i", "j", "side", "id", "partners")))):
                own = values[offsets[n]:offsets[n + 1]]
                if tile != last:
                    last, firsts = tile, {}
                if side == 0:
                    firsts.setdefault(id, []).append(own.copy())
                    continue
                for a in partners:
                    for tokens in firsts.get(a, ()):
                        if 100 * min(len(own), len(tokens)) < percent * max(len(own), len(tokens), 1):
                            continue
                        at = np.searchsorted(own, tokens)
                        shared = int((own[np.minimum(at, len(own) - 1)] == tokens).sum())
                        if 100 * shared >= percent * (len(own) + len(tokens) - shared):
                            out.append((a, id))
                            break
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


def _classed(df: DataFrame, found: DataFrame, id: str, name: str) -> DataFrame:
    named = df.join(found.select(F.col("id").alias(id), F.col("component").alias("_class")), id, "left")
    return named.withColumn(name, F.coalesce("_class", id)).drop("_class")


def _mixed(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of nodes that hold several of the classes found so far, with those classes."""
    named = _classed(nodes.drop("class"), found, "id", "class")       # a column that needn't be there
    several = named.groupBy("node").agg(F.min("class").alias("c0"), F.max("class").alias("c1")).where("c0 <> c1")
    return named.join(several.select("node"), "node", "left_semi")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of different classes."""
    return _classed(_classed(pairs, found, "a", "ca"), found, "b", "cb").where("ca <> cb").select("a", "b")


def _may_link(similarity: float, a: str, b: str):
    """Whether the sizes and sketches of two sets allow a link.

    Bits of linked sets differ with probability (1 - J) / 2 at most; seven standard deviations
    above that keeps all but about one link in 10^11.
    """
    p = (1 - similarity) / 2
    most = p * SKETCH_BITS + 7 * math.sqrt(p * (1 - p) * SKETCH_BITS)
    na, nb = f"{a}.n_shingles", f"{b}.n_shingles"
    return ((F.bit_count(F.col(f"{a}.sketch").bitwiseXOR(F.col(f"{b}.sketch"))) <= F.lit(most))
            & (F.least(na, nb) >= F.greatest(na, nb) * (similarity - 1e-9)))


def _pairs(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _stars(nodes: DataFrame, vertices: DataFrame, similarity: float) -> DataFrame:
    """Pairs of every member with the pivots of its node, as far as sketches allow a link."""
    def extreme(c):
        return F.min(F.col("id").bitwiseXOR(F.lit(c).cast("long"))).bitwiseXOR(F.lit(c).cast("long"))
    pivots = nodes.groupBy("node").agg(F.array_distinct(F.array(*map(extreme, ORDERS))).alias("p"))
    pivots = pivots.select("node", F.explode("p").alias("id")).join(
        vertices.select("id", "sketch", "n_shingles"), "id").alias("p")
    n = nodes.alias("n")
    joined = n.join(pivots, (F.col("n.node") == F.col("p.node")) & (F.col("n.id") != F.col("p.id"))
                    & _may_link(similarity, "n", "p"))
    return joined.select(*_pairs("n.id", "p.id")).distinct()


def _exhaustive(nodes: DataFrame, similarity: float) -> DataFrame:
    """All pairs of different classes within the small nodes that sketches allow."""
    small = nodes.where(F.col("members") <= SMALL_NODE)
    x, y = small.alias("x"), small.alias("y")
    joined = x.join(y, (F.col("x.node") == F.col("y.node")) & (F.col("x.id") < F.col("y.id"))
                    & (F.col("x.class") != F.col("y.class")) & _may_link(similarity, "x", "y"))
    return joined.select(*_pairs("x.id", "y.id")).distinct()


def _tiled(nodes: DataFrame, similarity: float) -> DataFrame:
    """All pairs of different classes within nodes of any size that sketches allow.

    Members are dealt by digest to buckets of about ``TILE``, and two buckets of a node meet in a tile.
    A class beyond ``TILE`` members has buckets of its own, which don't meet each other. A pair that shares several
    nodes comes from the smallest of them.
    """
    counts = nodes.groupBy("node", "class").agg(F.count("*").alias("n"))
    own = F.col("n") > TILE
    owners = counts.groupBy("node", own.alias("big"), F.when(own, F.col("class")).otherwise(F.lit(0)).alias("owner")).agg(
        F.ceil(F.sum("n") / TILE).cast("int").alias("buckets"))
    others = owners.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.col("buckets") - 1), lambda k: F.struct(
        "big", "owner", k.alias("k")))).alias("other"))
    about = ["node", "id", "class", "sketch", "n_shingles", "nodes"]
    lists = nodes.groupBy("id").agg(F.collect_list("node").alias("nodes"))
    sized = nodes.join(lists, "id").join(counts.withColumnRenamed("n", "size"), ["node", "class"]).select(
        *about, (F.col("size") > TILE).alias("big"),
        F.when(F.col("size") > TILE, F.col("class")).otherwise(F.lit(0)).alias("owner"))
    mine = sized.join(owners, ["node", "big", "owner"]).select(*about, F.struct(
        "big", "owner", F.pmod(F.xxhash64("node", "id"), F.col("buckets")).cast("int").alias("k")).alias("mine"))
    met = mine.join(others, "node").where(
        "not (mine.big and other.big and mine.owner = other.owner)")
    x = met.where("mine <= other").withColumnsRenamed({"mine": "low", "other": "high"}).alias("x")
    y = met.where("other <= mine").withColumnsRenamed({"other": "low", "mine": "high"}).alias("y")
    joined = x.join(y, (F.col("x.node") == F.col("y.node")) & (F.col("x.low") == F.col("y.low"))
                    & (F.col("x.high") == F.col("y.high")) & (F.col("x.class") != F.col("y.class"))
                    & ((F.col("x.low") < F.col("x.high")) | (F.col("x.id") < F.col("y.id")))
                    & _may_link(similarity, "x", "y")
                    & (F.array_min(F.array_intersect("x.nodes", "y.nodes")) == F.col("x.node")))
    return joined.select(*_pairs("x.id", "y.id")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()


def _grown(links: DataFrame, found: DataFrame) -> DataFrame:
    """New links between the classes found so far, together with what made the classes."""
    named = _classed(_classed(links, found, "a", "ca"), found, "b", "cb")
    return named.select(F.col("ca").alias("a"), F.col("cb").alias("b")).union(found.select("id", "component"))
