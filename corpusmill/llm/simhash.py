"""Near-duplicate groups by SimHash, linked by multi-index hashing.

A fingerprint has 64 bits; a bit is set if more than half of the hashes of the text's word
shingles have it. Two fingerprints within ``DISTANCE`` = 2 bits differ by at most one bit in one
of their two halves. So each half is an index of its own: the small Hamming ball around a half
(the half itself and its neighbours by one bit) is enumerated and looked up among all halves, and
whole distances are verified. A pair that differs by one bit in a half is found from the side
that has the zero there, so 17 entries a half are looked up on average.

A half shared by more than ``CROWD`` different fingerprints is not compared pair by pair: there
the ball goes on through the other half, and what is looked up are whole fingerprints. The number
of looked-up rows is at most a constant per fingerprint either way, and every row that a crowded
half yields is a link. Equal fingerprints are one vertex from the start.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.graph import components
from corpusmill.llm.tables import Scratch
from corpusmill.llm.words import SPACE, Words, word_slices

DISTANCE = 2
HALF = 32
CROWD = 1_024                # fingerprints of a half that are compared pair by pair
SEED = 42
PIECE = 100_000              # shingles whose bits are counted together
LOW = (1 << HALF) - 1


def _joined(words: Words) -> tuple[memoryview, np.ndarray, np.ndarray]:
    """All words with one blank between them, and where each begins and ends there."""
    sizes = words.ends - words.starts
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    solid = np.flatnonzero(~SPACE[words.data])
    data = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    data[np.repeat(begins - words.starts, sizes) + solid] = words.data[solid]
    return memoryview(data.tobytes()), begins, begins + sizes


def fingerprint_of(column: pa.Array, n: int) -> Iterator[tuple[int, int]]:
    """(row, fingerprint as a signed 64-bit number) of every row; zero without words."""
    import xxhash
    for words in word_slices(column, lower=True):
        text, begins, ends = _joined(words)
        for i in range(len(words.first) - 1):
            low, high = int(words.first[i]), int(words.first[i + 1])
            if low == high:
                yield words.rows.start + i, 0
                continue
            width = min(n, high - low)
            last, ones = high - width + 1, np.zeros(64, np.int64)
            for at in range(low, last, PIECE):
                to = min(at + PIECE, last)
                spans = zip(begins[at:to].tolist(), ends[at + width - 1:to + width - 1].tolist())
                h = np.fromiter((xxhash.xxh64_intdigest(text[a:b], SEED) for a, b in spans), np.uint64, to - at)
                ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            bits = np.packbits(2 * ones > last - low)
            yield words.rows.start + i, int.from_bytes(bits.tobytes(), "big", signed=True)


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int64)
            for row, value in fingerprint_of(batch.column("text"), n):
                found[row] = value
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found)], ["key", "fp"])
    return run


def _half(side: int) -> Column:
    """One half of ``fp``, as a number of 32 bits."""
    return F.shiftrightunsigned("fp", HALF) if side == 0 else F.col("fp").bitwiseAND(F.lit(LOW))


def _numbers(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _masks(radius: int) -> list[int]:
    """All numbers of 32 bits with up to ``radius`` ones."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in itertools.combinations(range(HALF), r)]


def _close(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def fingerprint_links(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) of all different fingerprints ``fp`` within ``DISTANCE`` bits, some of them twice."""
    halves = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), _half(side).alias("value")) for side in (0, 1)])).alias("h")).select("fp", "h.*")
    crowded = scratch.write(halves.groupBy("side", "value").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select(
        "side", "value"), "crowded")
    ups = F.transform(_numbers(1 << b for b in range(HALF)), lambda bit: F.col("value").bitwiseOR(bit))
    probes = halves.select("fp", "side", F.col("value").alias("own"), F.explode(
        F.concat(F.array("value"), F.filter(ups, lambda v: v != F.col("value")))).alias("value"))
    index = halves.withColumnRenamed("fp", "b")
    if crowded.isEmpty():
        return _met(probes, index)
    mark = crowded.withColumn("hit", F.lit(True))
    probes = (probes.join(mark, ["side", "value"], "left")
                    .join(mark.select("side", F.col("value").alias("own"), F.col("hit").alias("hit_own")), ["side", "own"], "left")
                    .withColumn("crowd", F.coalesce("hit", "hit_own", F.lit(False))))
    few = _met(probes.where("not crowd"), index)
    return few.union(_whole(probes.where("crowd"), classes))


def _met(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Links between probes and the fingerprints that have the looked-up half."""
    once = (F.col("own") != F.col("value")) | (F.col("fp") < F.col("b"))
    return probes.join(index, ["side", "value"]).where(once & _close("fp", "b")).select(F.col("fp").alias("a"), "b")


def _whole(probes: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of probes whose half is crowded: the other half is enumerated too."""
    def ball(radius):
        other = F.when(F.col("side") == 0, F.col("fp").bitwiseAND(F.lit(LOW))).otherwise(F.shiftrightunsigned("fp", HALF))
        whole = lambda o: F.when(F.col("side") == 0, F.shiftleft("value", HALF).bitwiseOR(o)).otherwise(
            F.shiftleft(o, HALF).bitwiseOR(F.col("value")))
        return F.transform(_numbers(_masks(radius)), lambda m: whole(other.bitwiseXOR(m)))
    reach = F.when(F.col("own") == F.col("value"), ball(DISTANCE)).otherwise(ball(DISTANCE - 1))
    found = probes.select(F.col("fp").alias("a"), F.explode(reach).alias("fp")).where("a <> fp").join(classes, "fp")
    return found.select("a", F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """One row per document: key, fingerprint (16 hexadecimal digits), component_id.

    Documents are linked when their fingerprints differ by at most two bits; ``component_id`` is the
    smallest key that links reach. Shingles are runs of ``shingle`` words (A-Z lower-cased), repeats
    included, hashed by XXH64 with seed 42; fewer words are one shingle.

    Null, empty and blank texts have the fingerprint zero, which links like any other. Every row is
    a document of its own: rows that repeat a key have a row each. A row without a key takes part, but is
    no component's smallest key; with no keyed row in reach its component is null. Other columns are
    ignored. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    source = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = scratch.write(source.mapInArrow(_fingerprints(shingle), "key long, fp long"), "rows")
    classes = scratch.write(rows.groupBy("fp").agg(F.min("key").alias("first")), "classes")
    links = fingerprint_links(classes.select("fp"), scratch)
    found = components(links, scratch, "links")
    named = classes.join(found.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
