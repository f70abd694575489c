"""Fingerprints of documents by a randomised embedding of edit distance into Hamming distance.

All texts walk along the same random functions: at step j a text shows its current character, and
moves on or stays by a random bit of (j, character). Two texts that differ by few edits fall back
into step soon after each edit and show equal characters at most steps, whatever the shifts
between them. A fingerprint keeps the characters at sampled steps. The samples of a long
text are a subset of those of a short one (by halving levels), so lengths need not be equal.

Likeness is the share of equal samples. Near copies are found by bands of samples, picked from all of
them and longer for a larger corpus, and each candidate is verified on all samples. Members of a band are
compared with its two ends first; where a band still holds several classes, all pairs of different classes are, in tiles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.graph import components
from corpusmill.llm.tables import Scratch
from corpusmill.llm.words import mix

SAMPLES = 128                 # of a text at most, about; at least half as many for a long one
CLASSES = 64                  # that characters fall into for the walk
FLUSH_CHARS = 6_000_000       # texts that walk together
BUCKET_CHARS = 12_000_000     # of texts that are in order in one task
LEAST_BUCKETS, MOST_BUCKETS = 32, 4096
LEAST_BAND = 4                # samples of a band
CHANCE = 0.08                 # that samples of unrelated texts are equal, about
LOST = 1e-3                   # chance that no band finds a pair at the threshold
SIZES = 1.25                  # step between the numbers of samples that bands are picked from
SMALL_BAND, TILE = 32, 512    # members that meet as pairs; members of a side of a tile, about
_CHUNK = 4096                 # steps whose random bits are made together
_HEX = np.array([f"{i:02x}" for i in range(256)])


def level_of(n_chars: np.ndarray | int) -> np.ndarray:
    """Halvings of the sampled steps, so that a walk of about 2 n steps keeps ``SAMPLES`` or fewer."""
    steps = np.maximum(2 * np.asarray(n_chars, np.int64), 1)
    return np.maximum(0, np.ceil(np.log2(steps / SAMPLES))).astype(np.int64)


def _priority(steps: np.ndarray) -> np.ndarray:
    """The level up to which each step is sampled: trailing zeros of a digest."""
    x = mix(steps.astype(np.uint64) + np.uint64(0x1234567)) | np.uint64(1 << 40)
    with np.errstate(over="ignore"):
        low = x & (~x + np.uint64(1))
    return np.log2(low.astype(float)).astype(np.int64)


def _moves(first: int) -> np.ndarray:
    """Whether a character of each class moves a text on, for ``_CHUNK`` steps; the end never does."""
    words = mix(np.arange(first, first + _CHUNK, dtype=np.uint64) + np.uint64(0xABCDEF1234))
    bits = np.unpackbits(words.view(np.uint8).reshape(_CHUNK, 8), axis=1)
    return np.concatenate([bits, np.zeros((_CHUNK, 1), np.uint8)], axis=1).astype(np.int64)


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints "level:samples" with two hexadecimal digits a sample; empty texts have none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out = [f"{x}:" for x in level_of(sizes)]
    points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    digest = mix(points.astype(np.uint64) + np.uint64(77))
    kind, shown = (digest & np.uint64(CLASSES - 1)).astype(np.uint8), (digest >> np.uint64(32)).astype(np.uint8)
    end = np.cumsum(sizes + 1) - 1
    kind[end] = CLASSES                                  # every text ends with a place of its own
    row = np.flatnonzero(sizes)
    at, stop, level = (end - sizes)[row], end[row], level_of(sizes[row])
    rows_seen, shown_seen, step = [], [], 0
    while len(row):
        moves, priority = _moves(step), _priority(np.arange(step, step + _CHUNK))
        lowest = level.min()
        for j in range(_CHUNK):
            if priority[j] >= lowest:
                some = np.flatnonzero((level <= priority[j]) & (at < stop))
                rows_seen.append(row[some])
                shown_seen.append(shown[at[some]])
            at += moves[j].take(kind.take(at))
            if j % 128 == 127:
                live = at < stop
                if 8 * np.count_nonzero(live) < 7 * len(live) or not live.any():
                    row, at, stop, level = row[live], at[live], stop[live], level[live]
                    if not len(row):
                        break
                    lowest = level.min()
        step += _CHUNK
    if rows_seen:
        seen, values = np.concatenate(rows_seen), np.concatenate(shown_seen)
        order = np.argsort(seen, kind="stable")
        seen, values = seen[order], values[order]
        for part in np.split(np.arange(len(seen)), np.flatnonzero(np.diff(seen)) + 1):
            out[seen[part[0]]] += "".join(_HEX[values[part]])
    return out


class _Steps:
    """Sampled steps of a level, kept by the worker."""

    known: dict = {}

    @classmethod
    def priorities(cls, level: int, n: int) -> np.ndarray:
        """Priorities of the first ``n`` steps that ``level`` samples."""
        found = cls.known.get(level)
        if found is None or len(found) < n:
            size = max(4 * SAMPLES, 2 * n) << level
            found = _priority(np.arange(size))
            found = cls.known[level] = found[found >= level]
        return found[:n]


def samples_at(fingerprint: str, level: int) -> np.ndarray:
    """The samples that a higher level would have kept."""
    own, _, digits = fingerprint.partition(":")
    values = np.frombuffer(bytes.fromhex(digits), np.uint8)
    return values if int(own) == level else values[_Steps.priorities(int(own), len(values)) >= level]


def likeness(a: str, b: str) -> float:
    """Share of equal samples, from 0 to 1; two texts without samples are alike."""
    level = max(int(a.partition(":")[0]), int(b.partition(":")[0]))
    x, y = samples_at(a, level), samples_at(b, level)
    n, most = min(len(x), len(y)), max(len(x), len(y))
    return float(np.count_nonzero(x[:n] == y[:n]) / most) if most else 1.0 if a == b else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first as many characters of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (key, text, next text) with fingerprints and likenesses."""
    own, after = [t for _, t, _ in rows], [n for _, _, n in rows]
    changed = [edited(t, n) for t, n in zip(own, after)]
    # A row's next text is the following row's own one, but for the last.
    found = fingerprints(own + [after[-1]] + changed)
    mine, theirs, new = found[:len(own)], found[1:len(own) + 1], found[len(own) + 1:]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _, _ in rows], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
         pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]), pa.array(mine), pa.array(new),
         pa.array([likeness(a, b) for a, b in zip(mine, new)]), pa.array([likeness(a, b) for a, b in zip(mine, theirs)])],
        ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of some buckets, in order; each bucket ends with the first row of the next one."""
    rows, chars, held = [], 0, None
    for batch in batches:
        for bucket, peek, key, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "peek", "key", "text"))):
            if held is not None and held[0] == bucket:
                rows.append((held[1], held[2], text))
                chars += 2 * len(held[2]) + 1
                if peek or chars >= FLUSH_CHARS:
                    yield _compared(rows)
                    rows, chars = [], 0
            held = None if peek else (bucket, key, text)


def compared_to_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, by falling key; after the last comes the first again.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Null texts are empty. Null keys come after all others; rows that repeat a key follow one another
    by a digest of their text. A single document is its own next one; an empty table has no rows.
    Other columns are ignored.

    Documents move once, dealt out by ranges of the key. The first document of every range, found
    beforehand from keys alone, is sent to the range before as well.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    source = docs.select(F.col(f"`{key}`").cast("long").alias("key"), body.alias("text")).withColumn(
        "place", F.coalesce("key", F.lit(-(1 << 63)))).withColumn("digest", F.xxhash64("text"))
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-chars // BUCKET_CHARS)))
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = np.unique(np.array(source.agg(F.percentile_approx("place", probs, 10 * buckets)).first()[0] or [0], np.int64))

    @F.arrow_udf("int")
    def bucket_of(place: pa.Array) -> pa.Array:
        return pa.array((len(bounds) - np.searchsorted(bounds, place.to_numpy(), "right")).astype(np.int32))

    source = source.withColumn("bucket", bucket_of("place"))
    firsts = sorted(source.groupBy("bucket").agg(F.max(F.struct("place", "digest")).alias("first")).collect())
    peeks = [(b["bucket"], a["first"]["place"], a["first"]["digest"])
             for b, a in zip(firsts, firsts[1:] + firsts[:1])]
    heads = docs.sparkSession.createDataFrame(peeks, "target int, place long, digest long").groupBy(
        "place", "digest").agg(F.collect_list("target").alias("targets"))
    dealt = source.join(F.broadcast(heads), ["place", "digest"], "left").withColumn("to", F.explode(F.concat(
        F.array(F.struct("bucket", F.lit(False).alias("peek"))),
        F.coalesce(F.transform("targets", lambda t: F.struct(t.alias("bucket"), F.lit(True).alias("peek"))), F.array()))))
    dealt = dealt.select("to.bucket", "to.peek", "place", "digest", "key", "text").repartition(buckets, "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "peek", F.desc("place"), F.desc("digest"))
    return ordered.select("bucket", "peek", "key", "text").mapInArrow(
        _in_order, "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                   "near_edited double, near_next double").withColumnRenamed("key", key)


def fingerprint_of(text: Column) -> Column:
    """The fingerprint of a text; that of the empty text for a null."""
    @F.arrow_udf("string")
    def walk(column: pa.Array) -> pa.Array:
        texts, out, start = [x or "" for x in column.to_pylist()], [], 0
        while start < len(texts):
            end, chars = start, 0
            while end < len(texts) and (end == start or chars + len(texts[end]) <= FLUSH_CHARS):
                chars += len(texts[end])
                end += 1
            out += fingerprints(texts[start:end])
            start = end
        return pa.array(out, pa.string())
    return walk(text.cast("string"))


def bands_for(texts: int, least: float) -> tuple[int, int]:
    """Samples of a band, so that unrelated texts hardly share one, and how many bands ``LOST`` takes."""
    length = max(LEAST_BAND, math.ceil(math.log(max(2, texts)) / -math.log(CHANCE)))
    return length, math.ceil(math.log(LOST) / math.log1p(-least ** length))


def _bands(fingerprint: str, length: int, count: int) -> list[int]:
    """Digests of bands of samples, at the text's own level and the one above.

    Positions are picked below a size of a fixed grid: the largest one that the text has, and the one before, so that
    texts of nearly as many samples have bands of one size in common.
    """
    own, out = int(fingerprint.partition(":")[0]), []
    for level in (own, own + 1):
        values = samples_at(fingerprint, level)
        if not len(values):
            continue
        top = int(math.log(len(values)) / math.log(SIZES) + 1e-9)
        for k in {top, max(0, top - 1)}:
            size = np.uint64(max(1, int(SIZES ** k)))
            for b in range(count):
                picked = (mix(np.arange(length, dtype=np.uint64) + np.uint64(1000 * b)) % size).astype(np.int64)
                key = f"{level}:{k}:{b}:".encode() + values[picked].tobytes()
                out.append(int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big", signed=True))
    return out


def _tile_links(least: float):
    """Links (a, b) of the tiles of rows (band, low, high, block, class, id, fingerprint) that come one after another.

    A pair that is of one class already, or that links join within the tile, is not looked at again.
    """
    def linked(rows: list) -> Iterator[tuple[int, int]]:
        own = np.array([int(r[6].partition(":")[0]) for r in rows])
        tables = {}
        for level in set(own.tolist()):
            values = [samples_at(r[6], level) if k <= level else np.empty(0, np.uint8) for r, k in zip(rows, own)]
            table = np.full((len(rows), max(map(len, values))), -1, np.int16)
            for i, v in enumerate(values):
                table[i, :len(v)] = v
            tables[level] = table, np.array([len(v) for v in values])
        names, block, place = np.array([r[4] for r in rows]), np.array([r[3] for r in rows]), np.arange(len(rows))
        low, high = rows[0][1], rows[0][2]
        for i in np.flatnonzero(block == low):
            others = (names != names[i]) & ((block == high) if low != high else (place > i))
            for level in tables:
                some = np.flatnonzero(others & (own == level))
                table, sizes = tables[max(level, own[i])]
                equal = ((table[some] == table[i]) & (table[i] >= 0)).sum(axis=1)
                for j in some[equal >= least * np.maximum(sizes[some], sizes[i])]:
                    if names[j] != names[i]:
                        yield rows[i][5], rows[j][5]
                        names[names == names[j]] = names[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def links():
            found = list(linked(held)) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] != held[0][:3]:
                    yield links()
                    held = []
                held.append(row)
        if held:
            yield links()
    return run


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """(key, fingerprint, class_id): documents linked by fingerprints that are alike to ``least``.

    Equal fingerprints are one class from the start. Members of a band are verified against its two ends by key, so a
    group of very many near copies costs two comparisons each; bands that then still hold several classes are compared
    whole, as pairs or in tiles of bounded size. A pair at the threshold is found with a chance of about 0.999. Null keys
    keep a class of their own (null).
    """
    scratch = Scratch(docs.sparkSession, "edit")
    rows = scratch.write(docs.select(F.col(f"`{key}`").cast("long").alias("key"),
                                     fingerprint_of(F.col(f"`{text}`")).alias("fingerprint")), "rows")
    classes = scratch.write(rows.where("key is not null").groupBy("fingerprint").agg(F.min("key").alias("id")), "classes")
    length, count = bands_for(classes.count(), least)

    @F.arrow_udf("array<long>")
    def bands(column: pa.Array) -> pa.Array:
        return pa.array([_bands(x, length, count) for x in column.to_pylist()], pa.list_(pa.int64()))

    @F.arrow_udf("double")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([likeness(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())

    def verified(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(classes.select(F.col("id").alias(side), F.col("fingerprint").alias(f"f{side}")), side)
        return pairs.where(alike("fa", "fb") >= least).select("a", "b")

    entries = scratch.write(classes.select("id", F.explode(bands("fingerprint")).alias("band")), "entries")
    ends = entries.groupBy("band").agg(F.array(F.min("id"), F.max("id")).alias("ends")).where("ends[0] <> ends[1]")
    pairs = (entries.join(ends, "band").select("id", F.explode("ends").alias("end")).where("id <> end")
             .select(F.least("id", "end").alias("a"), F.greatest("id", "end").alias("b")).distinct())
    found = components(verified(pairs), scratch, "ends")

    named = entries.join(found, "id", "left").select("band", "id", F.coalesce("component", "id").alias("class"))
    mixed = named.groupBy("band").agg(F.count("*").alias("n"), F.min("class").alias("c0"), F.max("class").alias("c1"))
    mixed = scratch.write(named.join(mixed.where("c0 <> c1 AND n > 2").select("band", "n"), "band"), "mixed")
    few, many = mixed.where(F.col("n") <= SMALL_BAND), mixed.where(F.col("n") > SMALL_BAND)
    x, y = few.alias("x"), few.alias("y")
    near = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.class") != F.col("y.class")))
    links = verified(near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    dealt = many.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    tiles = dealt.select("band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class", "id")
    tile = ["band", "low", "high"]
    tiles = tiles.join(classes.select("id", "fingerprint"), "id").select(*tile, "block", "class", "id", "fingerprint")
    links = links.union(tiles.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(_tile_links(least), "a long, b long"))
    found = components(links.union(found.select(F.col("id").alias("a"), F.col("component").alias("b"))), scratch, "links")
    named = classes.join(found, "id", "left").select("fingerprint", F.coalesce("component", "id").alias("class_id"))
    out = rows.join(named, "fingerprint", "left")
    return out.select(F.col("key").alias(key), "fingerprint", F.when(F.col("key").isNotNull(), F.col("class_id")).alias("class_id"))
