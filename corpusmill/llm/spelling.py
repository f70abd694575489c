"""Spelling variants: words one error apart, found by a bit-sliced position index.

The vocabulary is counted over all texts. Words one error apart share their first or their last
``PIECE`` letters (words are at least twice as long), so each word goes to two buckets, and buckets
are cut into blocks of about ``BLOCK`` letters that meet in tiles. For the words of a tile there is one
bitset for every (position, letter): the words that have this letter there. A query word runs down
its letters and keeps four bitsets: words without an error so far, and words with one error, apart
by its kind (another letter, a letter less, a letter more). The kinds that shift look up the
neighbouring position. All words of one length run together, 64 words of the index at a time.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import Scratch

PIECE = 3
BLOCK = 1 << 15              # letters, about, of a block
TOGETHER = 4_096             # words that small tiles are gathered to
CELLS = 1 << 23              # query words times index words looked at together
HELD = 300_000               # words that a task counts before it sends them on

LETTERS = "a-zÀ-ÿ"
_RUN = re.compile(f"[{LETTERS}]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def runs(text: str) -> Counter:
    """Runs of letters of a text, with A-Z lower-cased, and how often each occurs."""
    return Counter(_RUN.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")))


def _counted(min_length: int, drop_every: int | None):
    def rows(totals: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(totals.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if text is None:
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in runs(text).items():
                    if len(word) < min_length:
                        continue
                    if drop_every and (h := zlib.crc32(word.encode(), start)) % drop_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    totals[word] += n
                if len(totals) > HELD:
                    yield rows(totals)
                    totals.clear()
        yield rows(totals)
    return run


class PositionIndex:
    """For every (position, letter) the set of words that have it, as bits."""

    def __init__(self, letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        n = len(lengths)
        self.n, self.width = n, (n + 63) // 64
        self.alphabet, codes = np.unique(letters, return_inverse=True)
        ends = np.cumsum(lengths)
        position = np.arange(len(letters)) - np.repeat(ends - lengths, lengths)
        self.keys, row = np.unique(position * len(self.alphabet) + codes, return_inverse=True)
        cells = np.zeros((len(self.keys) + 1, self.width * 64), bool)       # the last row: no word
        cells[row, np.repeat(np.arange(n), lengths)] = True
        self.bits = self.packed(cells)
        self.by_length = {}
        self.lengths = lengths

    @staticmethod
    def packed(cells: np.ndarray) -> np.ndarray:
        return np.packbits(cells, axis=-1, bitorder="little").view(np.uint64)

    def of_length(self, m: int) -> np.ndarray:
        cells = np.zeros(self.width * 64, bool)
        cells[:self.n] = self.lengths == m
        return self.packed(cells)

    def rows(self, codes: np.ndarray, position: int) -> np.ndarray:
        """Bitsets of the letters ``codes`` (numbers in the alphabet) at a position."""
        if position < 0:
            return self.bits[np.full(len(codes), len(self.keys))]
        keys = position * len(self.alphabet) + codes
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.bits[np.where(self.keys[at] == keys, at, len(self.keys))]

    def one_error(self, queries: np.ndarray) -> np.ndarray:
        """(query, word) of all words exactly one error from queries of one length, a row of letters each."""
        m = queries.shape[1]
        codes = np.searchsorted(self.alphabet, queries)
        none = np.full((len(queries), self.width), ~np.uint64(0))
        other, less, more = (np.zeros_like(none) for _ in range(3))
        for i in range(m):
            here = self.rows(codes[:, i], i)
            other = (other & here) | (none & ~here)
            less = (less & self.rows(codes[:, i], i - 1)) | none
            more = (more | none) & self.rows(codes[:, i], i + 1)
            none = none & here
        found = (other & self.of_length(m)) | (less & self.of_length(m - 1)) | ((more | none) & self.of_length(m + 1))
        return np.argwhere(np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")[:, :self.n])


def one_error_apart(words: list[str]) -> np.ndarray:
    """(i, j) of all words that differ by exactly one letter inserted, deleted or replaced; both orders."""
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(lengths) - lengths
    found = [np.empty((0, 2), np.int64)]
    for m in np.unique(lengths):
        own = np.flatnonzero(lengths == m)
        over = np.flatnonzero(np.abs(lengths - m) <= 1)
        if not m or len(over) < 2:
            continue
        part = np.concatenate([letters[starts[k]:starts[k] + lengths[k]] for k in over])
        index = PositionIndex(part, starts[over], lengths[over])
        step = max(1, CELLS // max(len(over), int(m)))
        for at in range(0, len(own), step):
            some = own[at:at + step]
            pairs = index.one_error(letters[starts[some][:, None] + np.arange(m)])
            found.append(np.stack([some[pairs[:, 0]], over[pairs[:, 1]]], axis=1))
    return np.concatenate(found)


TILE = ["bucket", "low", "high"]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the words of whole tiles, which come one after another. Each pair comes once in each order.

    Words with equal first pieces are left to the bucket of first pieces, and words of one block to that
    block's own tile.
    """
    held, size, last = [], 0, None

    def pairs() -> pa.RecordBatch:
        found = one_error_apart([r[4] for r in held])
        kept = []
        for i, j in found.tolist():
            a, b = held[i], held[j]
            if a[:3] != b[:3] or a[1] != a[2] and a[3] == b[3] or a[0][0] == "s" and a[4][:PIECE] == b[4][:PIECE]:
                continue
            kept.append((a[4], b[4], b[5]))
        columns = zip(*kept) if kept else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))],
                                          ["word", "near", "near_n"])
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] != last and (len(held) >= TOGETHER or size > BLOCK):
                yield pairs()
                held, size = [], 0
            last = row[:3]
            held.append(row)
            size += len(row[4])
    if held:
        yield pairs()


def vocabulary(docs: DataFrame, key: str, text: str, min_length: int, min_count: int, drop_every: int | None) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    source = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return (source.mapInArrow(_counted(min_length, drop_every), "word string, n long")
                  .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of all words of the table (word, n) that are one error apart, in both orders.

    Words must have at least ``2 * PIECE`` letters and occur once.
    """
    kinds = F.array(F.concat(F.lit("p"), F.left("word", F.lit(PIECE))), F.concat(F.lit("s"), F.right("word", F.lit(PIECE))))
    pieces = words.select("word", "n", F.explode(kinds).alias("bucket"))
    sizes = pieces.groupBy("bucket").agg(F.ceil(F.sum(F.length("word")) / BLOCK).cast("int").alias("blocks"))
    blocked = pieces.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    tiles = blocked.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "word", "n")
    return tiles.repartition(*TILE).sortWithinPartitions(*TILE).mapInArrow(_near, "word string, near string, near_n long")


def _roots(forms: DataFrame, most_steps: int, scratch: Scratch) -> DataFrame:
    """(word, root): where following ``form`` ends. Each round doubles the steps that are taken."""
    up, steps = forms.select("word", F.col("form").alias("root")), 1
    while steps < most_steps:
        higher = up.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        up = scratch.write(up.join(higher, "root", "left").select("word", F.coalesce("higher", "root").alias("root")), f"up{steps}")
        steps *= 2
    return up


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 6, min_count: int = 5,
                    ratio: int = 5, drop_every: int | None = None) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased, of at least ``min_length``
    letters and ``min_count`` occurrences in all texts. Two words are near if they are one inserted, deleted or replaced
    letter apart. ``form`` is the most frequent near word (ties: the smallest) if it is at least ``ratio`` times as
    frequent, ``root`` where following forms ends (the word itself without a form). With ``drop_every`` = d a run loses
    the letter crc32 % length wherever d divides the crc32 of ``<key>:<run>``: a fixed share of misspellings.

    Null and empty texts have no words; a null key counts as an empty one. Repeated rows count as often as they come.
    Other columns are ignored. No text or no frequent word gives an empty result.
    """
    if min_length < 2 * PIECE or ratio < 2:
        raise ValueError(f"words need {2 * PIECE} letters at least, and a form twice the occurrences")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.write(vocabulary(docs, key, text, min_length, min_count, drop_every), "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    named = scratch.write(named.select("word", "n", "n_near", F.col("best.near").alias("form"),
                                       (-F.col("best.less")).alias("form_n")), "named")
    most = words.agg(F.max("n")).head()[0] or 1
    # A form is at least ``ratio`` times as frequent, which bounds the steps to a root.
    roots = _roots(named.where("form is not null"), int(math.log(max(1, most / min_count), ratio) + 1e-9), scratch)
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
