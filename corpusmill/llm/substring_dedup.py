"""Removal of word passages that occur in an earlier document, by fixed-block anchors.

A passage of ``window`` words contains a whole aligned block of ``(window + 1) // 2`` words of the
document that it is compared with. So the aligned, non-overlapping blocks of every document are
indexed, and the block at *every* word position probes the index. Where block and probe meet, both
documents have an anchor. Anchors are then extended: every window that holds an anchor is compared
by a 96-bit digest, and windows that a document with a smaller key also has are joined to maximal
repeats.

Texts stay where they are while digests travel. A page (some megabytes of text) sends each bucket
of the digest space one packed row with the digests that are new within the page, so a passage
that a third of all documents share adds one entry per page, not one per document. Buckets
follow the size of the corpus. Texts are shuffled once, by key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.words import Words, word_slices

BUCKET_BYTES = 8 << 20            # of text for each bucket of digests
LEAST_BUCKETS = 32
_OTHER = np.uint64(0xA24BAED4963EE407)
_PACKED = "bucket int, page long, a binary, b binary, c binary, d binary"
_HITS = "page long, kind int, a binary, b binary, c binary, d binary"


def _gaps(at: np.ndarray) -> bytes:
    """Ascending positions as differences of two bytes, or of four where needed.

    All low bytes come first: the high ones, nearly all zero, then compress to nothing.
    """
    gaps = np.diff(at, prepend=0)
    width = np.uint16 if not len(gaps) or gaps.max() < 1 << 16 else np.uint32
    planes = gaps.astype(width).view(np.uint8).reshape(-1, width().itemsize)
    return bytes([width().itemsize]) + np.ascontiguousarray(planes.T).tobytes()


def _positions(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(f"u{width}")[:, 0], dtype=np.int64)


def _batches(rows: Iterator[list[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    for fields in rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(
                zip(*fields), (pa.int32(), pa.int64(), *[pa.binary()] * 4))],
            ["bucket", "page", "a", "b", "c", "d"])


class _Pages:
    """Page numbers that are unique within a job."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 32

    def number(self) -> int:
        self.next += 1
        return self.next - 1


def _first_of(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that groups equal digests, and where groups start; earlier entries come first."""
    order = np.argsort(digests, kind="stable")
    ranked = digests[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(order) else np.zeros(0, int)
    return order, starts


def _by_bucket(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries grouped by bucket, in their own order within it, and the bounds of the groups."""
    bucket = ((digests >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _row_of(words: Words, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.first, at, "right") - 1


def _columns(batch: pa.RecordBatch, words: Words) -> list[np.ndarray]:
    return [batch.column(name).to_numpy()[words.rows] for name in ("key", "fp")]


def _anchors(block: int, buckets: int):
    """Pages' digests of the blocks at every position; aligned blocks are marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = _Pages()

        def packed():
            for batch in batches:
                for words in word_slices(batch.column("text")):
                    grams, at, bounds = words.ngrams(block)
                    if not len(grams):
                        continue
                    aligned = (at - np.repeat(words.first[:-1], np.diff(bounds))) % block == 0
                    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                    order, starts = _first_of(grams)
                    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
                    any_aligned = np.logical_or.reduceat(aligned[order], starts)
                    in_two = (np.minimum.reduceat(row[order], starts) != np.maximum.reduceat(row[order], starts))
                    local = (any_aligned & in_two)[group]
                    repeated = np.ones(len(order), bool)
                    repeated[starts] = False
                    twins = np.stack([at[order[repeated]], at[order[starts][group[repeated]]]]).astype(np.uint32)
                    page = pages.number()
                    keys, fps = _columns(batch, words)
                    rows = [(-1 - page % buckets, page, np.stack([keys, fps]).astype(np.int64).tobytes(),
                             words.first.astype(np.uint32).tobytes(), twins.tobytes(),
                             at[np.sort(order[local])].astype(np.uint32).tobytes())]
                    sent = order[starts]
                    by = np.argsort(sent)
                    sent, flags = sent[by], any_aligned[by]
                    put, edges = _by_bucket(grams[sent], buckets)
                    for b in range(buckets):
                        some = put[edges[b]:edges[b + 1]]
                        if len(some):
                            rows.append((b, page, grams[sent[some]].astype(np.uint32).tobytes(),
                                         _gaps(at[sent[some]]), np.packbits(flags[some]).tobytes(), None))
                    yield rows
        yield from _batches(packed())
    return run


def _met(group: pd.DataFrame) -> pd.DataFrame:
    """Positions whose block another page has too, one of them aligned; page rows pass through."""
    if group["bucket"].iat[0] < 0:
        return group.assign(kind=0)[["page", "kind", "a", "b", "c", "d"]]
    digests = [np.frombuffer(x, np.uint32) for x in group["a"]]
    sizes = [len(x) for x in digests]
    aligned = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
                              for x, n in zip(group["c"], sizes)])
    order, starts = _first_of(np.concatenate(digests))
    counts = np.diff(np.append(starts, len(order)))
    good = (counts > 1) & np.logical_or.reduceat(aligned[order], starts)
    hit = np.zeros(len(order), bool)
    hit[order] = np.repeat(good, counts)
    return _answer(group, sizes, hit)


def _answer(group: pd.DataFrame, sizes: list[int], hit: np.ndarray) -> pd.DataFrame:
    out, begin = [], 0
    for page, gaps, n in zip(group["page"], group["b"], sizes):
        own = hit[begin:begin + n]
        begin += n
        if own.any():
            out.append((page, 1, _positions(gaps)[own].astype(np.uint32).tobytes(), None, None, None))
    return pd.DataFrame(out, columns=["page", "kind", "a", "b", "c", "d"])


def _per_row(group: pd.DataFrame) -> pd.DataFrame:
    """Marked word positions of every row of one page, relative to the row."""
    main = group[group["kind"] == 0].iloc[0]
    keys, fps = np.frombuffer(main["a"], np.int64).reshape(2, -1)
    first = np.frombuffer(main["b"], np.uint32).astype(np.int64)
    marked = np.zeros(first[-1], bool)
    marked[np.frombuffer(main["d"], np.uint32)] = True
    for x in group["a"][group["kind"] == 1]:
        marked[np.frombuffer(x, np.uint32)] = True
    twin, of = np.frombuffer(main["c"], np.uint32).reshape(2, -1)
    marked[twin[marked[of]]] = True
    at = np.flatnonzero(marked)
    edges = np.searchsorted(at, first)
    out = [(keys[i], fps[i], _gaps(at[edges[i]:edges[i + 1]] - first[i]))
           for i in np.flatnonzero(np.diff(edges))]
    return pd.DataFrame(out, columns=["key", "fp", "marks"])


def _marks(batch: pa.RecordBatch, words: Words) -> np.ndarray:
    """Positions in the slice that the column ``marks`` names."""
    found = [words.first[i] + _positions(x) for i, x in enumerate(
        batch.column("marks").slice(words.rows.start, words.rows.stop - words.rows.start).to_pylist()) if x]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _spread(at: np.ndarray, before: int, after: int, row_start: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie from ``before`` before to ``after`` after a given one."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.maximum(at - before, row_start), 1)
    np.add.at(change, np.minimum(at + after + 1, n), -1)
    return np.cumsum(change[:-1]) > 0


def _windows(window: int, block: int, buckets: int):
    """Pages' digests of the windows that hold an anchor, with the key of their document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = _Pages()

        def packed():
            for batch in batches:
                for words in word_slices(batch.column("text")):
                    anchors = _marks(batch, words)
                    near = _spread(anchors, window - block, 0, words.first[_row_of(words, anchors)],
                                   len(words.digests))
                    grams, at, _ = words.ngrams(window)
                    keep = near[at]
                    if not keep.any():
                        continue
                    more = words.ngrams(window, _OTHER)[0][keep].astype(np.uint32)
                    grams, at = grams[keep], at[keep]
                    keys, fps = _columns(batch, words)
                    row = _row_of(words, at)
                    key = keys[row]
                    order = np.lexsort((at, key, more, grams))
                    new = np.concatenate([[True], (grams[order][1:] != grams[order][:-1])
                                          | (more[order][1:] != more[order][:-1])])
                    starts = np.flatnonzero(new)
                    lead = order[starts][np.cumsum(new) - 1]          # smallest key of each group
                    later = key[order] > key[lead]
                    twin = ~later & ~new
                    page = pages.number()
                    rows = [(-1 - page % buckets, page, np.stack([keys, fps]).astype(np.int64).tobytes(),
                             words.first.astype(np.uint32).tobytes(),
                             np.stack([at[order[twin]], at[lead[twin]]]).astype(np.uint32).tobytes(),
                             at[order[later]].astype(np.uint32).tobytes())]
                    sent = np.sort(order[starts])
                    put, edges = _by_bucket(grams[sent], buckets)
                    for b in range(buckets):
                        some = sent[put[edges[b]:edges[b + 1]]]
                        if len(some):
                            changes = np.flatnonzero(np.concatenate([[True], np.diff(row[some]) != 0]))
                            counts = np.diff(np.append(changes, len(some)))
                            rows.append((b, page, grams[some].tobytes(), _gaps(at[some]), more[some].tobytes(),
                                         key[some][changes].astype(np.int64).tobytes()
                                         + counts.astype(np.uint32).tobytes()))
                    yield rows
        yield from _batches(packed())
    return run


def _earlier(group: pd.DataFrame) -> pd.DataFrame:
    """Positions whose window a document with a smaller key has too; page rows pass through."""
    if group["bucket"].iat[0] < 0:
        return group.assign(kind=0)[["page", "kind", "a", "b", "c", "d"]]
    digests = [np.frombuffer(x, np.uint64) for x in group["a"]]
    sizes = [len(x) for x in digests]
    keys = []
    for x in group["d"]:
        n = len(x) // 12
        keys.append(np.repeat(np.frombuffer(x, np.int64, n), np.frombuffer(x, np.uint32, n, 8 * n)))
    grams, keys = np.concatenate(digests), np.concatenate(keys)
    more = np.concatenate([np.frombuffer(x, np.uint32) for x in group["c"]])
    order = np.lexsort((more, grams))
    new = np.concatenate([[True], (grams[order][1:] != grams[order][:-1]) | (more[order][1:] != more[order][:-1])])
    starts = np.flatnonzero(new)
    smallest = np.minimum.reduceat(keys[order], starts)[np.cumsum(new) - 1]
    hit = np.zeros(len(order), bool)
    hit[order] = keys[order] > smallest
    return _answer(group, sizes, hit)


def _kept(window: int):
    """Words left of every text, joined by one space, with counts and the removed runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_slices(batch.column("text")):
                n = len(words.digests)
                starts = _marks(batch, words)
                gone = _spread(starts, 0, window - 1, np.zeros(len(starts), np.int64), n)
                total, rows = np.diff(words.first), len(words.first) - 1
                sums = np.concatenate([[0], np.cumsum(gone)])
                removed = sums[words.first[1:]] - sums[words.first[:-1]]
                stay = np.flatnonzero(~gone)
                bytes_kept = np.zeros(len(words.data) + 1, np.int8)
                bytes_kept[words.starts[stay]] = 1
                edge = np.zeros(len(words.data) + 1, np.int8)
                edge[words.ends[stay]] = 1
                inside = np.cumsum(bytes_kept - edge, dtype=np.int8)[:-1] > 0      # never but 0 or 1
                stay_row = _row_of(words, stay)
                joined = words.ends[stay[:-1][stay_row[:-1] == stay_row[1:]]] if len(stay) else np.zeros(0, int)
                inside[joined] = True
                data = words.data.copy()
                data[joined] = 0x20
                length = np.concatenate([[0], np.cumsum(inside)])
                lengths = np.zeros(rows + 1, np.int64)
                ends = np.asarray(words.row_ends)
                lengths[1:] = length[ends]
                texts = pa.LargeStringArray.from_buffers(
                    rows, pa.py_buffer(lengths.tobytes()), pa.py_buffer(data[inside].tobytes())).cast(pa.string())
                runs = _runs(gone, words)
                part = batch.slice(words.rows.start, rows).drop_columns(["marks"])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(total.astype(np.int64)), pa.array(removed.astype(np.int64)), texts, runs],
                    [*part.schema.names, "n_words", "n_removed", "kept_text", "removed"])
    return run


def _runs(gone: np.ndarray, words: Words) -> pa.Array:
    """Maximal removed runs of each row as [first word, end word, first word, ...]."""
    n = len(gone)
    fresh, last = gone.copy(), gone.copy()
    if n:
        bound = np.zeros(n + 1, bool)
        bound[words.first] = True
        fresh[1:] &= ~gone[:-1] | bound[1:n]
        last[:-1] &= ~gone[1:] | bound[1:n]
    begin, end = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    row = _row_of(words, begin)
    flat = np.stack([begin, end], axis=1) - words.first[row][:, None]
    offsets = 2 * np.searchsorted(row, np.arange(len(words.first)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.reshape(-1).astype(np.int64)))


def _source(docs: DataFrame, key: str, text: str, carry: list[str]) -> DataFrame:
    text = F.col(f"`{text}`").cast("string")
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    return docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.xxhash64(text).alias("fp"), text.alias("text"),
                       *carried)


def removed_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13,
                     carry: list[str] | None = None) -> DataFrame:
    """(key, fp, text, [carried,] n_words, n_removed, kept_text, removed) for every row.

    A word goes if a run of ``window`` words that covers it also starts in a document with a
    smaller key. Windows are judged on the input. ``kept_text`` has the words that stay, joined by
    one space; ``removed`` the maximal removed runs as word positions. ``carried`` has the columns
    named in ``carry``. ``fp`` is a digest of the text: rows that repeat a key are texts of one
    document, and rows that repeat both have equal results.

    Null texts have no words. Rows with a null key keep every word and are no earlier document.
    """
    source = _source(docs, key, text, carry or [])
    keyed = source.where("key is not null")
    block = (window + 1) // 2
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    marks = "key long, fp long, marks binary"

    def exchanged(packed, answer):
        answered = packed.groupBy("bucket").applyInPandas(answer, _HITS)
        return answered.groupBy("page").applyInPandas(_per_row, marks).dropDuplicates(["key", "fp"])

    anchors = exchanged(keyed.mapInArrow(_anchors(block, buckets), _PACKED), _met)
    anchored = keyed.join(anchors, ["key", "fp"])
    covered = exchanged(anchored.mapInArrow(_windows(window, block, buckets), _PACKED), _earlier)
    more = T.StructType.fromDDL("n_words long, n_removed long, kept_text string, removed array<long>")
    out = T.StructType(source.schema.fields + more.fields)
    done = keyed.join(covered, ["key", "fp"], "left").mapInArrow(_kept(window), out)
    rest = source.where("key is null").withColumn("marks", F.lit(None).cast("binary")).mapInArrow(_kept(window), out)
    return done.unionByName(rest)


def without_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; texts without one stay as they are."""
    done = removed_passages(docs, key, text, window, docs.columns)
    cut = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return done.select(*[cut.alias(c) if c == text else F.col(f"carried.`{c}`").alias(c) for c in docs.columns])
