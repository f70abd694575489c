"""Words and word pairs of many texts at once: Arrow splits them, numpy counts them as numbers."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 8_000_000      # of texts that are counted together
MERGED_TERMS = 1_000_000     # words or pairs that a task adds up before it sends them
IN_WORD = r"[\p{L}\p{N}_]"

COUNTS = "term string, ctf long, df long"
_COUNTS = pa.schema([("term", pa.string()), ("ctf", pa.int64()), ("df", pa.int64())])
CELLS = "struct<indices: array<int>, values: array<double>>"


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, in parts of about ``SLICE_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    at = [0, *(np.flatnonzero(np.diff(part)) + 1), len(texts)]
    for a, b in zip(at, at[1:]):
        yield texts.slice(a, b - a)


@functools.cache
def _in_words() -> np.ndarray:
    """Whether each code point is a letter, a digit or an underscore."""
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    table = np.zeros(0x110000, bool)
    table[points] = pc.match_substring_regex(pa.array(map(chr, points), pa.string()), IN_WORD).to_numpy(zero_copy_only=False)
    return table


def _solid(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 texts belong to words."""
    table = _in_words()
    solid = np.append(table[:0x80], np.zeros(0x80, bool))[data]
    lead = np.flatnonzero(data >= 0xC0)
    first = data[lead]
    sizes = 2 + (first >= 0xE0) + (first >= 0xF0)
    point = first.astype(np.int64) & 0x7F >> sizes
    for k in range(1, 4):
        some = sizes > k
        point[some] = point[some] << 6 | data[lead[some] + k] & 0x3F
    inside = table[point]
    for k in range(4):
        some = inside & (sizes > k)
        solid[lead[some] + k] = True
    return solid


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Runs of two or more letters, digits or underscores, and the number of the text of each."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[bounds[0]:bounds[-1]] if held is not None and held.size else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    solid = _solid(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(solid & (edge[:-1] | ~np.append(False, solid[:-1])))
    ends = np.flatnonzero(solid & (edge[1:] | ~np.append(solid[1:], False))) + 1
    first = data[starts]
    alone = ends - starts <= 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
    for k in range(4):                                        # words of one letter go
        at = starts[alone] + k
        solid[at[at < ends[alone]]] = False
    starts, ends = starts[~alone], ends[~alone]
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, bounds)))
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    return row, pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[solid]))


def _tally(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, how often each occurs, and in how many rows."""
    rows = int(row.max(initial=0)) + 1
    cells = np.sort(keys * rows + row)                        # numbers are sorted much faster than their places
    keys = cells // rows
    at = np.flatnonzero(np.diff(keys, prepend=-1) != 0)
    first = np.diff(cells, prepend=-1) != 0
    return keys[at], np.diff(at, append=len(keys)), np.diff(np.append(0, np.cumsum(first))[np.append(at, len(keys))])


def _added(tallies: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tallies of different rows as one."""
    keys = np.concatenate([t[0] for t in tallies])
    order = np.argsort(keys)
    at = np.flatnonzero(np.diff(keys[order], prepend=-1) != 0)
    if not len(at):
        return tallies[0]
    return keys[order[at]], *(np.add.reduceat(np.concatenate([t[k] for t in tallies])[order], at) for k in (1, 2))


def _counts(terms: pa.Array, tally: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([terms, pa.array(tally[1]), pa.array(tally[2])], schema=_COUNTS)


def _merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Counts of different rows, added up by term."""
    if len(held) == 1:
        return held[0]
    terms = pa.concat_arrays([b.column("term") for b in held]).dictionary_encode()
    code = terms.indices.to_numpy(zero_copy_only=False)
    sums = [np.zeros(len(terms.dictionary), np.int64) for _ in range(2)]
    for total, name in zip(sums, ("ctf", "df")):
        np.add.at(total, code, np.concatenate([b.column(name).to_numpy() for b in held]))
    return _counts(terms.dictionary, (None, *sums))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(term, ctf, df)`` of the words of lower-cased texts, for some slices together: to be added up by term."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for texts in slices(batch.column(0)):
            row, flat = _words(texts)
            coded = flat.dictionary_encode()
            found = _tally(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row)
            held.append(_counts(coded.dictionary.take(pa.array(found[0])), found))
            if sum(b.num_rows for b in held) > MERGED_TERMS:
                held = [_merged(held)]
                if held[0].num_rows > MERGED_TERMS // 2:
                    yield held.pop()
    if held:
        yield _merged(held)


def count_pairs(words=None):
    """As ``count_words``, for pairs of neighbouring words; with ``words`` those of two such words only.

    Pairs of given words have the same number everywhere, so a task adds up its slices.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(words, pa.string()) if words is not None else None
        held: list[tuple] = []

        def sent(found: tuple, names: pa.Array) -> pa.RecordBatch:
            first, second = (names.take(pa.array(c)) for c in np.divmod(found[0], max(len(names), 1)))
            return _counts(pc.binary_join_element_wise(first, second, " "), found)
        for batch in batches:
            for texts in slices(batch.column(0)):
                row, flat = _words(texts)
                coded = flat.dictionary_encode() if known is None else None
                names = known if coded is None else coded.dictionary
                code = pc.fill_null(pc.index_in(flat, value_set=known) if coded is None else coded.indices, -1)
                code = code.to_numpy(zero_copy_only=False).astype(np.int64)
                near = (row[1:] == row[:-1]) & (code[1:] >= 0) & (code[:-1] >= 0)
                found = _tally((code[:-1] * len(names) + code[1:])[near], row[1:][near])
                if known is None:
                    yield sent(found, names)
                    continue
                held.append(found)
                if sum(len(t[0]) for t in held) > MERGED_TERMS:
                    held = [_added(held)]
                    if len(held[0][0]) > MERGED_TERMS // 2:
                        yield sent(held.pop(), known)
        if held:
            yield sent(_added(held), known)
    return run


class Vectoriser:
    """Sparse rows of unit norm over a vocabulary of words and pairs."""

    def __init__(self, terms, idf):
        parts = [t.split(" ") for t in terms]
        words = list(dict.fromkeys(w for p in parts for w in p))
        number = {w: i for i, w in enumerate(words)}
        self.words, self.idf, self.width = pa.array(words, pa.string()), np.array(idf, float), len(words)
        self.alone = np.full(self.width + 1, -1)              # the last is no word
        pairs = {}
        for i, p in enumerate(parts):
            if len(p) == 1:
                self.alone[number[p[0]]] = i
            elif len(p) == 2:
                pairs[number[p[0]] * self.width + number[p[1]]] = i
        self.pairs = np.array([*sorted(pairs), np.iinfo(np.int64).max])
        self.pair_index = np.array([*(pairs[k] for k in sorted(pairs)), -1])

    def cells(self, texts: pa.Array) -> pa.Array:
        row, flat = _words(texts)
        code = pc.fill_null(pc.index_in(flat, value_set=self.words), self.width).to_numpy(zero_copy_only=False).astype(np.int64)
        near = (row[1:] == row[:-1]) & (code[1:] < self.width) & (code[:-1] < self.width)
        key = (code[:-1] * self.width + code[1:])[near]
        at = np.searchsorted(self.pairs, key)
        index = np.concatenate([self.alone[code], np.where(self.pairs[at] == key, self.pair_index[at], -1)])
        both = np.concatenate([row, row[1:][near]])[index >= 0]
        cell, n = np.unique(both * len(self.idf) + index[index >= 0], return_counts=True)
        row, index = np.divmod(cell, len(self.idf))
        weight = (1.0 + np.log(n)) * self.idf[index]
        values = weight / np.sqrt(np.bincount(row, weight * weight, len(texts)))[row]
        ends = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(texts)))), pa.int32())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pa.array(index, pa.int32())),
                                           pa.ListArray.from_arrays(ends, pa.array(values))], ["indices", "values"])


def tfidf_cells(text: Column, terms, idf) -> Column:
    """``{indices, values}`` of lower-cased texts; ``terms`` and ``idf`` travel with the function."""
    @F.arrow_udf(CELLS)
    def weighed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vectoriser = Vectoriser(terms, idf)
        for batch in batches:
            parts = [vectoriser.cells(texts) for texts in slices(batch)]
            yield pa.concat_arrays(parts) if len(parts) > 1 else parts[0]
    return weighed(text)
