"""Packing of tokenised documents into sequences by harmonic classes.

Class k has the lengths in (capacity / (k + 1), capacity / k], and a bin of class k takes exactly
k pieces. Documents may be cut, so only the top length of classes 1, 2, 4, 8, ... is used: whole
sequences are cut off first, then the rest falls into the largest class lengths that still fit.
A full bin then has no gap (for a capacity that is a power of two). Every task fills its own bins
in the order of its rows and needs nothing from other tasks; the bins it leaves open are closed as
shorter sequences of 2^j pieces each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tokens import Encoder, tokenizer_file

CAPACITY = 1024
END_OF_DOCUMENT = 0
ROWS = 20_000                 # pieces of an output batch
_TASK_SEQUENCES = 1 << 40

_NAMES = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def class_sizes(capacity: int) -> list[tuple[int, int]]:
    """(k, length) of the classes in use, from the longest pieces."""
    out, k = [], 1
    while k <= capacity:
        out.append((k, capacity // k))
        k *= 2
    return out


def cuts(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(k, length) of the pieces of a document, in order."""
    out = [(1, capacity)] * (tokens // capacity)
    left = tokens % capacity
    for k, length in class_sizes(capacity):
        n, left = divmod(left, length)
        out += [(k, length)] * n
    return out


class _Bins:
    """Open bins of one task, a bin for each class."""

    def __init__(self):
        self.sequence = TaskContext.get().partitionId() * _TASK_SEQUENCES
        self.open: dict[int, list] = {}

    def add(self, k: int, piece: tuple) -> list[tuple]:
        """Pieces with their places, if this one fills its bin."""
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) < k:
            return []
        self.open[k] = []
        return self._placed(held)

    def _placed(self, held: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for piece in held:
            out.append((*piece[:5], self.sequence, offset, piece[5]))
            offset += piece[2]
        self.sequence += 1
        return out

    def close(self) -> Iterator[list[tuple]]:
        for held in self.open.values():
            while held:
                n = 1 << (len(held).bit_length() - 1)
                yield self._placed(held[:n])
                held = held[n:]


def pack(docs: DataFrame, tokenizer: str, pattern: str, key: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, ids: bool = True) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    ``tokenizer`` is a byte-level tokenizers file, which the driver reads; every document is
    followed by token 0. Every token is in exactly one piece and pieces of a sequence follow one
    another from offset 0. A null text is an empty document: one piece of one token. The key may
    be null or repeat, each row being a document of its own; other columns are ignored. An empty
    table has no pieces.
    """
    ranks, special = tokenizer_file(tokenizer)
    sizes = [pa.int64()] * 7 + [pa.list_(pa.int32())] * ids
    names = _NAMES + ["ids"] * ids

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(c, t) for c, t in zip(columns, sizes[:7])]
        if ids:
            parts = columns[7]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int32))))
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins, ready = Encoder(ranks, special, pattern), _Bins(), []
        for batch in batches:
            for doc, body in zip(batch.column("key"), batch.column("text")):
                doc, body = doc.as_py(), body.as_py()
                tokens = np.array([*(encoder.encode(body) if body else ()), END_OF_DOCUMENT], np.uint32)
                start = 0
                for k, length in cuts(len(tokens), capacity):
                    part = tokens[start:start + length]
                    piece = (doc, start, length, zlib.crc32(part.tobytes()), len(tokens), part if ids else None)
                    ready += bins.add(k, piece)
                    start += length
                if len(ready) >= ROWS:
                    yield batch_of(ready)
                    ready = []
        for placed in bins.close():
            ready += placed
        if ready:
            yield batch_of(ready)

    schema = ", ".join(f"{n} long" for n in _NAMES) + (", ids array<int>" if ids else "")
    out = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return out.mapInArrow(run, schema).withColumnRenamed("key", key)
