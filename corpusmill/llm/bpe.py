"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary: a whole pre-token that is a token costs
one probe, for all new pre-tokens of a batch at once. Tier two merges the bytes of the others: a
heap of neighbouring pairs by rank over a linked list of parts, so that a pre-token of n bytes
takes n log n steps. A worker remembers the ids of the pre-tokens that it has seen, up to a bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tokens import ranks_of
from corpusmill.llm.words import digests, mix

REMEMBERED = 500_000          # pre-tokens with their ids, per worker; begun anew when full
LONG_KEY = 64                 # longer pre-tokens are not remembered
PIECES = 200_000              # pre-tokens of a text that are held together
BUCKET_KEYS = 4               # keys for each displacement of the hash
TRIED = 64                    # displacements that are tried together


def _digests_of(pieces: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(x) for x in pieces], dtype=np.int64)
    starts = ends - np.array([len(x) for x in pieces], np.int64)
    return digests(np.frombuffer(b"".join(pieces), np.uint8), starts, ends)


class PerfectHash:
    """A minimal perfect hash (hash, displace) over byte strings: n keys, n slots, no empty slot.

    Buckets are placed from the largest to the smallest; the first displacement that sends all
    keys of a bucket to free slots is stored. Buckets of one key store their slot directly.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // BUCKET_KEYS)
        found = _digests_of(keys)
        if len(np.unique(found)) != self.n:
            raise ValueError("keys repeat, or their digests collide")
        self.displacement = np.zeros(self.buckets, np.int64)
        self.key_of_slot = np.zeros(self.n, np.int64)
        taken = np.zeros(self.n, bool)
        bucket = (found % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(edges)
        free = None
        for b in np.argsort(-sizes, kind="stable"):
            own = order[edges[b]:edges[b + 1]]
            if len(own) > 1:
                d, slots = self._place(found[own], taken)
                self.displacement[b] = d
            elif len(own) == 1:
                if free is None:
                    free = iter(np.flatnonzero(~taken))
                slots = np.array([next(free)])
                self.displacement[b] = -1 - slots[0]
            else:
                continue
            taken[slots] = True
            self.key_of_slot[slots] = own
        self.digest_of_slot = found[self.key_of_slot]

    def _place(self, found: np.ndarray, taken: np.ndarray) -> tuple[int, np.ndarray]:
        """The first displacement that sends the digests to different free slots."""
        first = 1
        while True:
            tried = np.arange(first, first + TRIED)
            slots = self._displaced(found[None, :], tried[:, None])
            ranked = np.sort(slots, axis=1)
            good = ~taken[slots].any(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if good.any():
                at = int(np.argmax(good))
                return int(tried[at]), slots[at]
            first += TRIED

    def _displaced(self, found: np.ndarray, d: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(found + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def find(self, pieces: list[bytes]) -> np.ndarray:
        """The number of the key that each piece may be, or -1; equal digests, so compare the bytes."""
        found = _digests_of(pieces)
        d = self.displacement[(found % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(d < 0, -1 - d, self._displaced(found, np.maximum(d, 0)))
        return np.where(self.digest_of_slot[slots] == found, self.key_of_slot[slots], -1)


class Vocabulary:
    """Tokens, ranks, the perfect hash over the tokens, and tables that ids are written out by."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = list(ranks)
        self.rank_of_key = [ranks[x] for x in self.tokens]
        self.hash = PerfectHash(self.tokens)
        size = max(self.rank_of_key) + 1
        texts, decimals = [b""] * size, [b"%d," % i for i in range(size)]
        for token, rank in ranks.items():
            texts[rank] = token
        self.texts, self.decimals = _Table(texts), _Table(decimals)


class _Table:
    """Byte strings by number, written one after another for an array of numbers."""

    def __init__(self, strings: list[bytes]):
        self.length = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def write(self, numbers: np.ndarray) -> bytes:
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.arange(total) + np.repeat(self.start[numbers] - ends + lengths, lengths)].tobytes()


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of the parts after merging the pair of lowest rank, leftmost first, while there is one."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        if not alive[i]:
            continue
        j = after[i]
        if j >= n or after[j] != end:              # one of the two parts has grown meanwhile
            continue
        alive[j] = False
        after[i] = end
        if end < n:
            before[end] = i
            if (r := get(piece[i:after[end]])) is not None:
                heappush(heap, (r, i, after[end]))
        k = before[i]
        if k >= 0 and (r := get(piece[k:end])) is not None:
            heappush(heap, (r, k, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Codec:
    """Encodes pre-tokens by the two tiers; decodes ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known = vocabulary, {}
        self.whole = self.split = 0                # pre-tokens that tier one and tier two resolved

    def ids(self, pieces: list[str]) -> np.ndarray:
        out = list(map(self.known.get, pieces))
        if None in out:
            new = {p for p, x in zip(pieces, out) if x is None}
            found = self._resolve(list(new))
            out = [found[p] if x is None else x for p, x in zip(pieces, out)]
            if len(self.known) + len(found) > REMEMBERED:
                self.known.clear()
            self.known.update((p, x) for p, x in islice(found.items(), REMEMBERED) if len(p) <= LONG_KEY)
        return np.frombuffer(b"".join(out), np.uint32)

    def _resolve(self, new: list[str]) -> dict[str, bytes]:
        vocabulary, out = self.vocabulary, {}
        raw = [x.encode() for x in new]
        for text, piece, key in zip(new, raw, vocabulary.hash.find(raw).tolist()):
            if key >= 0 and vocabulary.tokens[key] == piece:
                ids = [vocabulary.rank_of_key[key]]
                self.whole += 1
            else:
                ids = merged(piece, vocabulary.ranks)
                self.split += 1
            out[text] = np.array(ids, np.uint32).tobytes()
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return self.vocabulary.texts.write(ids)


def pieces_of(text: str, pattern) -> Iterator[list[str]]:
    """Pre-tokens of a text, in lists of bounded length."""
    if len(text) <= PIECES:
        yield pattern.findall(text)
        return
    matches = pattern.finditer(text)
    while some := [m[0] for m in islice(matches, PIECES)]:
        yield some


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", keep_ids: bool = True) -> DataFrame:
    """``docs`` with n_tokens, ids (array, unless ``keep_ids`` is false), ids_sha256, decoded_sha256.

    ``ids_sha256`` digests the decimal ids joined by commas, ``decoded_sha256`` the bytes that the
    ids decode to. ``path`` is a vocabulary file; the driver reads it. A null text is encoded as
    an empty one: no tokens. Rows are independent; columns of ``docs`` with the new names are
    replaced, and all others, null or not, stay as they are.
    """
    kind = "struct<n_tokens: bigint, ids: array<int>, ids_sha256: string, decoded_sha256: string>"
    arrow = pa.struct([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
                       ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    vocabulary = Vocabulary(ranks_of(path))          # some megabytes, whatever the input
    state: dict = {}

    @F.arrow_udf(kind)
    def encode(column: pa.Array) -> pa.Array:
        import regex
        if not state:
            state["codec"], state["pattern"] = Codec(vocabulary), regex.compile(pattern)
        codec, rows = state["codec"], []
        tables = codec.vocabulary
        for x in column:
            body = x.as_py() or ""
            n, kept, decimal, decoded = 0, [], hashlib.sha256(), hashlib.sha256()
            for pieces in pieces_of(body, state["pattern"]) if body else ():
                ids = codec.ids(pieces)
                written = tables.decimals.write(ids)
                decimal.update(b"," + written[:-1] if n else written[:-1])
                decoded.update(codec.decode(ids))
                n += len(ids)
                if keep_ids:
                    kept.append(ids)
            rows.append({"n_tokens": n, "ids": np.concatenate(kept).astype(np.int32) if kept else [],
                         "ids_sha256": decimal.hexdigest(), "decoded_sha256": decoded.hexdigest()})
        return pa.array(rows, arrow)

    done = docs.withColumn("_encoded", encode(F.col(f"`{text}`").cast("string")))
    names = ["n_tokens", *(["ids"] if keep_ids else []), "ids_sha256", "decoded_sha256"]
    rest = [f"`{c}`" for c in docs.columns if c not in names]
    return done.select(*rest, *[F.col(f"_encoded.{c}").alias(c) for c in names])
