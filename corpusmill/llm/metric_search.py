"""Exact top-k inner products by best-first search of a paged M-tree.

Routing objects from a bounded sample divide the vectors into cells; a cell is dealt out to pages
of bounded size, so a cell that holds a third of all vectors is just many pages. A page is a small
M-tree: a centre, nodes with routing object, covering radius and distance to the centre, entries
with their distance to the node's routing object. With ``q.v <= q.c + |q| d(v, c)`` a stored
distance bounds the score of a vector, or of all vectors of a node, by one known product; by
``d(c, c') + r'`` even before the product with the node's own routing object is known.

Queries travel in blocks. A block first searches one page of its own cell, which gives every
query a threshold. The centres and covering radii of pages, a few hundred bytes each, then meet all blocks, and
only pages and blocks whose bounds reach a threshold travel to each other, in a grid of bounded groups.
There nodes are visited from the best bound on until no bound reaches the threshold. Bounds hold for
every vector, so the result is exact for any sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.tables import Scratch

SAMPLE = 4096                # vectors that routing objects are picked from, about
MOST_CELLS = 256
PAGE = 4096                  # vectors of a page, about
NODE = 64                    # vectors of a node, about
BLOCK = 1024                 # queries of a block, about
GROUP = 16                   # pages, and blocks, that meet in one task, about
CHUNK = 4096                 # centres of pages that meet blocks together
_SLACK = 1e-9
_NONE = np.iinfo(np.int64).min


def _spread_out(vectors: np.ndarray, n: int) -> np.ndarray:
    """Numbers of ``n`` vectors far from one another: each the farthest from those before."""
    picked = [0]
    nearest = _distances(vectors, vectors[0])
    while len(picked) < min(n, len(vectors)):
        at = int(np.argmax(nearest))
        if nearest[at] == 0:
            break
        picked.append(at)
        nearest = np.minimum(nearest, _distances(vectors, vectors[at]))
    return np.array(picked)


def _distances(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - centre) ** 2).sum(axis=1))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of the nearest centre, some thousands of vectors at a time."""
    square = (centres ** 2).sum(axis=1)
    return np.concatenate([np.argmin(square - 2 * (part @ centres.T), axis=1)
                           for part in np.array_split(vectors, max(1, len(vectors) // 4096))])


class Tree:
    """The M-tree of one page."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        v = vectors.astype(float)
        self.centre = v.mean(axis=0)
        routing = v[_spread_out(v, -(-len(v) // NODE))]
        node = _nearest(v, routing)
        distance = np.sqrt(((v - routing[node]) ** 2).sum(axis=1))
        order = np.lexsort((-distance, node))                  # within a node the farthest first
        self.ids, self.vectors, self.distance = ids[order], v[order], distance[order]
        used, self.begin = np.unique(node[order], return_index=True)
        self.end = np.append(self.begin[1:], len(v))
        self.routing = routing[used]
        self.radius = self.distance[self.begin]
        self.to_centre = _distances(self.routing, self.centre)
        self.size = _lengths(self.routing) + self.radius       # of the longest vector in reach
        self.products = 0                                      # computed by searches so far

    def search(self, queries: np.ndarray, names: np.ndarray, best: "Best") -> None:
        """Offer all vectors whose score may reach a query's threshold."""
        length = _lengths(queries)
        at_centre = queries @ self.centre
        reach = self.to_centre + self.radius
        early = at_centre[:, None] + length[:, None] * reach[None, :]
        early += _slack(length[:, None] * (_lengths(self.centre[None, :]) + reach)[None, :])
        nodes = np.flatnonzero((early >= best.threshold()[:, None]).any(axis=0))
        if not len(nodes):
            return
        known = queries @ self.routing[nodes].T
        self.products += known.size
        slack = _slack(length[:, None] * self.size[nodes][None, :])
        bound = known + length[:, None] * self.radius[nodes][None, :] + slack
        for k in np.argsort(-bound.max(axis=0), kind="stable"):
            limit = best.threshold()
            live = np.flatnonzero(bound[:, k] >= limit)
            if not len(live):
                continue
            j = nodes[k]
            need = (limit[live] - known[live, k] - slack[live, k]) / np.maximum(length[live], 1e-12)
            begin, end = self.begin[j], self.end[j]
            count = int(np.searchsorted(-self.distance[begin:end], -need.min() if np.isfinite(need.min()) else np.inf, "right"))
            if count:
                some = slice(begin, begin + count)
                scores = _products(queries[live], self.vectors[some])
                self.products += scores.size
                best.offer(live, scores, self.ids[some], names)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors ** 2).sum(axis=1))


def _slack(size: np.ndarray) -> np.ndarray:
    """More than rounding can change a product of vectors whose lengths multiply to ``size``."""
    return 1e-6 + _SLACK * size


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: as doubles while sums stay below 2^53, as longs below 2^63, else one by one."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    if most < 2 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    if any(not -2 ** 63 < x < 2 ** 63 for x in exact.ravel()):
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)


class Best:
    """The k best of every query: highest scores, ties to the smaller id, never the query itself."""

    def __init__(self, queries: int, k: int, at_least: np.ndarray | None = None):
        self.score = np.full((queries, k), _NONE)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.least = np.full(queries, -np.inf) if at_least is None else at_least

    def threshold(self) -> np.ndarray:
        last = self.score[:, -1]
        return np.maximum(self.least, np.where(last == _NONE, -np.inf, last.astype(float)))

    def offer(self, live: np.ndarray, scores: np.ndarray, ids: np.ndarray, names: np.ndarray) -> None:
        scores = np.where(ids[None, :] == names[live][:, None], _NONE, scores)
        some = np.flatnonzero(scores.max(axis=1) >= np.maximum(self.score[live, -1], _NONE + 1))
        if not len(some):
            return
        rows = live[some]
        all_scores = np.concatenate([self.score[rows], scores[some]], axis=1)
        all_ids = np.concatenate([self.id[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        all_ids = np.where(all_scores == _NONE, np.iinfo(np.int64).max, all_ids)
        order = np.lexsort((all_ids, ~all_scores), axis=1)[:, :self.score.shape[1]]
        self.score[rows] = np.take_along_axis(all_scores, order, axis=1)
        self.id[rows] = np.take_along_axis(all_ids, order, axis=1)

    def rows(self, names: np.ndarray) -> pd.DataFrame:
        row, place = np.nonzero((self.score != _NONE) & (self.score >= np.where(np.isfinite(self.least), self.least, _NONE)[:, None]))
        return pd.DataFrame({"query_id": names[row], "vec_id": self.id[row, place], "score": self.score[row, place]})


def _integers(column: pa.Array, scale: float) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector, exactly, as doubles; None if it takes no part."""
    out = []
    for x in column:
        values = x.values if x.is_valid else None
        if values is None or values.null_count:
            out.append(None)
            continue
        v = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(float))
        finite = bool(np.isfinite(values.to_numpy(zero_copy_only=False).astype(float)).all())
        if finite and np.abs(v).max(initial=0) >= 2.0 ** 63:
            raise OverflowError("a component does not fit a long")
        out.append(v if finite else None)
    return out


def _packed(v: np.ndarray) -> bytes:
    """Four bytes a component where they do, else eight."""
    return (v.astype(np.int32) if np.abs(v).max(initial=0) < 2 ** 31 else v.astype(np.float64)).tobytes()


def _located(batches: Iterator[pa.RecordBatch], scale: float, centres: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Vectors that take part, with the number of components and the nearest routing object."""
    for batch in batches:
        vectors = _integers(batch.column("vector"), scale)
        keep = [i for i, v in enumerate(vectors) if v is not None]
        size = np.array([len(vectors[i]) for i in keep], np.int64)
        cell = np.zeros(len(keep), np.int64)
        for n in set(size.tolist()) & centres.keys():
            own = np.flatnonzero(size == n)
            cell[own] = _nearest(np.stack([vectors[keep[i]] for i in own]), centres[n])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(keep, pa.int64())), pa.array(size), pa.array(cell),
             pa.array([_packed(vectors[i]) for i in keep], pa.binary())],
            ["id", "size", "cell", "vector"])


def _bundle(group: pd.DataFrame) -> pd.DataFrame:
    """One row with all ids and vectors of a group."""
    group = group.sort_values("id", kind="stable")
    size, vectors = int(group["size"].iat[0]), list(group["vector"])
    if len({len(v) for v in vectors}) > 1:
        vectors = [_unpacked(v, 1, size).tobytes() for v in vectors]
    return pd.DataFrame({"size": [size], "cell": [group["cell"].iat[0]], "part": [group["part"].iat[0]],
                         "ids": [group["id"].to_numpy(np.int64).tobytes()], "vectors": [b"".join(vectors)]})


def _unpacked(vectors: bytes, n: int, size: int) -> np.ndarray:
    wide = len(vectors) == 8 * n * size
    return np.frombuffer(vectors, np.float64 if wide else np.int32).reshape(n, size).astype(float)


def _unbundle(ids: bytes, vectors: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, np.int64)
    return names, _unpacked(vectors, len(names), size)


def _bundled(rows: DataFrame, most: int) -> DataFrame:
    """Rows of a cell dealt out by a digest of the id to bundles of about ``most``."""
    parts = rows.groupBy("size", "cell").agg(F.ceil(F.count("*") / most).alias("parts"))
    dealt = rows.join(F.broadcast(parts), ["size", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("id", "vector"), F.col("parts")))
    return dealt.groupBy("size", "cell", "part").applyInPandas(
        _bundle, "size long, cell long, part long, ids binary, vectors binary")


def _summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre and covering radius of every page."""
    for batch in batches:
        rows = []
        for r in batch.itertuples():
            v = _unbundle(r.ids, r.vectors, r.size)[1]
            centre = v.mean(axis=0)
            rows.append((r.size, r.cell, r.part, centre.tobytes(), float(_distances(v, centre).max())))
        yield pd.DataFrame(rows, columns=["size", "cell", "part", "centre", "reach"])


def _gathered(group: pd.DataFrame) -> pd.DataFrame:
    column = lambda c, t: [group[c].to_numpy(t).tobytes()]
    return pd.DataFrame({"size": [group["size"].iat[0]], "cells": column("cell", np.int64), "parts": column("part", np.int64),
                         "centres": [b"".join(group["centre"])], "reaches": column("reach", float)})


def _within_reach(pages: DataFrame, blocks: DataFrame, down: int) -> DataFrame:
    """(size, cell, part, row, own_cell, own_part): pages and blocks that may have a score in common above a threshold."""
    parts = max(1, math.ceil(pages.count() / CHUNK))
    summary = pages.mapInPandas(_summary, "size long, cell long, part long, centre binary, reach double")
    chunks = summary.withColumn("chunk", F.pmod(F.xxhash64("cell", "part"), F.lit(parts))).groupBy("size", "chunk").applyInPandas(
        _gathered, "size long, cells binary, parts binary, centres binary, reaches binary")
    chunks = chunks.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [pd.DataFrame({c: [] for c in ("size", "cell", "part", "row", "own_cell", "own_part")}, dtype=np.int64)]
            for r in batch.itertuples():
                q = _unbundle(r.ids, r.vectors, r.size)[1]
                cells, own, reach = (np.frombuffer(x, t) for x, t in ((r.cells, np.int64), (r.parts, np.int64), (r.reaches, float)))
                centres = np.frombuffer(r.centres, float).reshape(len(cells), r.size)
                length = _lengths(q)[:, None]
                bound = q @ centres.T + length * reach[None, :] + _slack(length * (_lengths(centres) + reach)[None, :])
                hit = (bound >= np.frombuffer(r.least, float)[:, None]).any(axis=0)
                out.append(pd.DataFrame({"size": r.size, "cell": cells[hit], "part": own[hit], "row": r.row,
                                         "own_cell": r.cell, "own_part": r.part}))
            yield pd.concat(out).astype(np.int64)
    return blocks.join(chunks, ["size", "row"]).mapInPandas(
        reached, "size long, cell long, part long, row long, own_cell long, own_part long")


def top_k(vectors: DataFrame, queries, k: int = 20, key: str = "vec_id", vector: str = "embedding",
          scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors with the highest inner product.

    ``queries`` is a condition on the key. Components become floor(scale * x); the score is the
    integer inner product, ties go to the smaller key, and rows with the query's own key are no
    candidates. Vectors that are null or hold null or non-finite components take no part, nor do rows with a
    null key. Vectors meet those with as many components; products of empty ones are 0. A component or a score
    beyond 64 bits is an error. A query without candidates has no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "search")
    source = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector")).where("id is not null")
    n = source.count()
    share = min(1.0, SAMPLE / max(1, n))
    picked = (source.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) <= F.lit(int(share * (1 << 30))))
                    .select("vector").limit(2 * SAMPLE).toArrow().column("vector"))
    sample: dict[int, list] = {}
    for v in _integers(picked.combine_chunks() if picked.num_chunks != 1 else picked.chunk(0), scale):
        if v is not None:
            sample.setdefault(len(v), []).append(v)
    cells = max(1, min(MOST_CELLS, -(-n // PAGE)))
    centres = {size: (s := np.stack(v))[_spread_out(s, cells)] for size, v in sample.items() if size}

    located = scratch.write(source.mapInArrow(lambda b: _located(b, scale, centres),
                                              "id long, size long, cell long, vector binary"), "located")
    pages = scratch.write(_bundled(located, PAGE), "pages")
    asked = _bundled(located.where(queries(F.col("id"))), BLOCK)

    def first_look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            least = []
            for r in batch.itertuples():
                names, q = _unbundle(r.ids, r.vectors, r.size)
                best = Best(len(q), k)
                if r.page_ids is not None:
                    Tree(*_unbundle(r.page_ids, r.page_vectors, r.size)).search(q, names, best)
                least.append(best.threshold().tobytes())
            yield batch[["size", "cell", "part", "ids", "vectors"]].assign(least=least)

    one = pages.where("part = 0").select("size", "cell", F.col("ids").alias("page_ids"), F.col("vectors").alias("page_vectors"))
    blocks = scratch.write(asked.join(one, ["size", "cell"], "left").mapInPandas(
        first_look, "size long, cell long, part long, ids binary, vectors binary, least binary"), "blocks")

    across, down = (max(1, math.ceil(t.count() / GROUP)) for t in (pages, blocks))
    place = F.xxhash64("cell", "part")
    blocks = blocks.withColumn("row", F.pmod(place, F.lit(down)).cast("int"))
    pairs = scratch.write(_within_reach(pages, blocks, down), "pairs")
    left = pages.join(pairs.select("size", "cell", "part", "row").distinct(), ["size", "cell", "part"]).withColumn(
        "column", F.pmod(place, F.lit(across)))
    met = pairs.select("size", F.pmod(place, F.lit(across)).alias("column"), F.col("own_cell").alias("cell"),
                       F.col("own_part").alias("part")).distinct()
    right = blocks.join(met, ["size", "cell", "part"])

    def search(tables: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        trees = [Tree(*_unbundle(r.ids, r.vectors, r.size)) for r in tables.itertuples()]
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)]
        for r in asked.itertuples():
            names, q = _unbundle(r.ids, r.vectors, r.size)
            best = Best(len(q), k, np.frombuffer(r.least, float))
            reach = [(q @ t.centre + np.sqrt((q ** 2).sum(axis=1)) * (t.to_centre + t.radius).max()).max() for t in trees]
            for i in np.argsort(-np.array(reach)):
                trees[i].search(q, names, best)
            out.append(best.rows(names))
        return pd.concat(out).astype(np.int64)

    keys = ["size", "column", "row"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
