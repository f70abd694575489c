"""Exact order statistics and quantiles, found with counting passes.

No pass gathers a share of the table anywhere: sketches merge in many reducers, counts
combine before the shuffle, and values are only ranked once few enough are left. Values
are ranked in their column's own type; only what is interpolated becomes a fraction.
"""

from __future__ import annotations

import decimal
import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.durable import written
from corpusmill.schema import is_floating

RANK_DIRECTLY = 5_000_000   # rows that may be ranked as they are (one spilling sort)
ACCURACY = 10_000           # sketch error 1/ACCURACY
GRID = 1_000                # quantiles read from each partial sketch
SKETCHES = 256              # reducers, and partial sketches that reach the driver
MARGIN = 3 / GRID           # more than grid step plus sketch error


@dataclass
class _Target:
    """The value of 0-based ``rank`` among the ``n`` values of a column in an open range."""

    column: str
    rank: int
    n: int
    lo: object = None
    hi: object = None
    value: object = None
    direct: bool = False        # rank as it is

    @property
    def range(self):
        return self.column, self.lo, self.hi

    def inside(self) -> Column:
        x = F.col(self.column)
        c = x.isNotNull()
        if self.lo is not None:
            c = c & (x > F.lit(self.lo))
        if self.hi is not None:
            c = c & (x < F.lit(self.hi))
        return c


def _brackets(df: DataFrame, targets: list[_Target]) -> list[tuple]:
    """For each target two values that enclose its rank, from sketches of its range."""
    ranges = list(dict.fromkeys(t.range for t in targets))
    sample = {t.range: t for t in targets}
    grid = F.expr("array(" + ", ".join(f"{k / GRID}D" for k in range(GRID + 1)) + ")")
    aggs = []
    for i, r in enumerate(ranges):
        x = F.when(sample[r].inside(), F.col(r[0]))
        aggs += [F.percentile_approx(x, grid, ACCURACY).alias(f"q{i}"), F.count(x).alias(f"n{i}")]
    rows = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("_part")).agg(*aggs).collect()
    out, last = [], None
    for t in targets:
        if last and last.range == t.range and t.rank == last.rank + 1:
            out.append(out[-1])                               # neighbours share a bracket
            last = t
            continue
        last = t
        i = ranges.index(t.range)
        parts = [(r[f"q{i}"], r[f"n{i}"]) for r in rows if r[f"n{i}"]]
        values = np.concatenate([np.asarray(q) for q, _ in parts])
        weights = np.concatenate([np.full(len(q), n / len(q)) for q, n in parts])
        order = np.argsort(values, kind="stable")
        values, upto = values[order], np.cumsum(weights[order]) / sum(n for _, n in parts)
        at = [min(np.searchsorted(upto, p), len(values) - 1)
              for p in (t.rank / t.n - MARGIN, t.rank / t.n + MARGIN)]
        out.append(tuple(v.item() if isinstance(v, np.generic) else v for v in values[at]))
    return out


def _narrow_down(df: DataFrame, targets: list[_Target]) -> None:
    """One sketch pass and one counting pass: every target's range shrinks or ends."""
    brackets = _brackets(df, targets)
    aggs = []
    for i, (t, (a, b)) in enumerate(zip(targets, brackets)):
        x = F.when(t.inside(), F.col(t.column))
        aggs += [F.count_if(c).alias(f"{k}{i}") for k, c in (
            ("a", x < F.lit(a)), ("b", x <= F.lit(a)), ("c", x < F.lit(b)), ("d", x <= F.lit(b)))]
    row = df.agg(*aggs).head()
    for i, (t, (a, b)) in enumerate(zip(targets, brackets)):
        below_a, upto_a, below_b, upto_b = (row[f"{k}{i}"] for k in "abcd")
        before = t.n, t.lo, t.hi
        if t.rank < below_a:
            t.n, t.hi = below_a, a
        elif t.rank < upto_a:
            t.value = a
        elif t.rank < below_b:
            t.rank, t.n, t.lo, t.hi = t.rank - upto_a, below_b - upto_a, a, b
        elif t.rank < upto_b:
            t.value = b
        else:
            t.rank, t.n, t.lo = t.rank - upto_b, t.n - upto_b, b
        # Sketches work on doubles: integers they can't tell apart are few distinct values.
        t.direct = (t.n, t.lo, t.hi) == before


def _rank(df: DataFrame, targets: list[_Target]) -> None:
    """One pass: equal values combine, then running counts give every target's value."""
    ranges = list(dict.fromkeys(t.range for t in targets))
    sample = {t.range: t for t in targets}
    cells = [F.when(sample[r].inside(), F.struct(F.lit(i).alias("k"), F.col(r[0]).alias("v")))
             for i, r in enumerate(ranges)]
    counts = (df.select(F.explode(F.array(*cells)).alias("s")).where(F.col("s").isNotNull())
                .groupBy("s.k", "s.v").agg(F.count("*").alias("n")))
    ranked = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("k").orderBy("v")))
    row = ranked.agg(*[
        F.min(F.when((F.col("k") == ranges.index(t.range)) & (F.col("upto") > t.rank), F.col("v"))).alias(f"t{i}")
        for i, t in enumerate(targets)]).head()
    for i, t in enumerate(targets):
        t.value = row[f"t{i}"]


def values_at_ranks(df: DataFrame, wanted: dict, counts: dict, narrow=()) -> dict:
    """``{column: {0-based rank: value}}`` for ``wanted`` ``{column: ranks}``.

    ``counts`` has the non-null rows per column. All columns and ranks share each pass.
    Columns in ``narrow`` have few distinct values and are ranked directly.
    """
    targets = {(c, r): _Target(c, r, counts[c], direct=c in narrow) for c, ranks in wanted.items() for r in ranks}
    while True:
        large = [t for t in targets.values()
                 if t.value is None and not t.direct and t.n > RANK_DIRECTLY]
        if not large:
            break
        _narrow_down(df, large)
    small = [t for t in targets.values() if t.value is None]
    kinds = dict(df.dtypes)
    for kind in dict.fromkeys(kinds[t.column] for t in small):            # values keep their type
        _rank(df, [t for t in small if kinds[t.column] == kind])
    out: dict = {c: {} for c in wanted}
    for (c, r), t in targets.items():
        out[c][r] = t.value
    return out


@dataclass(frozen=True)
class Quantiles:
    n: int
    values: tuple


def _between(low, high, share: float, exact: bool):
    """The value at ``share`` of the way from one to the next."""
    if low is None or isinstance(low, float) or not exact:
        return None if low is None else float(low) + (float(high) - float(low)) * share
    if share == 0 or low == high:
        return decimal.Decimal(low)
    with decimal.localcontext(prec=80):
        low, part = decimal.Decimal(low), Fraction(share)
        return low + (high - low) * part.numerator / part.denominator


def exact_quantiles(df: DataFrame, columns, probs, narrow=(), exact: bool = False) -> dict[str, Quantiles]:
    """Exact linearly interpolated quantiles per column; None for a column without values.

    They are floats, or with ``exact`` decimals for integer and decimal columns, without any rounding.
    An action, like ``approxQuantile``: a few numbers per column come back.
    """
    names = {f"v{i}": c for i, c in enumerate(columns)}

    def value(c: str) -> Column:
        x = F.col(f"`{c}`")
        return x.cast("double") if is_floating(df.schema[c].dataType) else x
    work = df.select([value(c).alias(v) for v, c in names.items()])
    row = work.agg(*[F.count(v).alias(v) for v in names]).head()
    counts = {v: row[v] for v in names}
    height = {v: [p * (counts[v] - 1) for p in probs] for v in names if counts[v]}
    wanted = {v: sorted({r for h in hs for r in (math.floor(h), math.ceil(h))}) for v, hs in height.items()}
    found = values_at_ranks(work, wanted, counts, {v for v, c in names.items() if c in narrow})
    out = {}
    for v, c in names.items():
        vals = [None] * len(probs)
        if counts[v]:
            at = found[v]
            vals = [_between(at[math.floor(h)], at[math.ceil(h)], h - math.floor(h), exact) for h in height[v]]
        out[c] = Quantiles(counts[v], tuple(vals))
    return out


def group_quantiles(df: DataFrame, by, value: str, probs, weight: str | None = None) -> DataFrame:
    """``(by..., n, q)``: values of each group and an array of their exact interpolated quantiles.

    Equal values of a group combine first, each with its number of rows (or sum of ``weight``). What is
    left is dealt to sampled ranges of (group, value), so that one group with all rows is many tasks;
    sums of the ranges tell which of them hold the wanted ranks, and only those are ranked.
    """
    by, probs = list(by), list(probs)
    group = [F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(by)] or [F.lit(0).alias("_g0")]
    g = [f"_g{i}" for i in range(len(group))]
    rows = df.where(F.col(f"`{value}`").isNotNull()).select(
        *group, F.col(f"`{value}`").alias("_v"), (F.col(f"`{weight}`") if weight else F.lit(1)).cast("long").alias("_n"))
    cells = rows.groupBy(*g, "_v").agg(F.sum("_n").alias("_n")).repartitionByRange(*g, "_v")
    cells = written(cells.withColumn("_range", F.spark_partition_id()), "cells")
    sums = cells.groupBy(*g, "_range").agg(F.sum("_n").alias("_n"))       # ranges and groups
    whole = Window.partitionBy(*g)
    sums = sums.select(*g, "_range", "_n", F.sum("_n").over(whole).alias("_total"),
                       (F.sum("_n").over(whole.orderBy("_range")) - F.col("_n")).alias("_before"))
    heights = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    ranks = F.array(*[F.struct(F.lit(2 * i + j).alias("k"), near(h).cast("long").alias("rank"))
                      for i, h in enumerate(heights) for j, near in enumerate((F.floor, F.ceil))])
    wanted = sums.select(*g, "_range", "_total", "_before", F.explode(F.filter(
        ranks, lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_n")))).alias("r"))
    there = wanted.select(*[F.col(c).alias(f"{c}w") for c in [*g, "_range"]]).distinct()
    same = cells["_range"] == there["_rangew"]
    for c in g:
        same = same & cells[c].eqNullSafe(there[f"{c}w"])
    deciding = cells.join(there, same, "left_semi")
    upto = F.sum("_n").over(Window.partitionBy(*g, "_range").orderBy("_v"))
    ranked = deciding.withColumn("_upto", upto).withColumnsRenamed({c: f"{c}c" for c in [*g, "_range", "_n"]})
    here = F.col("r.rank") - F.col("_before")
    hit = (ranked["_rangec"] == wanted["_range"]) & (here >= F.col("_upto") - F.col("_nc")) & (here < F.col("_upto"))
    for c in g:
        hit = hit & ranked[f"{c}c"].eqNullSafe(wanted[c])
    found = wanted.join(ranked, hit).groupBy(*g).agg(
        F.first("_total").alias("n"), *[F.max(F.when(F.col("r.k") == k, F.col("_v"))).alias(f"_v{k}") for k in range(2 * len(probs))])

    def between(i: int) -> Column:
        h = F.lit(float(probs[i])) * (F.col("n") - 1)
        low, high = F.col(f"_v{2 * i}").cast("double"), F.col(f"_v{2 * i + 1}").cast("double")
        return low + (high - low) * (h - F.floor(h))
    return found.select(*[F.col(f"_g{i}").alias(c) for i, c in enumerate(by)], "n",
                        F.array(*map(between, range(len(probs)))).alias("q"))
