"""Positions of all rows in a sorted order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.durable import written
from corpusmill.functions.keys import fingerprint_of_row, small_side

RANGE_ROWS = 5_000_000      # rows that one task sorts at most
SPREAD_ROWS = 50_000        # rows from which all cores take part
_DIGEST, _ROW, _AT = "_rank_digest", "_rank_row", "_rank_at"
_OFFSET_BITS = 33           # of monotonically_increasing_id: row within its partition


def _sorted_ranges(df: DataFrame, keys, ranges: int) -> DataFrame:
    """Rows with their range and their place in it in ``_AT``, written once: ranges are sampled."""
    columns = [F.col(f"`{k}`") if isinstance(k, str) else k for k in keys]
    rows = df.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)
    return written(rows.withColumn(_AT, F.monotonically_increasing_id()), "ranges")


def ranked(df: DataFrame, order, into: str = "rank", size: int = RANGE_ROWS) -> DataFrame:
    """``df`` with the 0-based position of every row by the columns in ``order`` (nulls first).

    Any sortable columns, by name or as sort expressions. Rows with equal keys follow a digest of the whole row; equal rows are
    interchangeable. Rows are dealt to sampled ranges and sorted there; a range's first position is
    the number of rows in the ranges before it. A range of more than ``size`` rows is dealt out
    again in the same way, so no task sorts more. Only the sizes of ranges reach the driver.
    """
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    keys = [*order, _DIGEST, _ROW]
    tagged = written(df.select("*", fingerprint_of_row(df).alias(_DIGEST), F.monotonically_increasing_id().alias(_ROW)), "rows")
    total = tagged.count()
    pending, done = [(tagged, total, 0)], []
    while pending:
        rows, n, before = pending.pop()
        ranges = max(1, 2 * n // size, df.sparkSession.sparkContext.defaultParallelism if n > min(size, SPREAD_ROWS) else 1)
        parted = _sorted_ranges(rows, keys, ranges)
        number = F.shiftright(_AT, _OFFSET_BITS)
        sizes = sorted(tuple(r) for r in parted.groupBy(number.alias("r")).agg(F.count("*")).collect())
        starts, large = [], []
        for r, k in sizes:
            if k > max(size, 1) and k > 1:
                large.append(r)
                pending.append((parted.where(number == r).drop(_AT), k, before))
            else:
                starts.append((r, before))
            before += k
        if starts:
            firsts = F.create_map(*[F.lit(x).cast("long") for s in starts for x in s]) if len(starts) <= 64 else None
            offset = F.col(_AT).bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1))
            kept = parted.where(~number.isin(large)) if large else parted
            if firsts is not None:
                numbered = kept.withColumn(into, F.element_at(firsts, number) + offset)
            else:                                            # one row for each range
                table = df.sparkSession.createDataFrame(starts, "_range long, _before long")
                numbered = kept.join(F.broadcast(table), number == F.col("_range")).withColumn(into, F.col("_before") + offset)
            done.append(numbered.select(*[F.col(f"`{c}`") for c in df.columns], into))
    out = done[0] if done else df.select("*", F.lit(0).cast("long").alias(into)).limit(0)
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def positions_in_groups(df: DataFrame, by: str, order, into: str = "rank", size: int = RANGE_ROWS) -> DataFrame:
    """``df`` with the position of every row, from 1, in its group: however large a group is, many tasks sort it."""
    at = ranked(df, [by, *order], "_rank_at_all", size)
    first = small_side(at.groupBy(F.col(f"`{by}`").alias("_rank_group")).agg(F.min("_rank_at_all").alias("_rank_first")))
    met = at.join(first, F.col(f"`{by}`").eqNullSafe(F.col("_rank_group")))
    place = (F.col("_rank_at_all") - F.col("_rank_first") + 1).cast("int")
    return met.select(*[F.col(f"`{c}`") for c in df.columns], place.alias(into))
