"""Fingerprints, reproducible pseudo-random keys and exact selection by key.

Nothing here sorts a whole table in one task: selections find the deciding key
value with aggregates that combine on the map side, then filter row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.schema import is_floating

SORTED_KEYS = 20_000        # keys, without their rows, that one task sorts at the end of a search
FEW_ROWS = 1_000            # of a group that one task may sort for every task before it
PIVOTS = 64                 # keys that a counting pass compares with
_DIGEST, _HASH = "_row_digest", "_row_hash"
HASH_DIGITS = 15            # hexadecimal digits of the md5 that make the 60-bit key
BUCKET_DIGITS = 3           # leading digits that name the bucket: 4096 buckets


def fingerprint(df: DataFrame, columns) -> Column:
    """256-bit digest of a row over ``columns``; nulls are equal to nulls.

    Each value is length-prefixed, so no two different rows have the same encoding.
    Shuffling the digest instead of the values keeps text out of the exchange.
    """
    parts = []
    for name in columns:
        c = F.col(f"`{name}`")
        if is_floating(df.schema[name].dataType):
            c = F.when(~F.isnan(c), c + F.lit(0.0))       # NaN is missing, -0.0 equals 0.0
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hash_key(seed, key: Column) -> Column:
    """Reproducible uniform key in 15 hexadecimal digits of md5(seed:key)."""
    return F.left(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), F.lit(HASH_DIGITS))


def small_side(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast a side that is proven small, or leave the join to Spark.

    At most ``max_rows`` + 1 rows reach the driver. Within the bound they come back
    as a broadcast local relation, so the side is computed once; beyond it the
    frame is returned without a hint and the join shuffles.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def keep_first(df: DataFrame, on, key: str) -> DataFrame:
    """First row by ``key`` of every group of rows equal on ``on``.

    The group minimum combines before the shuffle, so a group that holds a third of
    the table costs no more than any other; rows then travel by their unique key.
    """
    winners = df.groupBy(fingerprint(df, on).alias("_fp")).agg(F.min(key).alias(key)).select(key)
    return df.join(winners, key, "left_semi")


def require_unique(df: DataFrame, key: str) -> None:
    """Raise unless ``key`` identifies rows: not null and never repeated."""
    bad = (df.groupBy(key).count()
             .where((F.col("count") > 1) | F.col(key).isNull()).limit(1).collect())
    if bad:
        raise ValueError(f"{key!r} must be unique and not null; offending value: {bad[0][0]!r}")


def _literal(row, schema) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields])


def _cut(keys: DataFrame, n: int):
    """The ``n``-th smallest row of ``keys`` and how many rows are smaller; None beyond the end.

    Every pass counts the rows up to some sampled keys and goes on between two of them, until few
    enough keys are left to be sorted. Samples only steer the passes; the result is exact.
    """
    key, schema = F.struct(*keys.columns), keys.schema
    here, left, total = keys, n, keys.count()
    if total < n:
        return None
    while total > SORTED_KEYS:
        sample = here.sample(min(1.0, 4 * PIVOTS / total)).distinct().limit(16 * PIVOTS)
        found = sample.orderBy(*keys.columns).collect()
        found = found[::max(1, len(found) // PIVOTS)]
        if not found:
            continue
        upto = here.agg(*[F.count_if(key <= _literal(r, schema)).alias(f"n{i}") for i, r in enumerate(found)],
                        F.countDistinct(key).alias("kinds") if len(found) == 1 else F.lit(2).alias("kinds")).head()
        if upto["kinds"] == 1:
            return found[0], n - left
        low = max((i for i in range(len(found)) if upto[f"n{i}"] < left), default=None)
        high = min((i for i in range(len(found)) if upto[f"n{i}"] >= left), default=None)
        before = upto[f"n{low}"] if low is not None else 0
        size = (upto[f"n{high}"] if high is not None else total) - before
        if high is not None and size == total and here.where(key < _literal(found[high], schema)).isEmpty():
            return found[high], n - left                      # one key fills the range
        if low is not None:
            here = here.where(key > _literal(found[low], schema))
        if high is not None:
            here = here.where(key <= _literal(found[high], schema))
        left, total = left - before, size
    nearest = here.orderBy(*keys.columns).limit(left).collect()
    return nearest[-1], n - left + nearest.index(nearest[-1])


def first_rows(df: DataFrame, n: int | None, order) -> DataFrame:
    """Exactly the first ``n`` rows by the columns in ``order``; all rows if ``n`` is None.

    Any sortable columns; null comes first. Rows with equal keys are taken by a digest of the whole
    row. Only keys are looked at to find the last row taken; then rows are filtered where they are.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    order = [order] if isinstance(order, str) else list(order)
    found = _cut(df.select(*[F.col(f"`{c}`") for c in order]), n)
    if found is None:
        return df
    key = F.struct(*[F.col(f"`{c}`") for c in order])
    last = _literal(found[0], df.select(*[F.col(f"`{c}`") for c in order]).schema)
    before, ties = df.where(key < last), df.where(key == last)
    wanted, there = n - found[1], ties.count()
    if there <= wanted:
        return df.where(key <= last)
    if order == [_DIGEST]:
        return before.unionByName(ties.limit(wanted))          # equal rows: any of them
    some = first_rows(ties.withColumn(_DIGEST, fingerprint_of_row(ties)), wanted, _DIGEST).drop(_DIGEST)
    return before.unionByName(some)


def fingerprint_of_row(df: DataFrame) -> Column:
    return F.sha2(F.to_json(F.struct("*")), 256) if df.columns else F.lit("")


def hash_cut(df: DataFrame, size: DataFrame, key: str, seed, by=()) -> DataFrame:
    """For each group the largest hash key (and row key) among its ``_k`` smallest.

    ``size`` has the group columns and ``_k``. Hash keys are uniform, so counting per
    4096 leading values finds the deciding bucket, and only that 1/4096 of the keys is
    ranked, each with its number of rows. Returns the group columns, ``_k``, ``_cut_hash``, ``_cut_key``,
    the rows ``_cut_n`` that have this key and how many of them, ``_cut_take``, are among the smallest.
    """
    by = list(by)
    h = df.select(*by, F.col(key).alias("_id"), hash_key(seed, F.col(key)).alias("_h"))
    h = h.withColumn("_b", F.left("_h", F.lit(BUCKET_DIGITS)))
    per_bucket = h.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_b"))
    sized = per_bucket.withColumn("_upto", upto)
    join_size = (lambda d: d.join(size, by)) if by else (lambda d: d.crossJoin(F.broadcast(size)))
    deciding = (join_size(sized)
                .where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_n") < F.col("_k")))
                .select(*by, "_b", "_k", (F.col("_k") - F.col("_upto") + F.col("_n")).alias("_rank")))
    deciding = small_side(deciding)
    keys = h.join(deciding, [*by, "_b"]).groupBy(*by, "_b", "_k", "_rank", "_h", "_id").agg(F.count("*").alias("_n"))
    here = F.sum("_n").over(Window.partitionBy(*by, "_b").orderBy("_h", "_id"))
    take = F.col("_rank") - F.col("_here") + F.col("_n")
    return (keys.withColumn("_here", here).where(take.between(1, F.col("_n")))
                .select(*by, "_k", F.col("_h").alias("_cut_hash"), F.col("_id").alias("_cut_key"),
                        F.col("_n").alias("_cut_n"), take.alias("_cut_take")))


def before_cut(seed, key: str) -> Column:
    """Whether a row joined to its ``hash_cut`` row is one of the ``_k`` smallest."""
    h = hash_key(seed, F.col(key))
    return F.coalesce(
        (h < F.col("_cut_hash"))
        | ((h == F.col("_cut_hash")) & (F.col(key) <= F.col("_cut_key"))), F.lit(False))


def seeded_sample(df: DataFrame, n: int, key: str, seed=42) -> DataFrame:
    """``n`` rows without replacement, the same ones on every run; all rows if fewer."""
    hashed = df.withColumn(_HASH, hash_key(seed, F.col(f"`{key}`")))
    return first_rows(hashed, n, [_HASH, key]).drop(_HASH)


def first_per_group(df: DataFrame, n: int, by: str, order) -> DataFrame:
    """First ``n`` rows of each group, with their position in ``rank``.

    Spark limits each group before the shuffle (window group limit), so a hot group
    sends ``n`` rows per task, not all its rows. Beyond ``FEW_ROWS`` that limit saves little:
    positions are then found by ranges over all groups, ties by a digest of the row.
    """
    if n > FEW_ROWS:
        from corpusmill.functions.ranks import positions_in_groups
        return positions_in_groups(df, by, order).where(F.col("rank") <= n)
    w = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
