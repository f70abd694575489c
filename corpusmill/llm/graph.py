"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, component): the smallest id that each linked id reaches; unlinked ids have no row.

    ``links`` has long columns a and b. Every round hooks each vertex to its smallest neighbour,
    follows the hooks once more, and keeps only links between different classes. A chain shrinks
    by a constant factor a round and a star ends in one, so rounds grow with the logarithm of the
    longest chain. Minima combine before the shuffle: a vertex with very many links is no hot spot.
    Nothing but the number of links left reaches the driver.
    """
    left = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = scratch.write(left, f"{name}-links0")
    found, turn = None, 0
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("up")).select(
            "id", F.least("id", "up").alias("up"))
        higher = hook.select(F.col("id").alias("up"), F.col("up").alias("upper"))
        jumped = hook.join(higher, "up", "left").select("id", F.coalesce("upper", "up").alias("up"))
        jumped = scratch.write(jumped, f"{name}-jump{turn}")
        if found is None:
            found = jumped.select("id", F.col("up").alias("component"))
        else:
            found = found.join(jumped.select(F.col("id").alias("component"), "up"), "component", "left").select(
                "id", F.coalesce("up", "component").alias("component"))
        found = scratch.write(found, f"{name}-found{turn}")
        ends = left
        for side in ("a", "b"):
            ends = ends.join(jumped.select(F.col("id").alias(side), F.col("up").alias(f"{side}_up")), side)
        turn += 1
        left = scratch.write(
            ends.where("a_up <> b_up").select(F.least("a_up", "b_up").alias("a"),
                                              F.greatest("a_up", "b_up").alias("b")).distinct(),
            f"{name}-links{turn}")
        for table in ("jump", "links", "found"):       # what nothing reads any more
            scratch.drop(f"{name}-{table}{turn - 1 - (table == 'found')}")
    if found is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found
