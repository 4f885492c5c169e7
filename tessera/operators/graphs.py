"""Connected components of links between rows of any kind, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.storage import staged


def components(links: DataFrame) -> DataFrame:
    """Rows (node, part) for the ends of ``links`` (a, b); ``part`` is one node of the component.

    In each round every node gives way to the neighbour of the least hash, if that is less than its
    own, and the links between what is left go on. Hashes change by round, so that orders which lie
    along a path, as places do, cost no more than others: a constant share of nodes goes each time.
    Rounds are written to the shared folder and looked up backwards at the end.
    """
    left = staged(links.where("a <> b").select("a", "b").distinct())
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        draw = lambda c: F.xxhash64(c, F.lit(len(rounds)))  # noqa: B023, E731
        low = both.groupBy("a").agg(F.min_by("b", draw("b")).alias("low"))
        moved = staged(low.select(F.col("a").alias("node"), F.when(draw("low") < draw("a"), F.col("low")).otherwise(F.col("a")).alias("part")))
        rounds.append(moved)
        ends = left.join(moved.select(F.col("node").alias("a"), F.col("part").alias("x")), "a").join(moved.select(F.col("node").alias("b"), F.col("part").alias("y")), "b")
        left = staged(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("part")).where(F.lit(False))
    found = rounds.pop()
    for earlier in reversed(rounds):
        further = found.select(F.col("node").alias("part"), F.col("part").alias("last"))
        found = staged(earlier.join(further, "part", "left").select("node", F.coalesce("last", "part").alias("part")))
    return found
