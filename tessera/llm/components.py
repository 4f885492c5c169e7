"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import staged, superseded

#: Links that a task holds at a time.
HELD = 1 << 20


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 to n - 1 the smallest node that the links reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def stars(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) replaced by as few that join the same nodes, among each ``HELD`` of a task."""

    def star(held: list[pd.DataFrame]) -> pd.DataFrame:
        links = pd.concat(held)
        nodes, at = np.unique(links[["a", "b"]].to_numpy().T.ravel(), return_inverse=True)
        root = roots(at[: len(links)], at[len(links) :], nodes.size)
        own = root != np.arange(nodes.size)
        return pd.DataFrame({"a": nodes[root[own]], "b": nodes[own]})

    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= HELD:
            yield star(held)
            held, size = [], 0
    if size:
        yield star(held)


def components(links: DataFrame, contracted: bool = False) -> DataFrame:
    """Rows (key, comp) for the ends of ``links`` (a, b), longs; comp is a key of the component.

    Links are first contracted within each task, where the caller has not done so. Then, round by round, each node gives way to its
    smallest neighbour, and the links of what is left go on, without loops and repeats. Keys are
    hashes, so a path loses a constant share of its nodes each round. What each round decided is
    written to the shared folder and looked up backwards at the end.
    """
    few = links.select("a", "b") if contracted else links.select("a", "b").mapInPandas(stars, "a long, b long")
    left = staged(few.distinct(), "links")
    rounds = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("key"), F.least("a", "low").alias("comp")), "moved")
        rounds.append(moved)
        one = moved.select(F.col("key").alias("a"), F.col("comp").alias("x"))
        other = moved.select(F.col("key").alias("b"), F.col("comp").alias("y"))
        ends = left.join(one, "a").join(other, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        before, left = left, staged(ends.mapInPandas(stars, "a long, b long").distinct(), "links")
        superseded(before)
    superseded(left)
    if not rounds:
        return links.select(F.col("a").alias("key"), F.col("b").alias("comp")).where(F.lit(False))
    found = rounds.pop()
    for earlier in reversed(rounds):
        further = found.select(F.col("key").alias("comp"), F.col("comp").alias("last"))
        whole = staged(earlier.join(further, "comp", "left").select("key", F.coalesce("last", "comp").alias("comp")), "moved")
        superseded(found, earlier)
        found = whole
    return found
