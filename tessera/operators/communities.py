"""Communities of graphs of any size: Leiden's moves, refinement and contraction as joins.

A level keeps nodes as rows (run, node, k, rate, home) and links in both directions as rows
(run, src, dst, weight); a run is a resolution, ``k`` the sum of a node's links, ``rate`` the resolution
over the sum of all ``k``. All runs go together. Nothing but the number of runs has a bound.

In a round every node finds its best community, and communities either take or give, so that what a
node gains is known but for the others that move with it. Those are counted against it: a node moves if
it gains even when all that come before it (by draw) have moved too. So each round makes the
communities better, the best move of all is always made, and rounds end when no node gains.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import clustering
from tessera.sources.storage import staged

#: Parts of those that move to or from one community, in the order of draws.
PARTS = 64


def _slack(*sizes: Column) -> Column:
    """What sums in another order may differ by."""
    return 1e-12 + 1e-11 * sum(sizes, F.lit(0.0))


def _of(state: DataFrame, node: str, home: str, what: str = "home") -> DataFrame:
    return state.select("run", F.col("node").alias(node), F.col(what).alias(home))


def _wishes(links: DataFrame, state: DataFrame, takers: DataFrame | None, number: int) -> DataFrame:
    """Nodes that may leave (``may``) and gain by a move, with the best one of all to ``takers`` (run, there)."""
    sums = links.join(_of(state, "dst", "there"), ["run", "dst"]).groupBy("run", F.col("src").alias("node"), "there").agg(F.sum("weight").alias("links"))
    whole = state.groupBy("run", "home").agg(F.sum("k").alias("whole"))
    own = state.where("may").select("run", "node", "k", "rate", "home").join(whole, ["run", "home"])
    there = whole.select("run", F.col("home").alias("there"), F.col("whole").alias("there_whole"))
    there = there.withColumn("takes", F.lit(True)) if takers is None else there.join(takers.select("run", "there", F.lit(True).alias("takes")), ["run", "there"], "left")
    every = sums.join(own, ["run", "node"]).join(there, ["run", "there"])
    value = F.col("links") - F.col("rate") * F.col("k") * F.col("there_whole")
    other = F.when((F.col("there") != F.col("home")) & F.col("takes"), F.struct(value.alias("value"), F.xxhash64("there", F.lit(number)).alias("draw"), F.col("there").alias("to"), F.col("links").alias("links"), F.col("there_whole").alias("whole")))
    best = every.groupBy("run", "node", "k", "rate", "home", "whole").agg(F.max(other).alias("best"), F.coalesce(F.max(F.when(F.col("there") == F.col("home"), F.col("links"))), F.lit(0.0)).alias("stay_links"))
    stay = F.col("stay_links") - F.col("rate") * F.col("k") * (F.col("whole") - F.col("k"))
    rows = best.where("best is not null").withColumn("gain", F.col("best.value") - stay)
    slack = _slack(F.col("best.links"), F.col("stay_links"), F.col("rate") * F.col("k") * (F.col("best.whole") + F.col("whole")))
    return rows.withColumn("slack", slack).where("gain > slack").select("run", "node", "k", "rate", "home", "whole", "stay_links", F.col("best.to").alias("to"), F.col("best.links").alias("links"), F.col("best.whole").alias("to_whole"), "gain", "slack")


def _moves(wishes: DataFrame, number: int) -> DataFrame:
    """(run, node, to): wishes that gain together."""
    flows = wishes.select("run", F.col("to").alias("c"), "gain").unionByName(wishes.select("run", F.col("home").alias("c"), (-F.col("gain")).alias("gain")))
    sums = flows.groupBy("run", "c").agg(F.sum("gain").alias("more"), F.sum(F.abs("gain")).alias("size"))
    takes = F.when(F.abs("more") <= 1e-9 * F.col("size"), F.pmod(F.xxhash64("c", F.lit(number), F.lit("role")), F.lit(2)) == 0).otherwise(F.col("more") > 0)
    roles = staged(sums.select("run", "c", takes.alias("takes")))
    able = wishes.join(roles.where("takes").select("run", F.col("c").alias("to")), ["run", "to"], "left_semi")
    able = staged(able.join(roles.where("not takes").select("run", F.col("c").alias("home")), ["run", "home"], "left_semi"))
    place = F.pmod(F.xxhash64("node", F.lit(number), F.lit("place")), F.lit(PARTS))
    for side in ("to", "home"):
        first = able.groupBy("run", side).agg(F.max(F.struct("gain", "node")).alias("first"))
        able = able.join(first, ["run", side]).withColumn(f"{side}_part", F.when(F.col("node") == F.col("first.node"), -1).otherwise(place)).drop("first")
    able = staged(able)
    rows = able
    for side in ("to", "home"):
        per = able.groupBy("run", side, f"{side}_part").agg(F.sum("k").alias("k"))
        upto = Window.partitionBy("run", side).orderBy(f"{side}_part")  # at most PARTS + 1 rows
        rows = rows.join(per.select("run", side, f"{side}_part", F.sum("k").over(upto).alias(f"{side}_before")), ["run", side, f"{side}_part"])
    gain = F.col("links") - F.col("rate") * F.col("k") * (F.col("to_whole") + F.col("to_before") - F.col("k"))
    loss = F.col("stay_links") - F.col("rate") * F.col("k") * (F.col("whole") - F.col("home_before"))
    return rows.where(gain - loss > F.col("slack")).select("run", "node", "to")


def _moved(links: DataFrame, state: DataFrame) -> DataFrame:
    """Nodes in the communities they move to until none gains by a move."""
    number = 0
    while True:
        wishes = staged(_wishes(links, state.withColumn("may", F.lit(True)), None, number))
        if wishes.isEmpty():
            return state
        state = staged(state.join(_moves(wishes, number), ["run", "node"], "left").select("run", "node", "k", "rate", F.coalesce("to", "home").alias("home")))
        number += 1


def _refined(links: DataFrame, state: DataFrame) -> DataFrame:
    """Nodes with ``part``: of each community the nodes that are well connected to the rest of it join
    parts that are well connected too, so that no part falls apart into pieces without a link."""
    both = links.join(_of(state, "src", "a"), ["run", "src"]).join(_of(state, "dst", "b"), ["run", "dst"])
    inner = staged(both.where("a = b").select("run", "src", "dst", "weight"))
    whole = state.groupBy("run", "home").agg(F.sum("k").alias("community"))
    cut = inner.groupBy("run", F.col("src").alias("node")).agg(F.sum("weight").alias("inside"))
    well = lambda inside, k: F.col(inside) >= F.col("rate") * F.col(k) * (F.col("community") - F.col(k)) - 1e-12
    base = state.join(whole, ["run", "home"]).join(cut, ["run", "node"], "left").fillna(0.0, ["inside"])
    parts = staged(base.select("run", "node", "k", "rate", F.col("home").alias("within"), F.col("node").alias("home"), "community", well("inside", "k").alias("well")))
    number = 0
    while True:
        across = inner.join(_of(parts, "src", "home"), ["run", "src"]).join(_of(parts, "dst", "b"), ["run", "dst"]).where("home <> b").groupBy("run", "home").agg(F.sum("weight").alias("inside"))
        sizes = parts.groupBy("run", "home").agg(F.sum("k").alias("of"), F.count(F.lit(1)).alias("n"), F.first("rate").alias("rate"), F.first("community").alias("community"))
        sizes = staged(sizes.join(across, ["run", "home"], "left").fillna(0.0, ["inside"]).select("run", F.col("home").alias("there"), "n", well("inside", "of").alias("takes")))
        alone = parts.join(sizes.where("n = 1").select("run", F.col("there").alias("home"), F.lit(True).alias("alone")), ["run", "home"], "left")
        wishes = staged(_wishes(inner, alone.withColumn("may", F.col("well") & F.coalesce("alone", F.lit(False))), sizes.where("takes"), number))
        if wishes.isEmpty():
            return parts.select("run", "node", "k", "rate", F.col("within").alias("home"), F.col("home").alias("part"))
        parts = staged(parts.join(_moves(wishes, number), ["run", "node"], "left").withColumn("home", F.coalesce("to", "home")).drop("to").select(*parts.columns))
        number += 1


def _solved(links: DataFrame, state: DataFrame, seed: int) -> DataFrame:
    """The rest of the way for graphs that fit a task, a task for each run: (run, node, home)."""
    kind = state.schema["node"].dataType.simpleString()
    rows = state.select("run", F.col("node").alias("src"), F.lit(None).cast(kind).alias("dst"), F.col("k").alias("weight"), "rate", "home")
    rows = rows.unionByName(links.select("run", "src", "dst", "weight"), allowMissingColumns=True)

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        nodes = part[part["dst"].isna()].sort_values("src")
        names = nodes["src"].tolist()
        at, homes = {name: i for i, name in enumerate(names)}, {c: i for i, c in enumerate(dict.fromkeys(nodes["home"]))}
        of = part[part["dst"].notna()]
        made = [(at[a], at[b], float(w)) for a, b, w in zip(of["src"], of["dst"], of["weight"], strict=True) if a < b]
        loops = nodes["weight"].to_numpy().copy()
        for a, b, w in made:
            loops[a] -= w
            loops[b] -= w
        made += [(i, i, w / 2) for i, w in enumerate(loops.tolist())]  # each counts from both ends
        label = clustering.leiden(made, len(names), float(nodes["rate"].iloc[0] * nodes["weight"].sum()), seed, [homes[c] for c in nodes["home"]])
        first: dict[int, object] = {}
        for name, c in zip(names, label, strict=True):
            first.setdefault(c, name)
        return pd.DataFrame({"run": part["run"].iloc[0], "node": names, "home": [first[c] for c in label]})

    return rows.groupBy("run").applyInPandas(solve, f"run int, node {kind}, home {kind}")


def communities(nodes: DataFrame, edges: DataFrame, resolutions: Sequence[float], seed: int = 0) -> DataFrame:
    """(resolution, node, community) as ``clustering.communities_of``, for graphs of any size.

    Up to ``clustering.MOST_NODES`` nodes it is the same. Larger graphs are contracted level by level
    until what is left has as few, or until nothing is left to merge.
    """
    nodes = nodes.select("node").distinct()
    if nodes.limit(clustering.MOST_NODES + 1).count() <= clustering.MOST_NODES:
        return clustering.communities_of(nodes, edges, resolutions, seed)
    nodes = staged(nodes)
    known = edges.select("src", "dst", F.col("weight").cast("double").alias("weight")).where("src <> dst").join(nodes.select(F.col("node").alias("src")), "src", "left_semi").join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi")
    one = known.groupBy("src", "dst").agg(F.sum("weight").alias("weight")).where("weight > 0")
    both = staged(one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")).groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    degree = both.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("k"))
    total = both.agg(F.sum("weight")).first()[0] or 1.0
    runs = F.explode(F.array(*[F.struct(F.lit(i).alias("run"), F.lit(float(x) / total).alias("rate")) for i, x in enumerate(resolutions)]))
    state = nodes.join(degree, "node", "left").fillna(0.0, ["k"]).select(runs.alias("r"), "node", "k")
    state = staged(state.select("r.run", "node", "k", "r.rate", F.col("node").alias("home")))
    links = staged(both.select(F.explode(F.array(*[F.lit(i) for i in range(len(resolutions))])).alias("run"), "src", "dst", "weight"))
    where, n = state.select("run", F.col("node").alias("name"), "node"), 0
    while True:
        most = state.groupBy("run").count().agg(F.max("count"), F.sum("count")).first()
        if most[1] == n:
            break
        n = most[1]
        if most[0] <= clustering.MOST_NODES:
            state = staged(_solved(links, state, seed))
            break
        state = staged(_refined(links, _moved(links, state)))
        where = staged(where.join(_of(state, "node", "part", "part"), ["run", "node"]).select("run", "name", F.col("part").alias("node")))
        ends = links.join(_of(state, "src", "a", "part"), ["run", "src"]).join(_of(state, "dst", "b", "part"), ["run", "dst"]).where("a <> b")
        links = staged(ends.groupBy("run", F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("weight").alias("weight")))
        state = staged(state.groupBy("run", F.col("part").alias("node")).agg(F.sum("k").alias("k"), F.first("rate").alias("rate"), F.first("home").alias("home")))
    found = staged(where.join(state.select("run", "node", "home"), ["run", "node"]).select("run", F.col("name").alias("node"), "home"))
    first = found.groupBy("run", "home").agg(F.min("node").alias("community"))
    resolution = F.element_at(F.array(*[F.lit(float(x)) for x in resolutions]), F.col("run") + 1)
    return found.join(first, ["run", "home"]).select(resolution.alias("resolution"), "node", "community")
