"""Clustering of tile embeddings."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import stats, vectors
from tessera.sources.storage import staged

EPS = 1e-12
#: Nodes of a graph of centroids at most.
MOST_NODES = 50_000


def sampled(tiles: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` tiles, the same ones for the same seed: those of the smallest hashes."""
    return tiles.orderBy(F.xxhash64("image_id", "tile_id", F.lit(seed))).limit(n)


def pca_fit(tiles: DataFrame, k: int, sample: int = 200_000, seed: int = 0, column: str = "features") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, components (k, d) and explained variance of L2-normalised tiles of a bounded sample."""
    rows = vectors.l2_normalised(sampled(tiles, sample, seed), column).select(array_to_vector(column).alias("v"))
    n, mean = rows.select(F.count(F.lit(1)), Summarizer.mean(F.col("v"))).first()
    k = min(k, n, len(mean))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(rows)
    return mean.toArray(), model.pc.toArray().T, model.explainedVariance.toArray()


def pca_project(tiles: DataFrame, mean: np.ndarray, parts: np.ndarray, column: str = "features") -> DataFrame:
    """L2-normalise, centre, project, and L2-normalise again, a batch of rows at a time."""

    @F.pandas_udf("array<double>")
    def project(rows: pd.Series) -> pd.Series:
        x = np.stack(rows.to_numpy()).astype(float) if len(rows) else np.empty((0, mean.size))
        x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), EPS) - mean) @ parts.T
        return pd.Series(list(x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), EPS)))

    return tiles.withColumn(column, project(column))


def spherical_kmeans(tiles: DataFrame, k: int, iterations: int = 25, seed: int = 0, column: str = "features") -> DataFrame:
    """(cluster, centroid): unit centroids of k-means by cosine."""
    rows = tiles.where(vectors.norm(column) > EPS).select(array_to_vector(F.col(column).cast("array<double>")).alias("v"))
    model = KMeans(k=k, maxIter=iterations, seed=seed, distanceMeasure="cosine", featuresCol="v").fit(rows)
    centres = [(i, [float(x) for x in c / max(np.linalg.norm(c), EPS)]) for i, c in enumerate(model.clusterCenters())]
    return tiles.sparkSession.createDataFrame(centres, "cluster int, centroid array<double>")


def _moved(near: list[dict[int, float]], degree: list[float], total: float, home: list[int], resolution: float, rng: np.random.Generator) -> list[int]:
    """Nodes moved to the neighbouring community of the greatest gain, until none moves."""
    home = list(home)
    weight = [0.0] * (max(home) + 1)
    for i, c in enumerate(home):
        weight[c] += degree[i]
    waiting = rng.permutation(len(near)).tolist()
    queued = [True] * len(near)
    at = 0
    while at < len(waiting):
        i = waiting[at]
        at += 1
        queued[i] = False
        links: dict[int, float] = {}
        for j, w in near[i].items():
            if j != i:
                links[home[j]] = links.get(home[j], 0.0) + w
        old = home[i]
        weight[old] -= degree[i]
        best, most = old, links.get(old, 0.0) - resolution * degree[i] * weight[old] / total
        for c in sorted(links):
            if (gain := links[c] - resolution * degree[i] * weight[c] / total) > most + 1e-12:
                best, most = c, gain
        home[i] = best
        weight[best] += degree[i]
        if best != old:
            for j in near[i]:
                if home[j] != best and not queued[j]:
                    queued[j] = True
                    waiting.append(j)
    return home


def _refined(near: list[dict[int, float]], degree: list[float], total: float, home: list[int], resolution: float, rng: np.random.Generator) -> list[int]:
    """Parts of each community: nodes that are well connected to the rest of it join the part of the
    greatest gain that is well connected too. So no part falls apart into pieces without a link."""
    n = len(near)
    part, alone = list(range(n)), [True] * n
    whole = [0.0] * (max(home) + 1)
    for i, c in enumerate(home):
        whole[c] += degree[i]
    cut = [sum(w for j, w in near[i].items() if j != i and home[j] == home[i]) for i in range(n)]
    own, weight = list(cut), list(degree)
    well = lambda k, edge, c: edge >= resolution * k * (whole[c] - k) / total - 1e-12
    for i in rng.permutation(n).tolist():
        c = home[i]
        if not alone[i] or not well(degree[i], own[i], c):
            continue
        links: dict[int, float] = {}
        for j, w in near[i].items():
            if j != i and home[j] == c:
                links[part[j]] = links.get(part[j], 0.0) + w
        best, most = i, 0.0
        for p in sorted(links):
            if p != i and well(weight[p], cut[p], c) and (gain := links[p] - resolution * degree[i] * weight[p] / total) > most + 1e-12:
                best, most = p, gain
        if best != i:
            part[i] = best
            alone[i] = alone[best] = False
            weight[best] += degree[i]
            cut[best] += own[i] - 2 * links[best]
    return part


def leiden(edges: list[tuple[int, int, float]], n: int, resolution: float = 1.0, seed: int = 0, home: list[int] | None = None) -> list[int]:
    """Communities of a weighted graph: moves, refinement of what they give, and the graph of the
    refined parts again, until nothing is left to merge. Numbered by first member. Nodes start
    alone, or in the communities ``home``, numbered from 0."""
    rng = np.random.default_rng(seed)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    where, home = list(range(n)), list(range(n)) if home is None else home
    while True:
        degree = [sum(x.values()) for x in near]
        total = sum(degree) or 1.0
        home = _moved(near, degree, total, home, resolution, rng)
        part = _refined(near, degree, total, home, resolution, rng)
        ids = {p: k for k, p in enumerate(dict.fromkeys(part))}
        label = [home[x] for x in where]
        if len(ids) == len(near):
            names = {c: k for k, c in enumerate(dict.fromkeys(label))}
            return [names[c] for c in label]
        merged: list[dict[int, float]] = [{} for _ in ids]
        for i, row in enumerate(near):
            a = ids[part[i]]
            for j, w in row.items():
                b = ids[part[j]]
                merged[a][b] = merged[a].get(b, 0.0) + w
        of = {ids[part[i]]: home[i] for i in range(len(near))}
        names = {c: k for k, c in enumerate(dict.fromkeys(of[k] for k in range(len(ids))))}
        where, home, near = [ids[part[x]] for x in where], [names[of[k]] for k in range(len(ids))], merged


def communities_of(nodes: DataFrame, edges: DataFrame, resolutions: Sequence[float], seed: int = 0) -> DataFrame:
    """(resolution, node, community) for ``nodes`` (node) and ``edges`` (src, dst, weight), all
    resolutions in one run, a task each; communities bear the name of their first node.

    The graph is a model's, of centroids: more than ``MOST_NODES`` nodes are an error. Null weights
    count as 0, links of a node with itself and with unknown nodes not at all; a link given in both
    directions counts twice.
    """
    nodes = nodes.select("node").distinct()
    n = nodes.limit(MOST_NODES + 1).count()
    if n > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes")
    kind = nodes.schema["node"].dataType.simpleString()
    own = nodes.select(F.col("node").alias("src"), F.lit(None).cast(kind).alias("dst"), F.lit(0.0).alias("weight"))
    known = edges.select("src", "dst", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")).where("src <> dst").join(nodes.select(F.col("node").alias("src")), "src", "left_semi").join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst", "weight")
    rows = own.unionByName(known).withColumn("resolution", F.explode(F.array(*[F.lit(float(x)) for x in resolutions])))

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        names = sorted(part["src"].unique().tolist())
        at = {name: i for i, name in enumerate(names)}
        links = part[part["dst"].notna()].groupby(["src", "dst"], sort=True)["weight"].sum()
        made = [(at[a], at[b], float(w)) for (a, b), w in links.items() if w > 0]
        label = leiden(made, len(names), float(part["resolution"].iloc[0]), seed)
        first: dict[int, object] = {}
        for name, c in zip(names, label, strict=True):
            first.setdefault(c, name)
        return pd.DataFrame({"resolution": part["resolution"].iloc[0], "node": names, "community": [first[c] for c in label]})

    return rows.groupBy("resolution").applyInPandas(solve, f"resolution double, node {kind}, community {kind}")


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(resolution, n_communities, modularity) of ``labels`` (resolution, node, community)."""
    both = edges.where("src <> dst").select("src", "dst", "weight").unionByName(edges.where("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    of = lambda c, name: labels.select("resolution", F.col("node").alias(c), F.col("community").alias(name))
    inner = both.join(of("src", "a"), "src").join(of("dst", "b"), ["resolution", "dst"])
    per = inner.groupBy("resolution", "a").agg(F.sum("weight").alias("k"), F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0.0)).alias("inside"))
    sums = per.groupBy("resolution").agg(F.sum("inside").alias("inside"), F.sum(F.col("k") * F.col("k")).alias("squares"), F.sum("k").alias("total"))
    counts = labels.groupBy("resolution").agg(F.count_distinct("community").alias("n_communities"))
    value = F.col("inside") / F.col("total") - F.col("resolution") * F.col("squares") / (F.col("total") * F.col("total"))
    return counts.join(sums, "resolution", "left").select("resolution", "n_communities", F.coalesce(value, F.lit(0.0)).alias("modularity"))


def morphology_multi(tiles: DataFrame, k: int, neighbours: int, resolutions: Sequence[float], n_parts: int = 16, seed: int = 0) -> DataFrame:
    """Tiles with ``micro_cluster`` and, once for each resolution, ``resolution`` and ``cluster``: projection,
    k-means, graph of centroids and look-up are done once."""
    mean, parts, _ = pca_fit(tiles, n_parts, seed=seed)
    rows = staged(pca_project(tiles, mean, parts))
    micro = staged(spherical_kmeans(rows, k, seed=seed))
    label = communities_of(micro.select(F.col("cluster").alias("node")), vectors.knn_edges(micro, neighbours), resolutions, seed)
    names = staged(label.select("resolution", F.col("node").alias("micro_cluster"), F.col("community").alias("cluster")))
    near = vectors.nearest_centroid(rows.drop("cluster"), micro).withColumnRenamed("cluster", "micro_cluster")
    return near.join(F.broadcast(names), "micro_cluster")  # k rows for each resolution


def morphology(tiles: DataFrame, k: int, neighbours: int, resolution: float, n_parts: int = 16, seed: int = 0) -> DataFrame:
    """Tiles with ``micro_cluster`` and ``cluster`` at one resolution."""
    return morphology_multi(tiles, k, neighbours, [resolution], n_parts, seed).drop("resolution")


def stability(tiles: DataFrame, k: int, neighbours: int, resolution: float, seeds: Sequence[int] = (0, 1, 2, 3, 4), n_parts: int = 16, sample: int = 100_000) -> DataFrame:
    """(run_a, run_b, n_rows, ari, ami) of the clusters of each two seeds, on at most ``sample`` tiles,
    the same for all; each run clusters all tiles."""
    items = staged(sampled(tiles.select("image_id", "tile_id"), sample))
    runs = []
    for seed in seeds:
        found = morphology(tiles, k, neighbours, resolution, n_parts, seed).join(items, ["image_id", "tile_id"], "left_semi")
        runs.append(found.select(F.struct("image_id", "tile_id").alias("tile"), F.lit(seed).alias("run"), "cluster"))
    return stats.agreement(staged(functools.reduce(DataFrame.unionByName, runs)), "tile")
