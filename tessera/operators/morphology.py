"""Morphology of a cohort: clusters of tiles, their presence in images, and risk from it, by fold.

Everything is fitted on a fold's train images and applied to all: projection, centroids, communities,
significant clusters, and the risk model. Clusters of two folds have nothing to do with each other,
so tiles and presence are given by the fold that held the image out; risks are out-of-fold scores.
A fold is a few jobs, and folds are a loop over settings.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import attention, clustering, folds, outcomes, stats, vectors
from tessera.sources.storage import staged


@dataclass
class Morphology:
    mean: np.ndarray
    parts: np.ndarray
    micro: DataFrame  # (cluster, centroid)
    communities: DataFrame  # (micro_cluster, cluster)
    centroids: DataFrame  # (cluster, centroid)
    used: list[int]  # the clusters of the risk model, in order
    model: Model
    scale: tuple[np.ndarray, np.ndarray] | None

    def clusters(self, tiles: DataFrame) -> DataFrame:
        """Tiles, projected, with their cluster."""
        rows = clustering.pca_project(tiles, self.mean, self.parts)
        near = vectors.nearest_centroid(rows.drop("cluster"), self.micro, "cluster").withColumnRenamed("cluster", "micro_cluster")
        return near.join(F.broadcast(self.communities), "micro_cluster")  # k rows

    def presence(self, clustered: DataFrame, cutoff: float) -> DataFrame:
        """(image_id, cluster, weighted_presence, ...) over the tiles that bear the attention's mass."""
        return attention.presence(vectors.cosine_weights(attention.mass_filter(clustered, cutoff), self.centroids), "cos_weight")

    def risk(self, presence: DataFrame, images: DataFrame) -> DataFrame:
        """(image_id, risk_score) of ``images`` (image_id); one half where no cluster has a say."""
        if not self.used:
            return images.select("image_id", F.lit(0.5).alias("risk_score"))
        return outcomes.probability(images.join(features(presence, self.used), "image_id", "left").select("image_id", F.coalesce("features", F.array_repeat(F.lit(0.0), len(self.used))).alias("features")), self.model, self.scale).select("image_id", "risk_score")


def features(presence: DataFrame, clusters: list[int]) -> DataFrame:
    """(image_id, features): presence of each of a model's clusters, 0 where an image lacks it."""
    each = [F.coalesce(F.sum(F.when(F.col("cluster") == c, F.col("weighted_presence"))), F.lit(0.0)) for c in clusters]
    return presence.groupBy("image_id").agg(F.array(*each).alias("features"))


def _filled(presence: DataFrame, known: DataFrame) -> DataFrame:
    """A row for each labelled image and cluster of the model, 0 where the image lacks the cluster."""
    names = sorted(r["cluster"] for r in presence.select("cluster").distinct().collect())  # a model's clusters
    wide = known.join(features(presence, names), "image_id")
    return wide.select(*known.columns, F.explode(F.arrays_zip(F.lit(names).alias("cluster"), F.col("features").alias("p"))).alias("z")).select(*known.columns, "z.cluster", F.col("z.p").alias("weighted_presence"))


def fit(tiles: DataFrame, labels: DataFrame, label: str, k: int = 3_000, neighbours: int = 20, resolution: float = 1.0, n_parts: int = 16, cutoff: float = 0.9, alpha: float = 0.05, kind: str = "logreg_l2", seed: int = 0) -> Morphology:
    """Fit on ``tiles`` (image_id, tile_id, features, attention) of the train images.

    Clusters whose presence differs between the classes make up the risk model; all where none does.
    """
    kept = staged(attention.mass_filter(tiles, cutoff))
    mean, parts, _ = clustering.pca_fit(kept, n_parts, seed=seed)
    rows = staged(clustering.pca_project(kept, mean, parts))
    micro = staged(clustering.spherical_kmeans(rows, k, seed=seed))
    found = clustering.communities_of(micro.select(F.col("cluster").alias("node")), vectors.knn_edges(micro, neighbours), [resolution], seed)
    names = staged(found.select(F.col("node").alias("micro_cluster"), F.col("community").alias("cluster")))
    near = vectors.nearest_centroid(rows.drop("cluster"), micro, "cluster").withColumnRenamed("cluster", "micro_cluster")
    clustered = staged(near.join(F.broadcast(names), "micro_cluster"))
    centroids = staged(vectors.centroids(clustered))
    presence = staged(attention.presence(vectors.cosine_weights(clustered, centroids), "cos_weight"))
    known = labels.where(F.col(label).isNotNull()).select("image_id", label)
    tests = stats.with_p_values(stats.mann_whitney(_filled(presence, known), "weighted_presence", label, ["cluster"]))
    used = sorted(r["cluster"] for r in stats.significant(stats.benjamini_hochberg(tests), alpha).collect())
    model, scale = outcomes.fit(features(presence, used).join(known, "image_id"), label, kind, seed=seed)
    return Morphology(mean, parts, micro, names, centroids, used, model, scale)


def infer(tiles: DataFrame, labels: DataFrame, splits: DataFrame, n_folds: int, label: str, cutoff: float = 0.9, **settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tiles with clusters (image_id, tile_id, fold, cluster), presence (image_id, fold, cluster, ...) and
    risks (image_id, risk_score, fold), each by the fold that held the image out."""
    tiles = staged(tiles.select("image_id", "tile_id", "features", "attention"))
    images = tiles.select("image_id").distinct()
    clusters, presences, risks = [], [], []
    for fold in range(n_folds):
        own = folds.ids_of(splits, fold, "train")
        model = fit(tiles.join(own, "image_id", "left_semi"), labels.join(own, "image_id", "left_semi"), label, cutoff=cutoff, **settings)
        found = staged(model.clusters(tiles).withColumn("fold", F.lit(fold)))
        presence = staged(model.presence(found, cutoff).withColumn("fold", F.lit(fold)))
        clusters.append(found.select("image_id", "tile_id", "fold", "cluster"))
        presences.append(presence)
        risks.append(model.risk(presence, images).withColumn("fold", F.lit(fold)))
    union = functools.partial(functools.reduce, DataFrame.unionByName)
    return folds.canonical_rows(union(clusters), splits), folds.canonical_rows(union(presences), splits), folds.out_of_fold(union(risks), splits)
