"""Morphology by fold: what is fitted on train images, and what each output is reduced to."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import folds, morphology, stats, vectors


def cohort(spark):
    """Images of class 1 have more tiles of one kind than those of class 0."""
    rng = np.random.default_rng(1)
    kinds = np.eye(5)[:3] * 4
    rows = []
    for i in range(24):
        for t in range(12):
            kind = 0 if rng.random() < (0.7 if i % 2 else 0.15) else int(rng.integers(1, 3))
            rows.append((f"S-{i:02d}", t, (kinds[kind] + rng.normal(0, 0.3, 5)).tolist(), float(rng.uniform(0.1, 1)), kind))
    tiles = spark.createDataFrame(rows, "image_id string, tile_id long, features array<double>, attention double, kind int")
    labels = spark.createDataFrame([(f"S-{i:02d}", i % 2) for i in range(24)], "image_id string, recurred int")
    flat = spark.createDataFrame([(f"S-{i:02d}", i // 2 % 2) for i in range(24)], "image_id string, fold int")
    return tiles, labels, folds.expand_flat(flat, 2)


def test_inference(spark):
    tiles, labels, splits = cohort(spark)
    clusters, presence, risks = morphology.infer(tiles, labels, splits, 2, "recurred", k=12, neighbours=2, n_parts=3, resolution=2.0)
    test = {r["image_id"]: r["fold"] for r in splits.where("split = 'test'").collect()}
    got = clusters.join(tiles.select("image_id", "tile_id", "kind"), ["image_id", "tile_id"]).collect()
    assert len(got) == 24 * 12 and all(r["fold"] == test[r["image_id"]] for r in got)
    for fold in (0, 1):  # a cluster holds tiles of one kind
        own = {}
        for r in got:
            if r["fold"] == fold:
                own.setdefault(r["cluster"], []).append(r["kind"])
        assert sum(max(np.bincount(k)) for k in own.values()) > 0.95 * sum(map(len, own.values()))
    shares = presence.groupBy("image_id", "fold").agg(F.sum("weighted_presence").alias("s")).collect()
    assert len(shares) == 24 and all(r["fold"] == test[r["image_id"]] and np.isclose(r["s"], 1) for r in shares)
    scored = risks.join(labels, "image_id")
    assert {r["image_id"]: r["fold"] for r in risks.collect()} == test
    assert stats.auroc(scored, "risk_score", "recurred").first()["auroc"] > 0.9


def test_too_many_centroids(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST_CENTRES", 1)
    centres = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "cluster int, centroid array<double>")
    with pytest.raises(ValueError, match="more than 1"):
        vectors.knn_edges(centres, 1)
