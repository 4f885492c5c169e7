"""Bootstrapped probes in passes over all rows, against one model after another."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tessera.operators import concepts, stats


def times(image, replica, seed=0):
    digest = hashlib.md5(f"{image}:{replica // 4}:{seed}".encode()).hexdigest()
    return sum(int(digest[8 * (replica % 4) :][:8], 16) >= math.ceil(e * (1 << 32)) for e in stats.POISSON)


@pytest.mark.parametrize("numbers", [1 << 22, 40])
def test_probes_equal_fits_of_repeated_rows(spark, monkeypatch, numbers):
    monkeypatch.setattr(concepts, "MOST_NUMBERS", numbers)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 3))
    ids = [f"S-{i:02d}" for i in range(40)]
    a = [None if i % 9 == 0 else float(x[i, 0] + rng.normal()) for i in range(40)]
    b = [None if i % 7 == 0 else "yes" if x[i, 1] + rng.normal() > 0 else "no" for i in range(40)]
    rare = [1 if i == 5 else 0 for i in range(40)]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)] + [("S-98", None)], "image_id string, embedding array<double>").repartition(3)
    labels = spark.createDataFrame([*zip(ids, a, b, rare), ("S-98", 1.0, "no", 0), ("S-99", 2.0, "yes", 1)], "image_id string, path_a double, path_b string, path_c int")
    replicas = 6 if numbers > 100 else 3
    models = concepts.fit(vectors, labels, ["path_a", "path_b", "path_c"], replicas=replicas).collect()
    assert len(models) == 3 * replicas
    for r in models:
        y = {"path_a": a, "path_b": [None if v is None else float(v == "yes") for v in b], "path_c": [float(v) for v in rare]}[r["concept"]]
        pick = [i for i in range(40) if y[i] is not None for _ in range(times(ids[i], r["replica"]))]
        if r["kind"] == "logistic" and len({y[i] for i in pick}) < 2:
            pick = [i for i in range(40) if y[i] is not None]
        own = concepts.ridge if r["kind"] == "ridge" else concepts.logistic
        assert np.allclose(r["weights"], own(x[pick], np.array([y[i] for i in pick])), atol=1e-6), (r["concept"], r["replica"])
    got = {(r["image_id"], r["concept"]): (r["value"], r["std"]) for r in concepts.predict(vectors, spark.createDataFrame(models)).collect()}
    assert len(got) == 120
    w = np.array([r["weights"] for r in models if r["concept"] == "path_b"])
    p = 1 / (1 + np.exp(-(x @ w[:, 1:].T + w[:, 0])))
    assert np.allclose([got[i, "path_b"] for i in ids], np.column_stack([p.mean(1), p.std(1)]))


def test_probes_of_nothing(spark):
    vectors = spark.createDataFrame([], "image_id long, embedding array<double>")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "image_id long, path_a int")
    assert concepts.fit(vectors, labels, ["path_a"]).count() == 0 and concepts.fit(vectors, labels.limit(1), ["path_a"]).count() == 0
    assert concepts.predict(vectors, concepts.fit(vectors, labels, ["path_a"])).count() == 0


def test_tasks_without_rows(spark, monkeypatch):
    """As on large tables, where few images leave most tasks of a pass empty."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(5, 2))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "image_id long, embedding array<double>")
    labels = spark.createDataFrame([(i, float(i), i % 2) for i in range(5)], "image_id long, path_a double, path_b int")
    want = {(r["concept"], r["replica"]): r["weights"] for r in concepts.fit(vectors, labels, ["path_a", "path_b"], replicas=2).collect()}
    staged = concepts.staged
    monkeypatch.setattr(concepts, "staged", lambda df: staged(df).repartition(16))
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {(r["concept"], r["replica"]): r["weights"] for r in concepts.fit(vectors, labels, ["path_a", "path_b"], replicas=2).collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
