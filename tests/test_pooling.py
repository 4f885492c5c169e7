"""Training, early stop and attribution of attention pooling against one process."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import folds, pooling


def cohort(spark, n=14, seed=1):
    rng = np.random.default_rng(seed)
    bags = {f"S-{i:02d}": (i % 2, rng.normal(2 * (i % 2), 1, (int(rng.integers(1, 7)), 4))) for i in range(n)}
    rows = [(i, t, x.tolist()) for i, (_, own) in bags.items() for t, x in enumerate(own)] + [("S-99", 0, None)]
    tiles = spark.createDataFrame(rows, "image_id string, tile_id long, features array<double>").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, (y, _) in bags.items()] + [("S-99", 1), ("S-98", 0)], "image_id string, y int")
    flat = spark.createDataFrame([(i, k // 2 % 2) for k, i in enumerate(bags)], "image_id string, fold int")
    return bags, tiles, labels, folds.expand_flat(flat, 2)


def plain_train(bags, ids, epochs, rate):
    """Adam on the mean gradient, a bag after another."""
    adam = pooling.Adam(pooling.Pooling.new(4, 2, 3, 0), rate)
    n = {y: sum(bags[i][0] == y for i in ids) for y in (0, 1)}
    for _ in range(epochs):
        grads = [adam.model.gradients(bags[i][1], bags[i][0], len(ids) / (2 * n[bags[i][0]]))[1] for i in ids]
        adam.move({k: sum(g[k] for g in grads) / len(ids) for k in grads[0]})
    return adam.model


def test_training_equals_one_process(spark, monkeypatch):
    monkeypatch.setattr(pooling, "CHUNK", 7)
    bags, tiles, labels, splits = cohort(spark)
    models = pooling.train(tiles, labels, splits, "y", hidden=3, epochs=3).collect()
    for r in models:
        ids = [s["image_id"] for s in splits.where(f"fold = {r['fold']} and split = 'train'").collect()]
        got, want = pooling.Pooling.load(bytes(r["model"])), plain_train(bags, ids, 3, 0.05)
        for name in pooling.PARAMETERS:
            assert np.allclose(getattr(got, name), getattr(want, name), atol=1e-9), name
        assert r["epoch"] == 3 and r["auprc"] is None
    monkeypatch.setattr(pooling, "MOST_BAGS", 0)
    again = pooling.train(tiles, labels, splits, "y", hidden=3, epochs=3).where("fold = 0").first()
    assert np.allclose(pooling.Pooling.load(bytes(again["model"])).v, pooling.Pooling.load(bytes(models[0]["model"])).v)


def plain_precision(y, z):
    out = 0.0
    for t in sorted(set(z), reverse=True):
        hit = [a for a, b in zip(y, z) if b >= t]
        out += sum(a for a, b in zip(y, z) if b == t) * sum(hit) / len(hit)
    return out / sum(y)


def test_early_stop_keeps_the_best_epoch(spark):
    bags, tiles, labels, splits = cohort(spark, 16, 5)
    noisy = labels.withColumn("y", F.when(F.col("image_id").isin("S-00", "S-05"), 1 - F.col("y")).otherwise(F.col("y")))
    val = {"S-00", "S-03", "S-05", "S-10"}
    split = F.when(F.col("image_id").isin(*val), "val").otherwise("train")
    one = splits.where("fold = 0").select("image_id", "fold", split.alias("split"))
    r = pooling.train(tiles, noisy, one, "y", hidden=3, epochs=6, patience=2).first()
    flipped = {i: (1 - y if i in ("S-00", "S-05") else y, x) for i, (y, x) in bags.items()}
    ids = [i for i in bags if i not in val]
    best, since = (-1.0, 0), 0
    for epoch in range(1, 7):
        model = plain_train(flipped, ids, epoch, 0.05)
        auprc = plain_precision([flipped[i][0] for i in sorted(val)], [model.forward(flipped[i][1])[0] for i in sorted(val)])
        best, since = ((auprc, epoch), 0) if auprc > best[0] + 1e-12 else (best, since + 1)
        if since == 2:
            break
    assert (r["epoch"], round(r["auprc"], 9)) == (best[1], round(best[0], 9))
    assert np.allclose(pooling.Pooling.load(bytes(r["model"])).c, plain_train(flipped, ids, best[1], 0.05).c, atol=1e-9)


def test_attributions_equal_finite_differences(spark):
    bags, tiles, _, _ = cohort(spark)
    model = pooling.Pooling.new(4, 2, 3, 7)
    models = spark.createDataFrame([(0, bytearray(model.dump()))], "fold int, model binary")
    got = {(r["image_id"], r["tile_id"]): r for r in pooling.attributions(tiles, models).collect()}
    assert len(got) == sum(len(x) for _, x in bags.values())
    length = np.linalg.norm(model.c.reshape(2, -1), axis=1)
    for i, (_, x) in bags.items():
        _, a, _ = model.forward(x)
        for t in range(len(x)):
            ends = []
            for step in (1e-6, -1e-6):
                moved = x.copy()
                moved[t] *= 1 + step
                ends.append(model.forward(moved)[0])
            assert abs((ends[0] - ends[1]) / 2e-6 - got[i, t]["gradient"]) < 1e-6
            assert np.isclose(got[i, t]["attention"], a[t] @ (length / (length.sum() + 1e-8)))


def test_large_logits_and_a_cluster_with_nearly_all_attention(spark):
    """Logits far beyond what exp holds, and a rest that subtraction would lose."""
    model = pooling.Pooling.new(2, 1, 1, 0)
    model.v[...], model.u[...], model.w[...], model.c[...] = 5, 5, 2000, [1, -0.5]
    x = np.array([[1.0, 1.0], [0.01, 0.02], [0.02, 0.01], [0.015, 0.01]])
    tiles = spark.createDataFrame([(1, i, v.tolist(), "ab"[i > 0]) for i, v in enumerate(x)], "image_id int, tile_id int, features array<double>, cluster string")
    models = spark.createDataFrame([(0, bytearray(model.dump()))], "fold int, model binary")
    p = lambda rows: 1 / (1 + np.exp(-model.forward(rows)[0]))
    assert np.isclose(pooling.score(tiles, models).first()["risk_score"], p(x))
    got = {r["cluster"]: r["p_without"] for r in pooling.marginals(tiles, models).collect()}
    assert np.isclose(got["a"], p(x[1:]), atol=1e-12) and np.isclose(got["b"], p(x[:1]))


def test_labels_and_empty_cohorts(spark):
    _, tiles, labels, splits = cohort(spark)
    with pytest.raises(ValueError, match="0 or 1"):
        pooling.train(tiles, labels.withColumn("y", F.col("y") + 1), splits, "y")
    with pytest.raises(ValueError, match="no train image"):
        pooling.train(tiles.limit(0), labels, splits, "y")
