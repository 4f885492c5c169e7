"""Outcome models, bottlenecks, bags, marginals and rasters against plain computations."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar
from tessera.operators import bags, bottleneck, concepts, folds, images, outcomes, pooling, tables, tiles, vectors
from tessera.sources import storage


def table(spark, x, **columns):
    names = list(columns)
    data = [(i, [float(v) for v in row], *[columns[c][i] for c in names]) for i, row in enumerate(x)]
    kinds = {c: "int" if isinstance(columns[c][0], int) else "double" for c in names}
    return spark.createDataFrame(data, ", ".join(["image_id long", "features array<double>", *[f"{c} {k}" for c, k in kinds.items()]]))


def test_logistic_equals_newton(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(2, 3, (60, 3))
    y = [int(i % 2) for i in range(60)]
    x[1::2, 0] += 2
    model, (mean, std) = outcomes.fit(table(spark, x, y=y), "y", "logreg_l2")
    assert np.allclose(mean, x.mean(0)) and np.allclose(std, x.std(0))
    want = concepts.logistic((x - mean) / std, np.array(y, float))
    assert np.allclose([model.intercept, *model.coefficients], want, atol=1e-4)
    assert [n for n, _, _ in outcomes.coefficients(model, ["a", "b", "c"])] == ["a", "b", "c", "intercept"]


@pytest.mark.parametrize("kind", outcomes.KINDS)
def test_kinds_learn(spark, kind):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (80, 2))
    y = [int(a > 0.3) for a in x[:, 0]]
    df = table(spark, x, y=y)
    model, scale = outcomes.fit(df, "y", kind, trees=10, rounds=5)
    got = {r["image_id"]: r["risk_score"] for r in outcomes.probability(df, model, scale).collect()}
    assert np.mean([(got[i] > 0.5) == bool(y[i]) for i in range(80)]) > 0.85
    assert all(0 <= p <= 1 for p in got.values())


def test_one_class_and_unknown_kind(spark):
    df = table(spark, np.eye(3), y=[1, 1, 1])
    with pytest.raises(ValueError, match="one class"):
        outcomes.fit(df, "y", "logreg_l2")
    with pytest.raises(ValueError, match="kind"):
        outcomes.learner("forest", 1, 1.0, 1, 1, 0)


def test_strength_is_of_the_grid(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (40, 2))
    df = table(spark, x, y=[int(a > 0) for a in x[:, 0]], fold=[i % 2 for i in range(40)])
    assert outcomes.choose_strength(df, "y", [0.01, 1.0]) in (0.01, 1.0)


def test_bottleneck(spark):
    rng = np.random.default_rng(4)
    n = 100
    c, e = rng.normal(1, 2, (n, 4)), rng.normal(0, 1, (n, 3))
    risk = 0.5 + c[:, 0] - 2 * c[:, 2] + 0.3 * e[:, 1]
    data = [(i, c[i].tolist(), e[i].tolist(), float(risk[i]), i % 5) for i in range(n)]
    data.append((n, c[0].tolist(), e[0].tolist(), float("nan"), 0))
    df = spark.createDataFrame(data, "image_id long, c array<double>, e array<double>, risk double, fold int").repartition(3)
    sums = bottleneck.product_sums(df, "c", "risk", "fold")
    z = np.column_stack([np.ones(n), c, risk])
    assert np.allclose(sums[2], z[2::5].T @ z[2::5])
    model = bottleneck.fit(df, "c", "e", "risk")
    assert np.allclose(model.concepts, [0.5, 1, 0, -2, 0], atol=0.15)
    assert abs(model.residual[2] - 0.3) < 0.1 and set(model.held_out) == set(range(5))
    out = bottleneck.predict(df, model, "c", "e").where("image_id < 100").collect()
    assert max(abs(r["risk_score"] - r["risk"]) for r in out) < 0.25
    with pytest.raises(ValueError, match="two rows"):
        bottleneck.fit(df.where("image_id = 100"), "c", "e", "risk")


def test_lasso_and_ridge_are_optimal():
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (50, 4)) * [1, 2, 3, 0]
    y = x[:, 0] + rng.normal(0, 1, 50)
    z = np.column_stack([np.ones(50), x, y])
    g = z.T @ z
    w = bottleneck.lasso(g, np.array([0.2]))[0]
    slope = x.T @ (y - w[0] - x @ w[1:]) / 50
    assert w[4] == 0
    for j in range(4):
        assert abs(slope[j] - 0.2 * np.sign(w[1 + j])) < 1e-6 if w[1 + j] else abs(slope[j]) <= 0.2 + 1e-9
    w = bottleneck.ridge(g, np.array([2.0]))[0]
    assert np.allclose(w, concepts.ridge(x, y, 2.0))
    assert np.isclose(bottleneck.squared_error(g, w), np.mean((y - w[0] - x @ w[1:]) ** 2))


def test_marginals_equal_scores_of_smaller_bags(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (30, 5))
    kinds = [None if i % 7 == 0 else ("a", "b")[i % 2] for i in range(29)] + ["rare"]
    data = [(1, i, x[i].tolist(), kinds[i]) for i in range(30)] + [(2, 0, x[0].tolist(), "a")]
    df = spark.createDataFrame(data, "image_id long, tile_id long, features array<double>, cluster string")
    model = pooling.Pooling.new(5, 2, 4, 0)
    models = spark.createDataFrame([(0, bytearray(model.dump()))], "fold int, model binary")
    got = {(r["image_id"], r["cluster"]): r for r in pooling.marginals(df, models, 0.05).collect()}
    assert set(got) == {(1, "a"), (1, "b")}
    p = lambda rows: 1 / (1 + np.exp(-model.forward(rows)[0]))
    for k in ("a", "b"):
        rest = x[[i for i in range(30) if kinds[i] != k]]
        assert np.isclose(got[1, k]["p_full"], p(x)) and np.isclose(got[1, k]["p_without"], p(rest))
        assert np.isclose(got[1, k]["delta_p"], p(x) - p(rest))


def test_bag_modes(spark):
    own = spark.createDataFrame([(i, t, [float(t)]) for i in (1, 2) for t in range(4)], "image_id long, tile_id long, features array<double>")
    copies = spark.createDataFrame([(1, t, s, [10.0 + t]) for t in range(5) for s in ("x", "y")], "image_id long, tile_id long, source string, features array<double>")
    counts = lambda mode, share: {(r["bag_id"], r["source"]): r["count"] for r in bags.training_bags(own, copies, mode, share).groupBy("bag_id", "source").count().collect()}
    assert counts("replace", 0.0) == counts("augment", 0.0) == {("1", "original"): 4, ("2", "original"): 4}
    whole = counts("replace", 1.0)
    assert whole.get(("1", "x"), 0) + whole.get(("1", "y"), 0) == 4 and whole["2", "original"] == 4
    assert counts("augment", 1.0) == {("1", "original"): 4, ("1", "x"): 4, ("1", "y"): 4, ("2", "original"): 4}
    assert counts("separate", 0.5) == {("1:original", "original"): 4, ("1:x", "x"): 4, ("1:y", "y"): 4, ("2:original", "original"): 4}
    assert bags.training_bags(own.limit(0), copies, "replace", 0.5).count() == 0
    with pytest.raises(ValueError, match="mode"):
        bags.training_bags(own, copies, "swap", 0.5)


def squares(mask, low, high, how):
    h, w = mask.shape
    return np.array([[how(mask[max(i + low, 0) : i + high + 1, max(j + low, 0) : j + high + 1]) for j in range(w)] for i in range(h)])


def test_raster_filters(spark):
    rng = np.random.default_rng(7)
    mask = rng.random((12, 12)) < 0.7
    pixels = spark.createDataFrame([(1, i, j, bool(mask[i, j])) for i in range(12) for j in range(12)], "image_id long, row int, col int, m boolean")

    def back(df):
        out = np.zeros((12, 12), bool)
        for r in df.collect():
            out[r["row"], r["col"]] = r["m"]
        return out

    assert (back(images.eroded(pixels, ["m"], 4)) == squares(mask, -2, 1, np.all)).all()
    assert (back(images.dilated(pixels, ["m"], 3)) == squares(mask, -1, 1, np.any)).all()
    edged = np.pad(mask, 2, mode="symmetric")
    want = np.array([[edged[i : i + 5, j : j + 5].sum() > 12 for j in range(12)] for i in range(12)])
    assert (back(images.median_flags(pixels, ["m"], 5, 12)) == want).all()


def test_small_cohorts_have_no_inner_split(spark):
    few = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "image_id long, y int")
    assert {r["split"] for r in folds.inner_split(few, "y", 0.5).collect()} == {"train"}
    odd = spark.createDataFrame([(i, int(i == 0)) for i in range(10)], "image_id long, y int")
    assert folds.inner_split(odd, "y", 0.3).where("split = 'val'").count() == 3
    assert folds.inner_split(odd, "y", 0.0).where("split = 'val'").count() == 0
    assert folds.fold_values(None) == folds.fold_values(1) == [None] and folds.fold_values(2) == [0, 1]


def test_folds_are_even(spark):
    rows = spark.range(1000).select(F.col("id").alias("image_id"), (F.col("id") % 3).alias("k"))
    got = folds.stratified_folds(rows, 4, ["k"]).join(rows, "image_id").groupBy("k", "fold").count().collect()
    assert len(got) == 12 and {r["count"] for r in got} <= {83, 84}
    plain = {r["fold"]: r["count"] for r in folds.stratified_folds(rows, 3).groupBy("fold").count().collect()}
    assert plain == {0: 334, 1: 333, 2: 333}


def test_paths(spark):
    one = spark.range(1)
    with pytest.raises(KeyError):
        scalar.template_path("a/{b}/c", {})
    path = scalar.template_path("a/{b}/f={f}/c.txt", {"b": F.lit("x"), "f": F.lit(None).cast("int")}, ["f"])
    assert one.select(path).first()[0] == "a/x/c.txt"
    with pytest.raises(Exception, match="no value"):
        one.select(scalar.template_path("a/{b}/c", {"b": F.lit(None).cast("string")})).collect()
    assert one.select(scalar.hive_parse(F.lit("a/k=v=w/n=1/f.bin"))).first()[0] == {"k": "v=w", "n": "1"}
    assert one.select(scalar.run_id(F.lit("2024-05-06 07:08:09").cast("timestamp"))).first()[0] == "20240506T070809Z"


def test_two_slides_of_one_id(spark):
    images_ = spark.createDataFrame([("a",), ("b",)], "image_id string")
    slides = spark.createDataFrame([("a", "/x/a.svs"), ("a", "/y/a.svs")], "image_id string, wsi_path string")
    assert {r["wsi_path"] for r in storage.dataset_table(images_, slides.limit(1)).collect()} == {"/x/a.svs", ""}
    with pytest.raises(Exception, match="several slides"):
        storage.dataset_table(images_, slides).collect()


def test_vectors_and_labels(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0, 2.0]), (3, None)], "image_id long, features array<double>")
    got = {r["image_id"]: r["u"] for r in df.select("image_id", vectors.block_unit("features", [2, 2]).alias("u")).collect()}
    assert got[1] == [0.6, 0.8, 0.0, 0.0] and got[2] == [0.0, 0.0, 0.0, 1.0]
    assert {(r["image_id"], r["problem"]) for r in vectors.problems(df, 4).collect()} == {(3, "empty")}
    labels = spark.createDataFrame([(0,), (1,), (3,), (None,)], "y int")
    assert [tuple(r) for r in tables.label_violations(labels, "y").collect()] == [(3, 1)]
    assert tiles.resolution(spark.createDataFrame([(1, None)], "image_id long, image_mpp double"), spark.createDataFrame([], "image_id long, image_mpp double")).first()["mpp_from"] is None
