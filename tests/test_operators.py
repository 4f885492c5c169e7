"""Known cases of single operators."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar
from tessera.jobs import catalog
from tessera.operators import attention, cellular, concepts, filters, folds, pooling, stats, tables, tiles, vectors
from tessera.sources import dictionary, storage
from tessera.streaming import cells as streams


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def attended(spark, values):
    return spark.createDataFrame([(1, i, a) for i, a in enumerate(values)], "image_id long, tile_id long, attention double")


@pytest.mark.parametrize("values,cutoff,kept", [([0.4, 0.3, 0.2, 0.1], 0.6, [0, 1]), ([0.0] * 5, 0.8, [0, 1, 2, 3, 4]), ([0.5], 0.8, [0])])
def test_mass_filter(spark, values, cutoff, kept):
    assert sorted(r["tile_id"] for r in attention.mass_filter(attended(spark, values), cutoff).collect()) == kept


@pytest.mark.parametrize("values,kept", [([0.93, 0.81, 0.38, 0.24, 0.16, 0.13], 3), ([0.84, 0.69, 0.6, 0.55, 0.53, 0.14], 4), ([1e30, 1e30], 2), ([1 / 3, 1 / 7, None], 2)])
def test_mass_that_is_the_cutoff_itself_is_enough(spark, values, kept):
    assert attention.mass_filter(attended(spark, values), 0.8).count() == kept


def test_massless_images_as_sql_has_them(spark, tmp_path):
    rows_ = [(1, 7, "view", 0.0), (2, 7, "view", 0.0), (3, 8, "view", 0.0), (4, 8, "click", 2.5)]
    spark.createDataFrame(rows_, "event_id long, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    duckdb.sql(f"create or replace view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = duckdb.sql(catalog.oracle_sql()["attention_mass_filter"]).fetchall()
    assert rows(catalog.queries()["attention_mass_filter"](spark, str(tmp_path)), "image_id", "tile_id", "attention", "cluster") == sorted(want, key=str) == [(8, 1, 2.5, "click")]


def test_out_of_fold_and_ensemble(spark):
    scores = spark.createDataFrame([("A", 0, 0.1), ("A", 1, 0.9), ("B", 0, 0.2), ("B", 1, 0.8)], "image_id string, fold int, risk_score double")
    splits = folds.expand_flat(spark.createDataFrame([("A", 1), ("B", 0), ("C", 0), ("D", None)], "image_id string, fold int"), 2)
    assert rows(folds.out_of_fold(scores, splits), "image_id", "risk_score", "fold") == [("A", 0.9, 1), ("B", 0.2, 0), ("C", None, 0)]
    assert rows(folds.out_of_fold(scores, splits, "inner"), "image_id", "risk_score", "fold") == [("A", 0.9, 1), ("B", 0.2, 0)]
    assert rows(folds.ensemble(scores), "image_id", "risk_score", "fold") == [("A", 0.5, None), ("B", 0.5, None)]
    assert rows(folds.ids_of(splits, 0, "train"), "image_id") == [("A",)]


@pytest.mark.parametrize("mpp,width,n", [(0.5, 8, 2), (1.0, 4, 15), (2.0, 2, 77)])
def test_tile_grid(spark, mpp, width, n):
    image = spark.createDataFrame([(1, 12, 8, mpp), (2, 12, 8, None), (3, 12, 8, math.nan), (4, 12, 8, -1.0), (5, 3, 1, 0.5)], "image_id long, image_width long, image_height long, image_mpp double")
    grid = tiles.tile_grid(image, 0.004, 0.5)
    got = grid.collect()
    assert len(got) == n and {r["tile_width"] for r in got} == {width} and {r["image_id"] for r in got} == {1}
    assert sorted(r["tile_id"] for r in got) == list(range(n))
    assert tiles.contiguous(grid).first()["ok"]
    assert tiles.tile_totals(image.where("image_id = 1"), 0.004, 0.5).first()["n_tiles"] == n


def test_cellular_edges(spark):
    grid = spark.createDataFrame([(1, 0, 0), (1, 100, 0)], "image_id long, tile_x long, tile_y long")
    cells = spark.createDataFrame([(1, 5.0, 5.0, "Neoplastic", True), (1, 99.9, 0.0, "Inflammatory", None), (1, -1.0, 5.0, "Neoplastic", False)], "image_id long, x double, y double, cell_type string, is_mitotic boolean")
    counts = cellular.tile_counts(cells, grid, 100, 100)
    assert rows(counts, "tile_x", "n_cells", "n_tumor", "n_lymph", "n_mitosis") == [(0, 2, 1, 1, 1), (100, 0, 0, 0, 0)]
    f = cellular.cellular_features(counts, tissue_min_cells=64).first()
    assert f["etil"] == 0.5 and f["til_coverage"] is None
    assert cellular.tile_counts(cells, grid.limit(0), 100, 100).count() == 0


def test_group_folds_keep_groups_together(spark):
    images = spark.range(200).select(F.col("id").alias("image_id"), (F.col("id") % 23).alias("patient"), (F.col("id") % 2).alias("y"))
    flat = folds.group_folds(images, 5, "patient", ["y"])
    together = flat.join(images, "image_id").groupBy("patient").agg(F.count_distinct("fold").alias("n"))
    assert together.where("n > 1").count() == 0 and flat.count() == 200
    sizes = [r["count"] for r in flat.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 2 * min(sizes)
    even = folds.stratified_folds(images, 4, ["y"]).groupBy("fold").count().collect()
    assert {r["count"] for r in even} == {50}
    assert folds.carve_validation(folds.expand_flat(flat, 5), 0.1).where("split = 'val'").count() > 0
    assert rows(folds.repeated_ids(spark.createDataFrame([(1,), (1,), (2,)], "image_id int")), "image_id", "n") == [(1, 2)]


def test_filters(spark):
    df = spark.createDataFrame([(1, "I", 5.0), (2, None, None), (3, "II", 1.0)], "id int, stage string, `the age` double")
    ids = lambda text: sorted(r["id"] for r in filters.where(df, text).collect())
    assert ids("stage in ['I', 'II']") == [1, 3] and ids("stage != 'I'") == [2, 3] and ids("stage not in ['I']") == [2, 3]
    assert ids("`the age` > 2") == [1] and ids("not (`the age` > 2)") == [2, 3] and ids("0 < `the age` <= 1 or stage == 'I'") == [1, 3] and ids(None) == [1, 2, 3]
    assert ids("(id > 1) & ~(stage == 'II')") == [2]
    assert filters.combine(None, "a > 1", None) == "(a > 1)" and filters.combine(None) is None
    for bad in ("__import__('os')", "id.real > 1", "@x > 1", "[i for i in id]"):
        with pytest.raises((ValueError, SyntaxError)):
            filters.condition(bad)


def test_tables(spark):
    a = spark.createDataFrame([("x", 1)], "image_id string, risk_score int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "image_id string, risk_score int")
    assert rows(tables.fuse({"a": a, "b": b}), "image_id", "a_risk_score", "b_risk_score") == [("x", 1, 2), ("y", None, 3)]
    assert rows(tables.overridden(b, spark.createDataFrame([("x", 9, 1), ("y", None, 1)], "image_id string, risk_score int, other int")), "image_id", "risk_score") == [("x", 9), ("y", 3)]
    assert tables.tagged(a, dataset="d").columns == ["dataset", "image_id", "risk_score"]
    assert rows(tables.missing(b, a, ["image_id"]), "image_id") == [("y",)]


def test_statistics(spark):
    rng = np.random.default_rng(1)
    score, label = np.round(rng.normal(size=300), 1), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(i, float(s), int(y)) for i, (s, y) in enumerate(zip(score, label, strict=True))], "id int, s double, y int")
    u = sum((a > b) + 0.5 * (a == b) for a in score[label == 1] for b in score[label == 0])
    test = stats.mann_whitney(df, "s", "y", []).first()
    assert test["u1"] == u and abs(test["effect_r"] - (2 * u / (test["n0"] * test["n1"]) - 1)) < 1e-12
    assert abs(stats.auroc(df, "s", "y").first()["auroc"] - u / (test["n0"] * test["n1"])) < 1e-12
    ap, hits = 0.0, 0
    for t in sorted(set(score), reverse=True):
        now = int(((score >= t) & (label == 1)).sum())
        ap += (now - hits) / (label == 1).sum() * now / (score >= t).sum()
        hits = now
    assert abs(stats.average_precision(df, "s", "y").first()["average_precision"] - ap) < 1e-12
    boot = stats.bootstrap_auroc(df, "s", "y", "id", 50).first()
    assert boot["low"] < u / (test["n0"] * test["n1"]) < boot["high"]
    p = [0.01, 0.04, 0.03, 0.5, 0.03]
    tests = spark.createDataFrame([(i, x) for i, x in enumerate(p)] + [(9, None)], "k int, p_value double")
    order = np.argsort(p)
    want, low = [0.0] * 5, 1.0
    for rank, i in reversed([*enumerate(order, 1)]):
        low = min(low, 5 * p[i] / rank)
        want[i] = low
    got = {r["k"]: r["p_adjusted"] for r in stats.benjamini_hochberg(tests).collect()}
    assert got[9] is None and np.allclose([got[i] for i in range(5)], want)


def test_kaplan_meier(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True), ("a", 3, True), ("a", 5, False), ("b", 4, True)], "g string, t int, e boolean")
    got = {(r["g"], r["time"]): r["recurrence_free_prob"] for r in stats.kaplan_meier(df, "t", "e", ["g"]).collect()}
    assert np.isclose(got["a", 1], 0.8) and np.isclose(got["a", 3], 0.8 / 3) and got["b", 4] == 0.0 and len(got) == 3


def test_pooling_gradients_and_scores(spark):
    rng = np.random.default_rng(3)
    model, x = pooling.Pooling.new(4, 2, 3, 0), rng.normal(size=(6, 4))
    _, grad = model.gradients(x, 1.0, 1.5)
    for name, g in grad.items():
        param = getattr(model, name)
        for at in [tuple(rng.integers(0, s) for s in param.shape) for _ in range(5)]:
            old = param[at]
            ends = []
            for step in (1e-6, -1e-6):
                param[at] = old + step
                ends.append(model.gradients(x, 1.0, 1.5)[0])
            param[at] = old
            assert abs((ends[0] - ends[1]) / 2e-6 - g[at]) < 1e-6, name
    bags = [(i, t, [float(v) for v in rng.normal(3 * (i % 2) if t == 0 else 0, 1, 4)]) for i in range(24) for t in range(5)]
    df = spark.createDataFrame(bags, "image_id long, tile_id long, features array<double>")
    splits = folds.expand_flat(spark.createDataFrame([(i, (i // 2) % 2) for i in range(24)], "image_id long, fold int"), 2)
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "image_id long, y int")
    models = pooling.train(df, labels, splits, "y", epochs=40)
    got = folds.out_of_fold(pooling.score(df, models), splits).join(labels, "image_id")
    assert stats.auroc(got, "risk_score", "y").first()["auroc"] > 0.7
    one = pooling.Pooling.load(models.where("fold = 0").first()["model"])
    z, a, _ = one.forward(np.array([b[2] for b in bags[:5]]))
    assert np.allclose(a.sum(0), 1)
    assert np.isclose(pooling.score(df, models).where("image_id = 0 and fold = 0").first()["risk_score"], 1 / (1 + np.exp(-z)))


def test_concepts(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3))
    vectors_ = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "image_id long, embedding array<double>")
    kinds = ["u", "v", "w"]
    labels = spark.createDataFrame([(i, float(2 * r[0] + 1), "yes" if r[1] > 0 else "no", kinds[i % 3], 1) for i, r in enumerate(x)], "image_id long, path_a double, path_b string, path_c string, path_d int")
    probes = concepts.plan(labels, ["path_a", "path_b", "path_c", "path_d"])
    assert [p[0] for p in probes] == ["path_a", "path_b", "path_c: u", "path_c: v", "path_c: w"]
    got = concepts.shared_out(concepts.predict(vectors_, concepts.fit(vectors_, labels, ["path_a", "path_b", "path_c"], replicas=4)))
    by = {(r["image_id"], r["concept"]): r["value"] for r in got.collect()}
    assert np.corrcoef([by[i, "path_a"] for i in range(60)], 2 * x[:, 0] + 1)[0, 1] > 0.99
    assert np.mean([(by[i, "path_b"] > 0.5) == (x[i, 1] > 0) for i in range(60)]) > 0.9
    assert all(abs(sum(by[i, f"path_c: {k}"] for k in kinds) - 1) < 1e-9 for i in range(60))
    w = concepts.ridge(x, 2 * x[:, 0] + 1, 1e-9)
    assert np.allclose(w, [1, 2, 0, 0], atol=1e-6)


def test_vectors(spark):
    df = spark.createDataFrame([(1, 0, [3.0, 4.0], 0), (1, 1, [0.0, 2.0], 0), (1, 2, [0.0, 0.0], 1), (1, 3, [1.0, 0.0], 2)], "image_id long, tile_id long, features array<double>, cluster int")
    assert rows(vectors.l2_normalised(df).where("tile_id = 0"), "features") == [([0.6, 0.8],)]
    centres = vectors.centroids(df)
    assert sorted(r["cluster"] for r in centres.collect()) == [0, 2]
    weights = {r["tile_id"]: r["cos_weight"] for r in vectors.cosine_weights(df, centres).collect()}
    assert weights[2] == 0.0 and weights[3] == 1.0
    near = {r["tile_id"]: r["cluster"] for r in vectors.nearest_centroid(df, centres).collect()}
    assert near == {0: 0, 1: 0, 2: 0, 3: 2}


def test_scalars(spark):
    df = spark.createDataFrame([("a/b/X.ome.TIFF", " -0.5", -0.5, 2.5), ("c.svs", "é!", 100.0, 3.5)], "p string, t string, v double, h double")
    got = df.select(scalar.slide_stem(F.col("p")), scalar.run_tag(F.col("t")), scalar.floor_bin("v", 0, 100), scalar.round_half_even(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("X", "0-5", -100, 2), ("c", None, 100, 4)]
    assert scalar.hive_path({"size_mm": 0.250, "model": ["a", "b"], "fold": None, "x": True}) == "model=a+b/size_mm=0.25/x=true"
    values = [1e-7, 0.1234567, 0.123457, 1e22, -0.0, 2.0, 0.1, 5e-324, True, 7]
    assert [scalar.hive_value(v) for v in values[:6]] == ["0.0000001", "0.1234567", "0.123457", "10000000000000000000000", "0", "2"]
    assert len({scalar.hive_value(v) for v in values}) == len(values) and all(float(scalar.hive_value(v)) == v for v in values if not isinstance(v, bool))
    for wrong in (float("nan"), float("inf"), -float("inf")):
        with pytest.raises(ValueError):
            scalar.hive_value(wrong)
    assert spark.range(1).select(scalar.duration(F.lit(3661.5))).first()[0] == "01:01:01"


def test_storage(spark, tmp_path):
    tree = tmp_path / "tree"
    spark.createDataFrame([(1, 0.5)], "image_id int, s double").coalesce(1).write.option("header", True).csv(str(tree / "size_mm=0.25" / "model=virchow2"))
    spark.createDataFrame([(2, 0.7)], "image_id int, s double").coalesce(1).write.option("header", True).csv(str(tree / "size_mm=0.125" / "model=uni"))
    got = storage.scan_hive(spark, str(tree), "csv", "*.csv", {"fold": 3})
    assert rows(got, "image_id", "size_mm", "model", "fold") == [(1, 0.25, "virchow2", 3), (2, 0.125, "uni", 3)]
    slides = tmp_path / "wsi"
    for name in ("a.svs", "sub/b.ome.tif", "_ignore/c.svs", "notes.txt"):
        (slides / name).parent.mkdir(parents=True, exist_ok=True)
        (slides / name).write_bytes(b"FAKE")
    index = storage.slide_index(spark, str(slides))
    assert sorted(r["image_id"] for r in index.collect()) == ["a", "b"]
    images = spark.createDataFrame([("a",), ("z",)], "image_id string")
    table = {r["image_id"]: r["wsi_path"] for r in storage.dataset_table(images, index).collect()}
    assert table["z"] == "" and table["a"].endswith("a.svs")
    doc = '{"features": [{"geometry": {"type": "MultiPoint", "coordinates": [[1, 2, 9], [3, 4]]}, "properties": {"classification": {"name": "T"}}}, {"geometry": {"type": "Polygon"}}, {"geometry": {"type": "MultiPoint", "coordinates": [[5, 6]]}}]}'
    cells = storage.geojson_cells(spark.createDataFrame([(1, doc), (2, "{}"), (3, None)], "image_id int, text string"))
    assert rows(cells, "x", "y", "cell_type") == [(1.0, 2.0, "T"), (3.0, 4.0, "T"), (5.0, 6.0, "unknown")]
    files = {"model.npz": b"x"}
    assert storage.verified(files, storage.manifest(files, name="m")) == files
    with pytest.raises(ValueError):
        storage.verified({"model.npz": b"y"}, storage.manifest(files))


def test_dictionary(spark):
    columns = {"stage": {"type": "categorical", "values": ["I", "II"]}, "age": {"type": "integer"}}
    df = spark.createDataFrame([("I", "5"), ("X", "old"), (None, None)], "stage string, age string")
    assert rows(dictionary.violations(df, columns), "column", "value", "n") == [("age", "old", 1), ("stage", "X", 1)]
    assert rows(dictionary.typed(df, columns), "age") == [(5,), (None,), (None,)]
    assert dictionary.schema(columns) == "`stage` string, `age` bigint"
    assert dictionary.bound(df, {"path_stage": "stage"}).columns == ["path_stage", "age"]


def test_stream_of_cells(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, 5.0, 5.0), (1, 7.0, 9.0), (1, 150.0, 5.0)], "image_id long, x double, y double").write.parquet(source)
    stream = streams.event_stream(spark, source, "image_id long, x double, y double")
    got = streams.drained(streams.tile_totals(stream, 100), str(tmp_path / "s"), "complete")
    assert rows(got, "tile_x", "n_cells") == [(0, 2), (100, 1)]


def test_tile_background(spark):
    from tessera.operators import images

    rgb = np.zeros((30, 90, 3), np.uint8)
    rgb[:, :30], rgb[:, 30:60], rgb[:, 60:] = (120, 30, 90), (30, 60, 200), (255, 255, 255)
    thumbs = spark.createDataFrame([(1, 30, 90, bytearray(rgb.tobytes()))], "image_id long, height int, width int, rgb binary")
    grid = spark.createDataFrame([(1, i, 300 * i, 0, 300, 300) for i in range(3)], "image_id long, tile_id long, tile_x long, tile_y long, tile_width long, tile_height long")
    assert rows(images.tile_background(thumbs, grid), "tile_id", "tile_background") == [(0, False), (1, True), (2, True)]
    assert images.tile_background(thumbs, grid.limit(0)).count() == 0
