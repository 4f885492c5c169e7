"""Array files by ranges of rows and by headers."""

from __future__ import annotations

import numpy as np
import pytest

from tessera.sources import arrays


def test_ranges_of_rows(spark, tmp_path):
    rng = np.random.default_rng(1)
    made = {"a": rng.normal(size=(2500, 3)).astype("<f4"), "b/c": rng.normal(size=(7, 2, 2)), "d": np.arange(5), "e": np.zeros((0, 4)), "f": np.array(2.5)}
    for name, x in made.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        np.save(tmp_path / f"{name}.npy", x)
    (tmp_path / "other.txt").write_text("x")
    rows = arrays.read_arrays(spark, str(tmp_path), rows=1100)
    assert rows.rdd.getNumPartitions() == 3 + 3
    got = {}
    for r in rows.collect():
        got.setdefault(r["path"].split(str(tmp_path))[1][1:-4], {})[r["row"]] = r["features"]
    assert set(got) == set(made) - {"e"}
    for name, own in got.items():
        x = made[name].reshape(max(1, made[name].shape[0] if made[name].ndim else 1), -1)
        assert sorted(own) == list(range(len(x))) and np.array_equal([own[i] for i in range(len(x))], x.astype(float))
    shapes = {r["path"].split(str(tmp_path))[1][1:-4]: (r["n_rows"], r["width"], r["dtype"]) for r in arrays.array_shapes(spark, f"file://{tmp_path}").collect()}
    assert shapes == {"a": (2500, 3, "float32"), "b/c": (7, 4, "float64"), "d": (5, 1, "int64"), "e": (0, 4, "float64"), "f": (1, 1, "float64")}


def test_refused_files(tmp_path):
    np.save(tmp_path / "o.npy", np.array([{}], object), allow_pickle=True)
    np.save(tmp_path / "f.npy", np.asfortranarray(np.ones((3, 2))))
    with pytest.raises(ValueError, match="objects"):
        arrays.shape_of(str(tmp_path / "o.npy"))
    with pytest.raises(ValueError, match="column"):
        arrays.shape_of(str(tmp_path / "f.npy"))
    with pytest.raises(FileNotFoundError):
        arrays.listed(str(tmp_path / "none"))


def test_features_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "ROWS", 10)
    rows = [(f"S-{i}", t, [float(i), t / 4]) for i in range(3) for t in range(25)]
    tiles = spark.createDataFrame(rows, "image_id string, tile_id long, features array<double>")
    told = arrays.write_features(tiles, str(tmp_path / "x"))
    assert sorted((r["chunk"], r["n_rows"]) for r in told.where("image_id = 'S-1'").collect()) == [(0, 10), (1, 10), (2, 5)]
    arrays.write_features(tiles, str(tmp_path / "x"))  # a repeated task
    got = arrays.read_features(spark, str(tmp_path / "x"), "string")
    assert sorted((r["image_id"], r["tile_id"], r["features"]) for r in got.collect()) == rows
