"""Rasters in blocks against whole images in one process."""

from __future__ import annotations

import numpy as np
import pytest

from tessera.operators import images, rasters


def squares(mask, low, high, how):
    h, w = mask.shape
    return np.array([[how(mask[max(i + low, 0) : i + high + 1, max(j + low, 0) : j + high + 1]) for j in range(w)] for i in range(h)])


def cut(spark, whole, side):
    rows = []
    for image, rgb in whole.items():
        for i in range(0, rgb.shape[0], side):
            for j in range(0, rgb.shape[1], side):
                b = np.ascontiguousarray(rgb[i : i + side, j : j + side])
                rows.append((image, i // side, j // side, b.shape[0], b.shape[1], bytearray(b.tobytes())))
    return spark.createDataFrame(rows, "image_id string, block_row int, block_col int, height int, width int, rgb binary").repartition(5)


def plain_resize(rgb, height, width, kernel, reach):
    """Sum by sum in floating point, rounded after each direction."""

    def one(x, new):
        scale = x.shape[1] / new
        wide, out = max(scale, 1.0), np.zeros((x.shape[0], new, 3))
        for i in range(new):
            centre = (i + 0.5) * scale
            low, high = max(0, int(centre - reach * wide + 0.5)), min(x.shape[1], int(centre + reach * wide + 0.5))
            w = np.array([float(kernel(np.array([(k - centre + 0.5) / wide]))[0]) for k in range(low, high)])
            out[:, i] = np.einsum("k,hkc->hc", w / w.sum(), x[:, low:high].astype(float))
        return np.clip(np.floor(out + 0.5), 0, 255)

    return one(one(rgb, width).transpose(1, 0, 2), height).transpose(1, 0, 2)


@pytest.mark.parametrize("new", [(7, 9), (40, 50), (30, 41), (100, 100)])
def test_resize(new):
    rgb = np.random.default_rng(1).integers(0, 256, (30, 41, 3)).astype(np.uint8)
    for kernel, reach in ((rasters.triangle, 1.0), (rasters.cubic, 2.0)):
        got, want = rasters.resize(rgb, *new, kernel, reach), plain_resize(rgb, *new, kernel, reach)
        assert got.shape == want.shape and np.abs(got.astype(int) - want).max() <= 1 and np.mean(got != want) < 0.03
    assert (rasters.resize(rgb, 30, 41) == rgb).all()
    assert (rasters.resize(np.full((5, 6, 3), 77, np.uint8), 9, 3, rasters.cubic, 2.0) == 77).all()


def test_thumbnails_equal_resizing_the_whole(spark, monkeypatch):
    monkeypatch.setattr(rasters, "STRIP", 8)
    rng = np.random.default_rng(2)
    whole = {"a": rng.integers(0, 256, (75, 110, 3)).astype(np.uint8), "b": rng.integers(0, 256, (90, 33, 3)).astype(np.uint8), "c": rng.integers(0, 256, (20, 30, 3)).astype(np.uint8)}
    got = rasters.thumbnails(cut(spark, whole, 32), 32, 40).collect()
    for image, rgb in whole.items():
        h, w = rasters.fitted(*rgb.shape[:2], 40)
        out = np.zeros((h, w, 3), np.uint8)
        for r in got:
            if r["image_id"] == image:
                out[r["block_row"] * 8 :, r["block_col"] * 8 :][: r["height"], : r["width"]] = rasters.pixels(r["rgb"], r["height"], r["width"])
        assert (out == rasters.resize(rgb, h, w)).all(), image
    assert rasters.thumbnails(cut(spark, whole, 32).limit(0), 32).count() == 0


def test_patches(spark):
    rng = np.random.default_rng(3)
    whole = {"a": rng.integers(1, 256, (75, 110, 3)).astype(np.uint8), "b": rng.integers(1, 256, (40, 33, 3)).astype(np.uint8)}
    cells = [("a", 1, float(x), float(y)) for x, y in rng.uniform(-10, 120, (40, 2))] + [("b", 1, 0.5, 1.5), ("b", 2, 500.0, 0.0), ("z", 1, 5.0, 5.0), ("a", 7, None, 1.0)]
    df = spark.createDataFrame(cells, "image_id string, cell_id long, x double, y double")
    got = rasters.patches(cut(spark, whole, 16), df, 16, 24).collect()
    assert len(got) == len(cells)
    for r in got:
        want = np.zeros((24, 24, 3), np.uint8)
        if r["x"] is not None and r["image_id"] in whole:
            padded = np.pad(whole[r["image_id"]], ((600, 600), (600, 600), (0, 0)))
            x, y = int(np.rint(r["x"])) - 12 + 600, int(np.rint(r["y"])) - 12 + 600
            want = padded[y : y + 24, x : x + 24]
        assert (rasters.pixels(r["rgb"], 24, 24) == want).all(), (r["x"], r["y"])


def test_patches_move_no_pixels_for_each_cell(spark):
    rng = np.random.default_rng(5)
    whole = {"a": rng.integers(1, 256, (75, 110, 3)).astype(np.uint8)}
    places = [("a", i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 75, (2000, 2)).tolist())]
    df = spark.createDataFrame(places, "image_id string, cell_id long, x double, y double")
    sc = spark.sparkContext._jsc.sc()

    def moved():
        sc.listenerBus().waitUntilEmpty(30_000)
        return sc.statusStore().executorList(True).head().totalShuffleWrite()

    before = moved()
    got = rasters.patches(cut(spark, whole, 16), df, 16, 24).collect()
    assert len(got) == 2000 and sum(len(r["rgb"]) for r in got) == 2000 * 24 * 24 * 3
    assert 0 < moved() - before < 1_000_000  # the patches have 3.5 MB, the blocks 25 KB


def test_filters_by_running_sums():
    rng = np.random.default_rng(4)
    for p in (0.2, 0.7, 0.97):
        mask = rng.random((25, 25)) < p
        for size in (3, 4, 10, 20, 100):
            low, high = -(size // 2), size - size // 2 - 1
            assert (rasters.eroded(mask, size) == squares(mask, low, high, np.all)).all()
            assert (rasters.dilated(mask, size) == squares(mask, low, high, np.any)).all()
        edged = np.pad(mask, 2, mode="symmetric")
        assert (rasters.median(mask, 5) == np.array([[edged[i : i + 5, j : j + 5].sum() > 12 for j in range(25)] for i in range(25)])).all()


def test_shares_and_fractions(spark):
    masks = spark.createDataFrame([("a", list(range(100)), []), ("b", [], None), ("c", [1], list(range(100)))], "image_id string, background array<int>, ink array<int>")
    got = {r["image_id"]: r["share"] for r in rasters.rejected_shares(masks, 10).collect()}
    assert got == {"a": 1.0, "b": 0.0, "c": 1.0}
    tissue, glass, ink = (np.full((40, 40, 3), c, np.uint8) for c in ((170, 60, 130), (250, 250, 250), (30, 60, 200)))
    assert images.background_fraction(tissue) == 0 and images.background_fraction(glass) == 1 and images.background_fraction(ink) == 1
    spot = tissue.copy()
    spot[18:21, 18:21] = (30, 60, 200)  # too small a piece of ink
    assert images.background_fraction(spot) == 0
    half = tissue.copy()
    half[:, :16] = 250
    assert 0.2 < images.background_fraction(half) < 0.4  # erosion takes the border off
    large = tissue.copy()
    large[:12, :12] = (30, 60, 200)
    assert images.background_fraction(large) > 0.5
