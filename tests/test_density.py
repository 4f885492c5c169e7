"""Density clusters as joins, against the sequential algorithm."""

from __future__ import annotations

import numpy as np
import pytest

from tessera.operators import density, graphs


def density_labels(x: np.ndarray, y: np.ndarray, eps: float, least: int) -> np.ndarray:
    """DBSCAN labels, -1 for noise. Points meet only those of the neighbouring squares of side eps."""
    n = len(x)
    label = np.full(n, -1)
    if not n:
        return label
    gx, gy = np.floor(x / eps).astype(np.int64), np.floor(y / eps).astype(np.int64)
    squares: dict[tuple[int, int], np.ndarray] = {}
    order = np.lexsort((gy, gx))
    edge = np.flatnonzero(np.diff(gx[order], prepend=gx[order[0]] - 1) | np.diff(gy[order], prepend=gy[order[0]]))
    for a, b in zip(edge, np.append(edge[1:], n), strict=True):
        squares[int(gx[order[a]]), int(gy[order[a]])] = order[a:b]

    def around(i: int) -> np.ndarray:
        near = np.concatenate([squares[s] for dx in (-1, 0, 1) for dy in (-1, 0, 1) if (s := (int(gx[i]) + dx, int(gy[i]) + dy)) in squares])
        return near[(x[near] - x[i]) ** 2 + (y[near] - y[i]) ** 2 <= eps * eps]

    seen = np.zeros(n, bool)
    cluster = 0
    for start in range(n):
        if seen[start]:
            continue
        seen[start] = True
        front = around(start)
        if front.size < least:
            continue
        label[start] = cluster
        stack = [front]
        while stack:
            new = stack.pop()
            new = new[(label[new] < 0)]
            label[new] = cluster
            for i in new[~seen[new]].tolist():
                seen[i] = True
                more = around(i)
                if more.size >= least:
                    stack.append(more)
        cluster += 1
    return label


def test_density_labels():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, 40), rng.normal(30, 1, 40), rng.uniform(100, 1000, 10)])
    y = np.concatenate([rng.normal(0, 1, 40), rng.normal(0, 1, 40), rng.uniform(100, 1000, 10)])
    label = density_labels(x, y, 3.0, 5)
    assert len(set(label[:40])) == 1 and len(set(label[40:80])) == 1 and label[0] != label[40] and (label[80:] == -1).all()
    assert density_labels(x[:0], y[:0], 1.0, 1).size == 0


def plain_clusters(rows, eps, least):
    """{row number: smallest core cell id of its cluster or None} of (image, cell, x, y) rows."""
    out = {}
    for image in {r[0] for r in rows}:
        own = sorted((i for i, r in enumerate(rows) if r[0] == image and r[2] is not None and r[3] is not None and r[2] == r[2] and r[3] == r[3]), key=lambda i: rows[i][1])
        x, y = (np.array([rows[i][k] for i in own], float) for k in (2, 3))
        label = density_labels(x, y, eps, least)
        core = [int(((x - a) ** 2 + (y - b) ** 2 <= eps * eps).sum()) >= least for a, b in zip(x, y)]
        names = {k: min(rows[i][1] for i, c, n in zip(own, label, core) if c == k and n) for k in set(label.tolist()) - {-1}}
        out |= {i: names.get(int(k)) for i, k in zip(own, label)}
    return out


def clumps(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for image in (1, 2, None):
        for _ in range(6):
            x, y = rng.uniform(-50, 150, 2)
            n = int(rng.choice([3, 20, 150]))
            rows += [(image, a, b) for a, b in zip(rng.normal(x, 6, n), rng.normal(y, 6, n))]
        # two walls of many cells whose gap is near eps
        gap = 5.0 + seed % 3 * 0.001
        rows += [(image, 300.0 - k % 7 * 0.3, 300 + k * 0.1) for k in range(80)] + [(image, 300.0 + gap - 1e-3 + k % 7 * 0.3, 300 + k * 0.1) for k in range(80)]
        rows += [(image, float(k), 400.0) for k in range(0, 90, 1)] + [(image, 500.0, 500.0)] * 12 + [(image, None, 1.0), (image, float("nan"), 1.0)]
    return [(i, n, None if x is None else float(x), None if y is None else float(y), "t", 1) for n, (i, x, y) in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_density_clusters(spark, seed):
    rows = clumps(seed)
    cells = spark.createDataFrame(rows, "image_id long, cell_id long, x double, y double, square string, row int")
    got = {r["cell_id"]: r["cluster"] for r in density.density_clusters(cells, 5.0, 5).collect()}
    want = plain_clusters(rows, 5.0, 5)
    assert got == {r[1]: want.get(i) for i, r in enumerate(rows)}
    stay = {r["cell_id"] for r in density.dense_cells(cells, 5.0, 5, 0.5).collect()}
    sizes = {}
    for i, c in want.items():
        if c is not None:
            sizes.setdefault(rows[i][0], {}).setdefault(c, []).append(rows[i][1])
    assert stay == {n for own in sizes.values() for ids in own.values() if len(ids) >= 0.5 * max(map(len, own.values())) for n in ids}


def test_density_of_string_ids_and_of_nothing(spark):
    cells = spark.createDataFrame([("S-01", f"c{i}", float(i % 3), 0.0) for i in range(12)] + [("S-02", "c1", 0.0, 0.0)], "image_id string, cell_id string, x double, y double")
    assert sorted(r["cell_id"] for r in density.dense_cells(cells, 2.0, 4).collect()) == sorted(f"c{i}" for i in range(12))
    assert density.dense_cells(cells.limit(0)).collect() == [] and density.dense_cells(cells).columns == cells.columns
    with pytest.raises(ValueError):
        density.dense_cells(cells, share=10)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 300) if i % 100 != 99] + [(500, 500), (600, 601), (601, 600)]
    got = {r["node"]: r["part"] for r in graphs.components(spark.createDataFrame(links, "a int, b int")).collect()}
    groups = {}
    for node, part in got.items():
        groups.setdefault(part, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [list(range(0, 100)), list(range(100, 200)), list(range(200, 300)), [600, 601]]
    assert graphs.components(spark.createDataFrame([], "a int, b int")).count() == 0
