"""Communities against Louvain moves, modularity by definition, and projections by their values."""

from __future__ import annotations

import numpy as np
import pytest

from tessera.operators import clustering, communities, vectors


def louvain(edges: list[tuple[int, int, float]], n: int, resolution: float = 1.0, seed: int = 0) -> list[int]:
    """Communities of a small weighted graph by moving nodes and merging (Louvain), with resolution.

    For centroid graphs of a few thousand nodes; the result numbers communities by first member.
    """
    rng = np.random.default_rng(seed)
    label = list(range(n))
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    while True:
        degree = [sum(x.values()) for x in near]
        total = sum(degree) or 1.0
        home = list(range(len(near)))
        weight = degree.copy()
        moved_once = False
        for _ in range(20):
            moved = False
            for i in rng.permutation(len(near)).tolist():
                links: dict[int, float] = {}
                for j, w in near[i].items():
                    if j != i:
                        links[home[j]] = links.get(home[j], 0.0) + w
                weight[home[i]] -= degree[i]
                gain = lambda c, links=links, i=i: links.get(c, 0.0) - resolution * degree[i] * weight[c] / total
                best = max(sorted({home[i], *links}), key=lambda c: (gain(c), c == home[i]))
                if gain(best) <= gain(home[i]) + 1e-12:
                    best = home[i]
                moved |= best != home[i]
                home[i] = best
                weight[best] += degree[i]
            moved_once |= moved
            if not moved:
                break
        ids = {c: k for k, c in enumerate(dict.fromkeys(home))}
        label = [ids[home[x]] for x in label]
        if not moved_once or len(ids) == len(near):
            return label
        merged: list[dict[int, float]] = [{} for _ in ids]
        for i, row in enumerate(near):
            for j, w in row.items():
                a, b = ids[home[i]], ids[home[j]]
                merged[a][b] = merged[a].get(b, 0.0) + w
        near = merged


def test_communities():
    edges = [(a, b, 1.0) for base in (0, 5) for a in range(base, base + 5) for b in range(a + 1, base + 5)] + [(4, 5, 0.1)]
    label = clustering.leiden(edges, 10)
    assert len(set(label[:5])) == 1 and len(set(label[5:])) == 1 and label[0] != label[9]
    assert clustering.leiden([], 1) == [0]


def value(edges, label, resolution):
    """Modularity by its definition."""
    total = 2 * sum(w for _, _, w in edges)
    degree, inside = {}, {}
    for a, b, w in edges:
        degree[label[a]] = degree.get(label[a], 0) + w
        degree[label[b]] = degree.get(label[b], 0) + w
        if label[a] == label[b]:
            inside[label[a]] = inside.get(label[a], 0) + 2 * w
    return sum(inside.get(c, 0) / total - resolution * (k / total) ** 2 for c, k in degree.items())


def graph(seed, n=60, parts=5):
    rng = np.random.default_rng(seed)
    own = rng.integers(0, parts, n)
    return [(i, j, float(rng.uniform(0.5, 1.5))) for i in range(n) for j in range(i) if rng.random() < (0.35 if own[i] == own[j] else 0.04)]


def test_communities_are_no_worse_than_louvain_and_connected():
    better = []
    for seed in range(12):
        edges = graph(seed)
        for resolution in (0.5, 1.0, 3.0):
            label, other = clustering.leiden(edges, 60, resolution, seed), louvain(edges, 60, resolution, seed)
            better.append(value(edges, label, resolution) - value(edges, other, resolution))
            root = list(range(60))

            def top(x):
                while root[x] != x:  # noqa: B023
                    x = root[x]  # noqa: B023
                return x

            for a, b, _ in edges:
                if label[a] == label[b]:
                    root[top(a)] = top(b)
            assert len({top(i) for i in range(60)}) == len(set(label))
    assert np.mean(better) >= 0 and min(better) > -0.02, better


def test_resolutions_in_one_run(spark):
    edges = graph(3)
    names = [f"n{i:02d}" for i in range(61)]
    df = spark.createDataFrame([(names[a], names[b], w) for a, b, w in edges] + [("n01", "n01", 5.0), ("n02", "zz", 1.0), ("n03", "n04", None)], "src string, dst string, weight double")
    nodes = spark.createDataFrame([(x,) for x in names], "node string")
    label = clustering.communities_of(nodes, df, [0.5, 2.0], seed=4).persist()
    got = {(r["resolution"], r["node"]): r["community"] for r in label.collect()}
    assert len(got) == 122 and got[0.5, "n60"] == "n60"
    known = df.where("dst <> 'zz' and weight is not null")
    for r in clustering.modularity(known, label).collect():
        own = [names.index(got[r["resolution"], x]) for x in names]
        assert np.isclose(r["modularity"], value(edges, own, r["resolution"])) and r["n_communities"] == len(set(own))
        assert all(min(i for i in range(61) if own[i] == c) == c for c in own)
    assert clustering.communities_of(nodes.limit(0), df, [1.0]).count() == 0
    assert {r["community"] for r in clustering.communities_of(nodes.limit(2), df.limit(0), [1.0]).collect()} == {"n00", "n01"}


def test_communities_of_more_nodes_than_fit_a_task(spark, monkeypatch):
    monkeypatch.setattr(clustering, "MOST_NODES", 20)
    better = []
    for seed in (0,):
        edges = graph(seed)
        names = [f"n{i:02d}" for i in range(61)]
        df = spark.createDataFrame([(names[a], names[b], w) for a, b, w in edges] + [("n01", "n01", 5.0), ("n02", "zz", 1.0), ("n03", "n04", None)], "src string, dst string, weight double")
        resolutions = [1.0, 3.0]
        rows = communities.communities(spark.createDataFrame([(x,) for x in names], "node string"), df, resolutions).collect()
        got = {(r["resolution"], r["node"]): r["community"] for r in rows}
        assert len(rows) == len(got) == 122 and got[1.0, "n60"] == "n60"
        for resolution in resolutions:
            label = [names.index(got[resolution, x]) for x in names]
            assert all(min(i for i in range(61) if label[i] == c) == c for c in label)
            better.append(value(edges, label, resolution) - value(edges, louvain(edges, 60, resolution, seed), resolution))
            root = list(range(60))

            def top(x):
                while root[x] != x:  # noqa: B023
                    x = root[x]  # noqa: B023
                return x

            for a, b, _ in edges:
                if label[a] == label[b]:
                    root[top(a)] = top(b)
            assert len({top(i) for i in range(60)}) == len(set(label[:60]))
    assert min(better) > -0.02, better


def test_too_many_nodes(spark, monkeypatch):
    monkeypatch.setattr(clustering, "MOST_NODES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        clustering.communities_of(spark.range(4).withColumnRenamed("id", "node"), spark.createDataFrame([], "src long, dst long, weight double"), [1.0])


def test_projection_and_nearest_centroids(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (200, 6)) * [5, 3, 1, 0.1, 0.1, 0.1] + [9, 0, 0, 0, 0, 0]
    tiles = spark.createDataFrame([(i % 4, i // 4, v.tolist()) for i, v in enumerate(x)], "image_id long, tile_id long, features array<double>")
    mean, parts, share = clustering.pca_fit(tiles, 3)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    values, axes = np.linalg.eigh(np.cov(unit.T))
    assert np.allclose(mean, unit.mean(0)) and np.allclose(share, values[::-1][:3] / values.sum())
    assert np.allclose(np.abs(np.sum(parts * axes[:, ::-1][:, :3].T, 1)), 1)
    got = {(r["image_id"], r["tile_id"]): np.array(r["features"]) for r in clustering.pca_project(tiles, mean, parts).collect()}
    want = (unit - unit.mean(0)) @ parts.T
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert all(np.allclose(got[i % 4, i // 4], want[i]) for i in range(200))
    centres = clustering.spherical_kmeans(tiles, 5)
    c = np.array([r["centroid"] for r in centres.orderBy("cluster").collect()])
    near = {(r["image_id"], r["tile_id"]): (r["cluster"], r["similarity"]) for r in vectors.nearest_centroid(vectors.l2_normalised(tiles), centres).collect()}
    assert np.allclose(np.linalg.norm(c, axis=1), 1)
    for i in range(200):
        cos = c @ unit[i]
        assert near[i % 4, i // 4][0] == int(np.argmax(cos)) and np.isclose(near[i % 4, i // 4][1], cos.max())
