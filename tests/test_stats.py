"""Exact rank tests, agreement of labelings, and orders of any keys."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from tessera.operators import folds, ordered, outcomes, stats


def test_u_counts_equal_all_deals():
    for n0, n1 in itertools.product(range(1, 7), range(1, 7)):
        deals = Counter(sum(ranks) - n1 * (n1 - 1) // 2 for ranks in itertools.combinations(range(n0 + n1), n1))
        assert stats.u_counts(n0, n1).tolist() == [deals[u] for u in range(n0 * n1 + 1)]
    assert sum(stats.u_counts(8, 400)) == math.comb(408, 8)


def test_exact_p_by_enumeration(spark):
    rnd = random.Random(1)
    groups = {g: [(rnd.random() + 0.3 * y, y) for y in [1] * n1 + [0] * n0] for g, (n1, n0) in enumerate([(3, 5), (1, 4), (8, 3), (2, 40), (9, 9), (4, 0), (5, 5)])}
    groups[6] = [(float(round(v)), y) for v, y in groups[6]]
    rows = [(g, v, y) for g, own in groups.items() for v, y in own]
    got = {r["g"]: r for r in stats.with_p_values(stats.mann_whitney(spark.createDataFrame(rows, "g int, v double, y int"), "v", "y", ["g"])).collect()}
    for g in (0, 1, 2, 3):
        own = sorted(groups[g])
        n1 = sum(y for _, y in own)
        u = lambda ranks: sum(ranks) - n1 * (n1 - 1) / 2  # noqa: B023, E731
        all_u = [u(c) for c in itertools.combinations(range(len(own)), n1)]
        mine = u([i for i, (_, y) in enumerate(own) if y])
        low = min(mine, n1 * (len(own) - n1) - mine)
        assert got[g]["u1"] == mine and np.isclose(got[g]["p_value"], min(1, 2 * sum(x <= low for x in all_u) / len(all_u)))
    assert 0 < got[4]["p_value"] < 1 and got[5]["p_value"] is None and got[6]["ties"] > 0 and got[6]["p_value"] is not None


def test_significant_or_all(spark):
    rows = spark.createDataFrame([(1, 0.01), (2, 0.2), (3, None)], "c int, p_adjusted double")
    assert [r["c"] for r in stats.significant(rows).collect()] == [1]
    assert sorted(r["c"] for r in stats.significant(rows, 0.001).collect()) == [1, 2, 3] and stats.significant(rows.limit(0)).count() == 0


def plain_ami(a, b):
    n, ca, cb, both = len(a), Counter(a), Counter(b), Counter(zip(a, b))
    h = lambda c: -sum(k / n * math.log(k / n) for k in c.values())
    mi = sum(k / n * math.log(k * n / (ca[x] * cb[y])) for (x, y), k in both.items())
    emi = sum(k / n * math.log(k * n / (p * q)) * math.comb(q, k) * math.comb(n - q, p - k) / math.comb(n, p) for p in ca.values() for q in cb.values() for k in range(max(1, p + q - n), min(p, q) + 1))
    rest = (h(ca) + h(cb)) / 2 - emi
    return (mi - emi) / rest if len(ca) > 1 or len(cb) > 1 else 1.0


def test_adjusted_mutual_information(spark):
    rnd = random.Random(2)
    a = [rnd.randint(0, 4) for _ in range(120)]
    runs = {0: a, 1: [x if rnd.random() < 0.7 else rnd.randint(0, 4) for x in a], 2: [rnd.randint(0, 9) for _ in a], 3: [x // 2 for x in a]}
    rows = spark.createDataFrame([(i, r, x) for r, own in runs.items() for i, x in enumerate(own)], "tile_id long, run int, cluster int")
    got = {(r["run_a"], r["run_b"]): r["ami"] for r in stats.agreement(rows).collect()}
    assert set(got) == set(itertools.combinations(range(4), 2))
    for (x, y), v in got.items():
        assert np.isclose(v, plain_ami(runs[x], runs[y]), atol=1e-10)
    one = spark.createDataFrame([(1, 1)] * 5, "x int, y int")
    assert stats.mutual_information(one, "x", "y").first()["ami"] == 1.0
    n = spark.range(300)
    assert all(abs(r["f"] - math.lgamma(r["id"] + 1)) < 1e-10 * max(1, r["f"]) for r in n.select("id", stats.log_factorial(n["id"]).alias("f")).collect())


def test_orders_of_strings(spark):
    ids = [f"S-{i:04d}" for i in range(3000)]
    images = spark.createDataFrame([(i,) for i in ids], "image_id string")
    got = {r["image_id"]: r["fold"] for r in folds.modulo_folds(images, 5).collect()}
    assert got == {i: k % 5 for k, i in enumerate(ids)}
    assert ordered.in_ranges(images, "image_id").select("_range").distinct().count() > 30
    assert folds.modulo_folds(images.limit(0), 5).count() == 0


def test_strengths_skip_folds_of_one_class(spark):
    rows = spark.createDataFrame([(i, [float(i % 7), float(i % 3)], int(i % 2 and i < 20), i // 10) for i in range(40)], "image_id long, features array<double>, y int, fold int")
    assert outcomes.choose_strength(rows, "y", [0.1, 1.0]) in (0.1, 1.0)
    assert outcomes.choose_strength(rows.where("fold = 3"), "y", [0.1, 1.0]) == 0.1
    with pytest.raises(ValueError, match="0 or 1"):
        outcomes.fit(rows.selectExpr("image_id", "features", "y + 1 as y"), "y", "logreg_l2")
