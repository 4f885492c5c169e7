"""Attention pooling of bags: training, scoring and attribution as aggregations over tiles.

A bag is the tiles of one image. The model is gated attention with several branches: tile n has
logits s_k = w_k . (tanh(V_k x) * sigmoid(U_k x)); attention is the softmax of s_k over the bag, the
bag's vector the attention-weighted mean of x, and the score a logistic function of all branches'
vectors.

No bag is ever in one place. A bag's score follows from sums over its tiles of exp(s - top) and of
that times the tile's share c_k . x, where top is the bag's greatest logit; a tile's part of the
gradient follows from its own numbers and those few sums of its bag. So a step of training is two
passes over the tiles: one sums by bag, one joins the sums back and adds up gradients by fold, in each
task first. Only weights come to the driver.

Ids may be of any type. Images without tiles or without a label have no part; null features too.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import stats
from tessera.sources.storage import staged

#: Bags whose sums are broadcast at most; beyond, tiles are joined with them by sort-merge.
MOST_BAGS = 200_000
#: Numbers of a gradient in a row.
CHUNK = 4096
PARAMETERS = ("v", "u", "w", "c", "b")


@dataclass
class Pooling:
    v: np.ndarray  # (k, h, d)
    u: np.ndarray  # (k, h, d)
    w: np.ndarray  # (k, h)
    c: np.ndarray  # (k * d)
    b: np.ndarray  # (1)

    @classmethod
    def new(cls, d: int, branches: int, hidden: int, seed: int) -> Pooling:
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[-1]), s)
        return cls(draw(branches, hidden, d), draw(branches, hidden, d), draw(branches, hidden), draw(branches * d) * 0.1, np.zeros(1))

    @classmethod
    def of_rule(cls, d: int, branches: int, hidden: int) -> Pooling:
        """Weights by a rule that SQL can state: sines and cosines of the places."""
        k, h, i = np.ogrid[:branches, :hidden, :d]
        flat = np.arange(branches)[:, None] + 2 * np.arange(d)
        return cls(np.sin(1 + 3 * k + 5 * h + 7 * i) / math.sqrt(d), np.cos(2 + 5 * k + 3 * h + 11 * i) / math.sqrt(d), np.sin(1 + k + 2 * h)[:, :, 0], np.cos(flat).ravel() / math.sqrt(d), np.array([0.1]))

    def logits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = np.tanh(np.einsum("khd,nd->nkh", self.v, x))
        g = 1 / (1 + np.exp(-np.einsum("khd,nd->nkh", self.u, x)))
        return np.einsum("kh,nkh->nk", self.w, t * g), t, g

    def forward(self, x: np.ndarray) -> tuple[float, np.ndarray, tuple]:
        s, t, g = self.logits(x)
        a = np.exp(s - s.max(0))
        a /= a.sum(0)
        r = a.T @ x
        z = float(self.c @ r.ravel() + self.b[0])
        return z, a, (t, g, r)

    def gradients(self, x: np.ndarray, y: float, weight: float) -> tuple[float, dict[str, np.ndarray]]:
        """Loss of a bag (weighted cross-entropy) and its gradients."""
        z, a, (t, g, r) = self.forward(x)
        p = np.clip(1 / (1 + np.exp(-z)), 1e-5, 1 - 1e-5)
        dz = weight * (1 / (1 + np.exp(-z)) - y)
        dr = dz * self.c.reshape(r.shape)
        da = x @ dr.T
        ds = a * (da - (a * da).sum(0))
        dh = ds[:, :, None] * self.w
        dt, dg = dh * g * (1 - t * t), dh * t * g * (1 - g)
        grad = {"c": dz * r.ravel(), "b": np.array([dz]), "w": np.einsum("nk,nkh->kh", ds, t * g), "v": np.einsum("nkh,nd->khd", dt, x), "u": np.einsum("nkh,nd->khd", dg, x)}
        return float(-weight * (y * np.log(p) + (1 - y) * np.log(1 - p))), grad

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Pooling:
        return cls(**np.load(io.BytesIO(raw), allow_pickle=False))


class Adam:
    """Steps of one model, with decaying means of gradients and of their squares."""

    def __init__(self, model: Pooling, rate: float):
        self.model, self.rate, self.step = model, rate, 0
        self.mean = {k: np.zeros_like(getattr(model, k)) for k in PARAMETERS}
        self.square = {k: np.zeros_like(getattr(model, k)) for k in PARAMETERS}

    def move(self, grad: dict[str, np.ndarray]) -> None:
        self.step += 1
        new = {}
        for k, g in grad.items():
            self.mean[k] = 0.9 * self.mean[k] + 0.1 * g
            self.square[k] = 0.999 * self.square[k] + 0.001 * g * g
            new[k] = getattr(self.model, k) - self.rate * (self.mean[k] / (1 - 0.9**self.step)) / (np.sqrt(self.square[k] / (1 - 0.999**self.step)) + 1e-8)
        self.model = replace(self.model, **new)


def _loaded(held: dict[int, bytes]) -> dict[int, Pooling]:
    return {f: Pooling.load(m) for f, m in held.items()}


def _stacked(features: pd.Series) -> np.ndarray:
    return np.stack(features.to_numpy()).astype(float)


def branch_sums(tiles: DataFrame, models: DataFrame) -> DataFrame:
    """(image_id, cluster, fold, branch, n, top, e, es, bias): the sums from which a bag's score
    follows, for each cluster of its tiles (which may be null), by every fold's model.

    ``top`` is the greatest logit of the cluster, ``e`` sums exp(logit - top), ``es`` that times the
    tile's share of the score. Each batch is summed up before it leaves Python.
    """
    held = {r["fold"]: bytes(r["model"]) for r in models.collect()}  # a model for each fold: few and small
    return _sums(tiles, held)


def _sums(tiles: DataFrame, held: dict[int, bytes]) -> DataFrame:
    kind = tiles.schema["image_id"].dataType.simpleString()

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded = _loaded(held)
        for part in batches:
            if not len(part):
                continue
            x = _stacked(part["features"])
            groups = part.groupby(["image_id", "cluster"], dropna=False, sort=False)
            which, first = groups.ngroup().to_numpy(), groups.head(1)
            size = np.bincount(which)
            for fold, m in loaded.items():
                s = m.logits(x)[0]
                share = x @ m.c.reshape(s.shape[1], -1).T
                top = np.full((size.size, s.shape[1]), -np.inf)
                np.maximum.at(top, which, s)
                e = np.exp(s - top[which])
                for k in range(s.shape[1]):
                    yield pd.DataFrame({"image_id": first["image_id"].to_numpy(), "cluster": first["cluster"].to_numpy(), "fold": fold, "branch": k, "n": size, "top": top[:, k], "e": np.bincount(which, e[:, k]), "es": np.bincount(which, e[:, k] * share[:, k]), "bias": m.b[0]})

    rows = tiles.where("features is not null").select("image_id", F.col("cluster").cast("string").alias("cluster"), "features")
    made = rows.mapInPandas(parts, f"image_id {kind}, cluster string, fold int, branch int, n long, top double, e double, es double, bias double")
    whole = made.withColumn("_top", F.max("top").over(Window.partitionBy("image_id", "cluster", "fold", "branch")))
    factor = F.exp(F.col("top") - F.col("_top"))
    return whole.groupBy("image_id", "cluster", "fold", "branch").agg(F.sum("n").alias("n"), F.max("_top").alias("top"), F.sum(F.col("e") * factor).alias("e"), F.sum(F.col("es") * factor).alias("es"), F.max("bias").alias("bias"))


def _bag_sums(tiles: DataFrame, held: dict[int, bytes]) -> DataFrame:
    """(image_id, fold, branches, z): of each bag and model the branches' (top, e, m) in order, where m
    is the attention-weighted mean share, and the score before the logistic function."""
    sums = _sums(tiles.select("image_id", "features", F.lit("").alias("cluster")), held)
    m = (F.col("es") / F.col("e")).alias("m")
    bags = sums.groupBy("image_id", "fold").agg(F.array_sort(F.collect_list(F.struct("branch", "top", "e", m))).alias("branches"), (F.sum(m) + F.max("bias")).alias("z"))
    return bags


def _risk(z: Column) -> Column:
    return (1 / (1 + F.exp(-z))).alias("risk_score")


def score(tiles: DataFrame, models: DataFrame) -> DataFrame:
    """(image_id, fold, risk_score) of every image by every fold's model."""
    held = {r["fold"]: bytes(r["model"]) for r in models.collect()}
    return _bag_sums(tiles, held).select("image_id", "fold", _risk(F.col("z")))


def _with_bags(tiles: DataFrame, bags: DataFrame) -> DataFrame:
    """Tiles (image_id, ..., features) with ``folds``: what ``bags`` (image_id, fold, branches, ...) say of their image."""
    names = [c for c in bags.columns if c != "image_id"]
    per = bags.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("folds"))
    per = staged(per)
    return tiles.where("features is not null").join(F.broadcast(per) if per.count() <= MOST_BAGS else per.hint("merge"), "image_id")


class _Bag:
    """The sums of the bags of a batch's rows that one fold has a part in."""

    def __init__(self, part: pd.DataFrame, fold: int):
        own = [next((f for f in folds if f["fold"] == fold), None) for folds in part["folds"]]
        self.rows = np.flatnonzero([f is not None for f in own])
        own = [f for f in own if f is not None]
        self.numbers = {name: np.array([[b[name] for b in f["branches"]] for f in own], float) for name in ("top", "e", "m")}
        self.slope = np.array([f["dz"] if "dz" in f else 1.0 for f in own], float)

    def attention(self, s: np.ndarray) -> np.ndarray:
        return np.exp(s[self.rows] - self.numbers["top"]) / self.numbers["e"]


def _gradients(tiles: DataFrame, bags: DataFrame, held: dict[int, bytes]) -> dict[int, dict[str, np.ndarray]]:
    """Each fold's sum of gradients over ``bags`` (image_id, fold, branches, dz)."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded, total = _loaded(held), {}
        for part in batches:
            if not len(part):
                continue
            every = _stacked(part["features"])
            for fold, m in loaded.items():
                bag = _Bag(part, fold)
                if not bag.rows.size:
                    continue
                x = every[bag.rows]
                s, t, g = m.logits(x)
                a = np.exp(s - bag.numbers["top"]) / bag.numbers["e"]
                dz = bag.slope[:, None]
                ds = dz * a * (x @ m.c.reshape(s.shape[1], -1).T - bag.numbers["m"])
                dh = ds[:, :, None] * m.w
                dt, dg = dh * g * (1 - t * t), dh * t * g * (1 - g)
                grad = [np.einsum("nkh,nd->khd", dt, x), np.einsum("nkh,nd->khd", dg, x), np.einsum("nk,nkh->kh", ds, t * g), (dz * a).T @ x]
                flat = np.concatenate([v.ravel() for v in grad])
                total[fold] = total.get(fold, 0) + flat
        for fold, flat in total.items():
            cuts = range(0, flat.size, CHUNK)
            yield pd.DataFrame({"fold": fold, "chunk": [i // CHUNK for i in cuts], "values": [flat[i : i + CHUNK] for i in cuts]})

    rows = _with_bags(tiles.select("image_id", "features"), bags).select("features", "folds").mapInPandas(parts, "fold int, chunk int, values array<double>")
    sums = rows.groupBy("fold", "chunk").agg(vector_to_array(Summarizer.sum(array_to_vector("values"))).alias("values"))
    bias = {r["fold"]: r["b"] for r in bags.groupBy("fold").agg(F.sum("dz").alias("b")).collect()}
    flat: dict[int, dict[int, list[float]]] = {}
    for r in sums.collect():  # as many numbers as the models have
        flat.setdefault(r["fold"], {})[r["chunk"]] = r["values"]
    out = {}
    for fold, chunks in flat.items():
        numbers, model, at = np.concatenate([chunks[i] for i in sorted(chunks)]), Pooling.load(held[fold]), 0
        out[fold] = {"b": np.array([bias[fold]])}
        for name in ("v", "u", "w", "c"):
            shape = getattr(model, name).shape
            out[fold][name] = numbers[at : at + math.prod(shape)].reshape(shape)
            at += math.prod(shape)
    return out


def train(tiles: DataFrame, labels: DataFrame, splits: DataFrame, label: str, branches: int = 2, hidden: int = 16, epochs: int = 20, rate: float = 0.05, seed: int = 0, patience: int = 5) -> DataFrame:
    """(fold, model, epoch, auprc): a model for each fold, all trained together on ``train`` images.

    An epoch is one step of Adam on the mean gradient over a fold's bags, classes weighted by
    n / (2 n_class). Where a fold has ``val`` images, the weights with the best average precision on
    them win, and the fold ends once ``patience`` epochs brought none better; else the last win.
    ``tiles``: (image_id, tile_id, features), foreground only. Splits of ``test`` are not looked at.
    """
    tiles = staged(tiles.where("features is not null").select("image_id", "features"))
    y = labels.where(F.col(label).isNotNull()).select("image_id", F.col(label).cast("int").alias("y"))
    wrong = y.where("y not in (0, 1)").select("y").first()
    if wrong:
        raise ValueError(f"{label} must be 0 or 1, not {wrong['y']}")
    known = splits.where("split in ('train', 'val')").select("image_id", "fold", "split").join(y, "image_id").join(tiles.select("image_id").distinct(), "image_id", "left_semi")
    counts = {(r["fold"], r["split"], r["y"]): r["count"] for r in known.groupBy("fold", "split", "y").count().collect()}
    folds = sorted({f for f, split, _ in counts if split == "train"})
    if not folds:
        raise ValueError("no train image has tiles and a label")
    n = {f: sum(c for (g, split, _), c in counts.items() if (g, split) == (f, "train")) for f in folds}
    weights = [(f, v, n[f] / (2.0 * c)) for (f, split, v), c in counts.items() if split == "train"]
    weight = tiles.sparkSession.createDataFrame(weights, "fold int, y int, weight double")
    known = staged(known.where(F.col("fold").isin(folds)).join(F.broadcast(weight), ["fold", "y"], "left"))
    judged = {f for f, split, v in counts if split == "val" and v == 1 and f in n}

    d = tiles.select(F.size("features").alias("d")).first()["d"]
    running = {f: Adam(Pooling.new(d, branches, hidden, seed), rate) for f in folds}
    best = {f: (-1.0, 0, running[f].model) for f in folds}
    for epoch in range(epochs + 1):
        held = {f: a.model.dump() for f, a in running.items()}
        sums = staged(_bag_sums(tiles, held).join(known, ["image_id", "fold"]))
        if epoch and judged & set(running):
            val = sums.where("split = 'val'").select("fold", "y", "z")
            for r in stats.average_precision(val, "z", "y", ["fold"]).collect():
                if r["average_precision"] is not None and r["fold"] in running and r["average_precision"] > best[r["fold"]][0]:
                    best[r["fold"]] = r["average_precision"], epoch, running[r["fold"]].model
        for f in list(running):
            if f not in judged:
                best[f] = None, epoch, running[f].model
            elif epoch - best[f][1] >= patience:
                del running[f]
        if epoch == epochs or not running:
            break
        p = 1 / (1 + F.exp(-F.col("z")))
        bags = sums.where((F.col("split") == "train") & F.col("fold").isin(list(running))).select("image_id", "fold", "branches", (F.col("weight") * (p - F.col("y"))).alias("dz"))
        for f, grad in _gradients(tiles, bags, {f: held[f] for f in running}).items():
            running[f].move({k: g / n[f] for k, g in grad.items()})
    rows = [(f, bytearray(m.dump()), e, v) for f, (v, e, m) in best.items()]
    return tiles.sparkSession.createDataFrame(rows, "fold int, model binary, epoch int, auprc double")


def attributions(tiles: DataFrame, models: DataFrame) -> DataFrame:
    """(image_id, tile_id, fold, attention, gradient) of every tile by every fold's model.

    ``attention`` is the mean of the branches' attention, weighted by the length of the score's
    gradient in each branch's vector; ``gradient`` is the derivative of the score before the logistic
    function by a factor on the tile's features. It takes the sums of the tile's bag, as training does.
    """
    held = {r["fold"]: bytes(r["model"]) for r in models.collect()}
    kinds = {c: tiles.schema[c].dataType.simpleString() for c in ("image_id", "tile_id")}

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded = _loaded(held)
        for part in batches:
            if not len(part):
                continue
            x = _stacked(part["features"])
            for fold, m in loaded.items():
                bag = _Bag(part, fold)
                s, t, g = m.logits(x)
                a = bag.attention(s)
                c = m.c.reshape(s.shape[1], -1)
                share = x @ c.T
                # derivative of each logit by a factor on the tile: t and g as functions of it
                vx, ux = np.einsum("khd,nd->nkh", m.v, x), np.einsum("khd,nd->nkh", m.u, x)
                q = np.einsum("kh,nkh->nk", m.w, g * (1 - t * t) * vx + t * g * (1 - g) * ux)
                length = np.linalg.norm(c, axis=1)
                yield pd.DataFrame({"image_id": part["image_id"], "tile_id": part["tile_id"], "fold": fold, "attention": a @ (length / (length.sum() + 1e-8)), "gradient": (a * (share + (share - bag.numbers["m"]) * q)).sum(1)})

    rows = _with_bags(tiles.select("image_id", "tile_id", "features"), _bag_sums(tiles, held).select("image_id", "fold", "branches"))
    return rows.mapInPandas(parts, f"image_id {kinds['image_id']}, tile_id {kinds['tile_id']}, fold int, attention double, gradient double")


def marginals(tiles: DataFrame, models: DataFrame, least: float = 0.01) -> DataFrame:
    """What each cluster adds to each image's score, by each fold's model: the score of all tiles
    less that of the tiles outside the cluster.

    A score follows from sums over tiles, so the rest of a bag is the sum over its other clusters,
    from the greatest logit among those; nothing is subtracted, and no bag is scored again. An image's
    clusters, which are few, meet in an array. Tiles without a cluster (null) stay in every bag.
    Clusters under ``least`` of the image's tiles, and clusters that are all of them, have no row.
    """
    sums = branch_sums(tiles, models)
    own = F.struct("cluster", "n", "top", "e", "es")
    bags = sums.groupBy("image_id", "fold", "branch").agg(F.collect_list(own).alias("all"), F.sum("n").alias("_n"), F.max("bias").alias("bias"))

    def mean(parts: Column) -> Column:
        top = F.array_max(F.transform(parts, lambda c: c["top"]))
        part = lambda name: F.aggregate(parts, F.lit(0.0), lambda total, c: total + c[name] * F.exp(c["top"] - top))
        return F.try_divide(part("es"), part("e"))

    each = bags.select("*", mean(F.col("all")).alias("_all"), F.explode("all").alias("own")).where("own.cluster is not null")
    each = each.where((F.col("own.n") < F.col("_n")) & (F.col("own.n") >= F.col("_n") * least))
    others = F.filter("all", lambda c: ~c["cluster"].eqNullSafe(F.col("own.cluster")))
    each = each.select("image_id", "fold", F.col("own.cluster").alias("cluster"), F.col("own.n").alias("n"), "_n", "bias", "_all", mean(others).alias("_rest"))
    z = lambda c: F.sum(c) + F.max("bias")
    rows = each.groupBy("image_id", "cluster", "fold").agg(F.max("n").alias("n_removed"), F.max("_n").alias("n_tiles"), z("_all").alias("_all"), z("_rest").alias("_rest"))
    full, without = (1 / (1 + F.exp(-F.col(c))) for c in ("_all", "_rest"))
    return rows.select("image_id", "cluster", "fold", "n_removed", "n_tiles", full.alias("p_full"), without.alias("p_without"), (full - without).alias("delta_p"))
