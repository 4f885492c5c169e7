"""Concept bottleneck: risk as a sparse function of concepts plus a residual of the embedding.

Both regressions need only sums of products, so each costs one pass: a task adds up its rows'
products fold by fold, the sums of a fold are added, and strengths, folds and cross-fits are all
settled on those few small matrices. Folds are given as a column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RIDGE_GRID = (0.1, 1.0, 10.0)
LASSO_STEPS, LASSO_RANGE = 100, 1e-3


@dataclass
class Bottleneck:
    """Weights with the intercept first, in the units of the given columns."""

    concepts: np.ndarray
    residual: np.ndarray
    held_out: dict[int, np.ndarray]


def product_sums(rows: DataFrame, column: str, target: str, fold: str) -> dict[int, np.ndarray]:
    """For each fold the sums of products of (1, x, y). Rows without a finite target don't count."""
    good = rows.where(F.col(target).isNotNull() & ~F.isnan(target) & (F.abs(target) < float("inf")))
    z = F.concat(F.array(F.lit(1.0)), F.col(column).cast("array<double>"), F.array(F.col(target).cast("double")))

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for part in batches:
            for f, group in part.groupby("f"):
                m = np.stack(group["z"].to_numpy())
                sums[f] = sums.get(f, 0) + m.T @ m
        if sums:
            yield pd.DataFrame({"f": list(sums), "sums": [m.ravel() for m in sums.values()]})

    each = good.select(F.col(fold).cast("int").alias("f"), z.alias("z")).mapInPandas(parts, "f int, sums array<double>")
    whole = each.groupBy("f").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect()
    out = {}
    for r in whole:
        flat = r["sums"].toArray()
        side = int(round(np.sqrt(flat.size)))
        out[r["f"]] = flat.reshape(side, side)
    return out


def _standard(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = total[0, 1:-1] / total[0, 0]
    var = np.diag(total)[1:-1] / total[0, 0] - mean**2
    return mean, np.where(var > 1e-12 * np.maximum(mean**2, 1), np.sqrt(np.maximum(var, 0)), 1.0)


def _rescaled(sums: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """The sums that standardised columns would give."""
    t = np.eye(len(sums))
    t[1:-1, 0] = -mean / std
    t[1:-1, 1:-1] = np.diag(1 / std)
    return t @ sums @ t.T


def _centred(g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    n, m = g[0, 0], g[0, 1:-1] / g[0, 0]
    y = g[0, -1] / n
    return g[1:-1, 1:-1] / n - np.outer(m, m), g[1:-1, -1] / n - m * y, m, y


def lasso(g: np.ndarray, alphas: np.ndarray) -> list[np.ndarray]:
    """Weights for each of the falling ``alphas`` by coordinate descent on the products."""
    s, b, mean, y = _centred(g)
    w, out = np.zeros(len(b)), []
    for a in alphas:
        for _ in range(10_000):
            most = 0.0
            for j in np.flatnonzero(np.diag(s) > 1e-12):
                pull = b[j] - s[j] @ w + s[j, j] * w[j]
                new = np.sign(pull) * max(abs(pull) - a, 0) / s[j, j]
                most = max(most, abs(new - w[j]))
                w[j] = new
            if most < 1e-9:
                break
        out.append(np.concatenate([[y - mean @ w], w]))
    return out


def ridge(g: np.ndarray, alphas: np.ndarray) -> list[np.ndarray]:
    s, b, mean, y = _centred(g)
    solved = [np.linalg.lstsq(s + a / g[0, 0] * np.eye(len(b)), b, rcond=None)[0] for a in alphas]
    return [np.concatenate([[y - mean @ w], w]) for w in solved]


def squared_error(g: np.ndarray, w: np.ndarray) -> float:
    v = np.concatenate([-w, [1.0]])
    return float(v @ g @ v / g[0, 0])


def chosen(parts: dict[int, np.ndarray], solve, alphas: np.ndarray) -> np.ndarray:
    """Weights on all folds at the strength of least mean squared error over held-out folds."""
    total = sum(parts.values())
    if len(parts) < 2:
        return solve(total, alphas)[0]
    errors = np.mean([[squared_error(g, w) for w in solve(total - g, alphas)] for g in parts.values()], axis=0)
    best = int(np.argmin(errors))
    return solve(total, alphas[: best + 1])[best]


def _lasso_grid(g: np.ndarray) -> np.ndarray:
    top = np.abs(_centred(g)[1]).max(initial=0) or 1.0
    return top * np.logspace(0, np.log10(LASSO_RANGE), LASSO_STEPS)


def _unscaled(w: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    return np.concatenate([[w[0] - (w[1:] * mean / std).sum()], w[1:] / std])


def linear(weights: np.ndarray, column: str) -> Column:
    pairs = F.zip_with(column, F.lit([float(x) for x in weights[1:]]), lambda a, b: a.cast("double") * b)
    return F.lit(float(weights[0])) + F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def fit(rows: DataFrame, concepts: str, embedding: str, risk: str, fold: str = "fold") -> Bottleneck:
    """Fit on rows with arrays of concepts and embedding, a risk, and a fold from 0.

    Concepts are standardised over all rows, the lasso's strength is chosen over the folds, and
    each fold's concept risk for the residual comes from a lasso fitted, strength included, on the
    others. The ridge of the residual on the embedding is standardised and chosen likewise.
    """
    sums = product_sums(rows, concepts, risk, fold)
    total = sum(sums.values()) if sums else np.zeros((0, 0))
    if not sums or total[0, 0] < 2:
        raise ValueError("at least two rows with a finite risk are needed")
    mean, std = _standard(total)
    parts = {f: _rescaled(g, mean, std) for f, g in sums.items()}
    whole = sum(parts.values())
    weights = _unscaled(chosen(parts, lasso, _lasso_grid(whole)), mean, std)
    held_out = {}
    for f in parts:
        others = {k: g for k, g in parts.items() if k != f}
        enough = others and sum(g[0, 0] for g in others.values()) >= 2
        held_out[f] = _unscaled(chosen(others, lasso, _lasso_grid(sum(others.values()))), mean, std) if enough else weights
    cross = F.lit(None).cast("double")
    for f, w in held_out.items():
        cross = F.when(F.col(fold) == f, linear(w, concepts)).otherwise(cross)
    left = rows.select(embedding, fold, (F.col(risk) - cross).alias("_left"))
    sums = product_sums(left, embedding, "_left", fold)
    mean, std = _standard(sum(sums.values()))
    grid = np.array(sorted(RIDGE_GRID, reverse=True))
    residual = _unscaled(chosen({f: _rescaled(g, mean, std) for f, g in sums.items()}, ridge, grid), mean, std)
    return Bottleneck(weights, residual, held_out)


def predict(rows: DataFrame, model: Bottleneck, concepts: str, embedding: str) -> DataFrame:
    """Rows with the concepts' risk, the embedding's residual, and their sum."""
    parts = rows.withColumns({"concept_risk_score": linear(model.concepts, concepts), "concept_risk_score_residual": linear(model.residual, embedding)})
    return parts.withColumn("risk_score", F.col("concept_risk_score") + F.col("concept_risk_score_residual"))
