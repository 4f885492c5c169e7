"""Outcome models on image vectors: five kinds of classifier, fitted fold by fold.

Training runs in Spark's own learners, which pass over the distributed rows; the driver holds the
models alone. Loops over folds and kinds are loops over settings.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import folds
from tessera.operators.stats import auroc
from tessera.sources.storage import staged

LINEAR = {"logreg_l2": 0.0, "elasticnet": 0.5, "logreg_l1": 1.0}
KINDS = (*LINEAR, "random_forest", "gradient_boosting")


def moments(rows: DataFrame, column: str = "features") -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation of each dimension; 1 for a deviation of 0."""
    v = Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(F.col(column).cast("array<double>")))
    got = rows.select(v.alias("s")).select("s.mean", "s.variance", "s.count").first()
    spread = np.sqrt(got["variance"].toArray() * max(got["count"] - 1, 0) / max(got["count"], 1))
    return got["mean"].toArray(), np.where(spread > 0, spread, 1.0)


def scaled(column: str, mean: np.ndarray, std: np.ndarray) -> Column:
    pair = F.lit([float(x) for x in mean]), F.lit([float(x) for x in std])
    zipped = F.arrays_zip(F.col(column).alias("x"), pair[0].alias("m"), pair[1].alias("s"))
    return F.transform(zipped, lambda z: (z["x"].cast("double") - z["m"]) / z["s"])


def learner(kind: str, n: int, c: float, trees: int, rounds: int, seed: int):
    """An unfitted classifier. A linear one's strength ``c`` is per summed loss, Spark's per mean
    loss, hence 1 / (c n). Boosting takes no class weights."""
    names = {"featuresCol": "_v", "labelCol": "_y"}
    if kind in LINEAR:
        return LogisticRegression(**names, weightCol="_w", regParam=1 / (c * max(n, 1)), elasticNetParam=LINEAR[kind], maxIter=200, tol=1e-7, standardization=False)
    if kind == "random_forest":
        return RandomForestClassifier(**names, weightCol="_w", numTrees=trees, minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=seed)
    if kind == "gradient_boosting":
        return GBTClassifier(**names, maxIter=rounds, maxDepth=3, stepSize=0.05, subsamplingRate=0.8, seed=seed)
    raise ValueError(f"kind must be one of {KINDS}")


def fit(rows: DataFrame, label: str, kind: str, column: str = "features", c: float = 1.0, trees: int = 500, rounds: int = 300, seed: int = 0) -> tuple[Model, tuple[np.ndarray, np.ndarray] | None]:
    """A classifier with classes weighed by n / (2 n_class), and the scale of linear kinds.

    Trees don't depend on scale and have none. Rows without a label don't count.
    """
    known = rows.where(F.col(label).isNotNull())
    per = {r[label]: (r["n"], r["weight"]) for r in folds.class_weights(known, label).collect()}
    if wrong := sorted(set(per) - {0, 1}):
        raise ValueError(f"{label} must be 0 or 1, not {wrong[0]}")
    if len(per) < 2:
        raise ValueError(f"{label} has one class")
    scale = moments(known, column) if kind in LINEAR else None
    vector = scaled(column, *scale) if scale else F.col(column).cast("array<double>")
    weight = F.when(F.col(label) == 1, per[1][1]).otherwise(per[0][1])
    table = known.select(array_to_vector(vector).alias("_v"), F.col(label).cast("double").alias("_y"), weight.alias("_w"))
    return learner(kind, sum(n for n, _ in per.values()), c, trees, rounds, seed).fit(table), scale


def probability(rows: DataFrame, model: Model, scale: tuple[np.ndarray, np.ndarray] | None, column: str = "features", name: str = "risk_score") -> DataFrame:
    """Rows with the probability of class 1."""
    vector = scaled(column, *scale) if scale else F.col(column).cast("array<double>")
    out = model.transform(rows.withColumn("_v", array_to_vector(vector)))
    return out.select(*rows.columns, F.element_at(vector_to_array("probability"), 2).alias(name))


def fold_scores(vectors: DataFrame, labels: DataFrame, splits: DataFrame, n_folds: int, label: str, kind: str, **settings) -> DataFrame:
    """(image_id, fold, risk_score): every image scored by the model of each fold, which is fitted
    on the fold's train images. ``folds.out_of_fold`` and ``folds.ensemble`` reduce it."""
    vectors = vectors.select("image_id", "features")
    known = vectors.join(labels.where(F.col(label).isNotNull()).select("image_id", label), "image_id").join(splits.where("split = 'train'").select("image_id", "fold"), "image_id")
    known = staged(known)
    scored = []
    for fold in range(n_folds):
        model, scale = fit(known.where(F.col("fold") == fold), label, kind, **settings)
        scored.append(probability(vectors, model, scale).select("image_id", F.lit(fold).alias("fold"), "risk_score"))
    out = scored[0]
    for more in scored[1:]:
        out = out.unionByName(more)
    return out


def choose_strength(rows: DataFrame, label: str, grid: Sequence[float], fold: str = "fold", kind: str = "logreg_l2") -> float:
    """The strength of the greatest mean AUROC over held-out folds; the smallest of equals.

    Folds that lack a class on either side are left out; without any other fold the smallest strength wins.
    """
    counts = {(r[fold], r[label]): r["count"] for r in rows.where(F.col(label).isNotNull()).groupBy(fold, label).count().collect()}
    of = lambda keep: {y for (f, y) in counts if keep(f)}
    values = [v for v in sorted({f for f, _ in counts}) if len(of(lambda f: f == v)) == 2 and len(of(lambda f: f != v)) == 2]  # noqa: B023
    if not values:
        return min(grid)
    best: list[tuple[float, float]] = []
    for c in sorted(grid):
        parts = []
        for f in values:
            model, scale = fit(rows.where(F.col(fold) != f), label, kind, c=c)
            parts.append(probability(rows.where(F.col(fold) == f), model, scale).select(label, "risk_score", F.lit(f).alias("f")))
        every = functools.reduce(DataFrame.unionByName, parts)
        best.append((-auroc(every, "risk_score", label, ["f"]).agg(F.avg("auroc")).first()[0], c))
    return min(best)[1]


def coefficients(model: Model, names: Sequence[str]) -> list[tuple[str, float, float]]:
    """(name, coefficient, odds ratio) of a linear model, the intercept last."""
    weights = [*model.coefficients.toArray().tolist(), float(model.intercept)]
    return [(n, w, float(np.exp(w))) for n, w in zip([*names, "intercept"], weights, strict=True)]


def evaluated(train: DataFrame, external: DataFrame, label: str, cohort: str, grid: Sequence[float], fold: str = "fold") -> DataFrame:
    """(cohort, n0, n1, auroc) of a logistic model fitted on ``train``, with the strength chosen over
    its folds, on the training cohort and on each external one."""
    c = choose_strength(train, label, grid, fold)
    model, scale = fit(train, label, "logreg_l2", c=c)
    columns = ["image_id", "features", label, cohort]
    scored = probability(train.select(*columns).unionByName(external.select(*columns)), model, scale)
    return auroc(scored, "risk_score", label, [cohort])
