"""Concept probes: bootstrapped linear models from image vectors to readable labels."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.operators.stats import POISSON
from tessera.sources.storage import staged

#: Categories that a column may have, one probe for each.
MOST_CATEGORIES = 1_000
#: Sums of a pass, or weights of a block of models, that a task holds at a time; and passes of Newton's method at most.
MOST_NUMBERS, NEWTON = 1 << 22, 50


def plan(labels: DataFrame, columns: Sequence[str]) -> list[tuple[str, str, object]]:
    """(name, column, category or None): a ridge probe for numbers with more than two values, one
    logistic probe for two values, and one for each category beyond two. Constant columns have none;
    more than ``MOST_CATEGORIES`` categories are an error."""
    out: list[tuple[str, str, object]] = []
    for c in columns:
        values = sorted((r[0] for r in labels.where(F.col(c).isNotNull()).select(c).distinct().limit(MOST_CATEGORIES + 1).collect()), key=str)
        if len(values) < 2:
            continue
        if len(values) == 2:
            out.append((c, c, values[1]))
        elif isinstance(labels.schema[c].dataType, NumericType):
            out.append((c, c, None))
        elif len(values) > MOST_CATEGORIES:
            raise ValueError(f"{c} has more than {MOST_CATEGORIES} categories")
        else:
            out += [(f"{c}: {v}", c, v) for v in values]
    return out


def ridge(x: np.ndarray, y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Weights with the intercept first, which is not shrunk."""
    z = np.column_stack([np.ones(len(x)), x])
    penalty = alpha * np.eye(z.shape[1])
    penalty[0, 0] = 0
    return np.linalg.lstsq(z.T @ z + penalty, z.T @ y, rcond=None)[0]


def logistic(x: np.ndarray, y: np.ndarray, c: float = 1.0) -> np.ndarray:
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    penalty = np.eye(z.shape[1]) / c
    penalty[0, 0] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def resamples(replicas: int, seed: int) -> Column:
    """How often a row is in each resample: Poisson draws of mean 1, from 32 bits of a digest of the
    row's id that serves four resamples. A row knows its draws, so resampling moves no rows."""
    digests = F.transform(F.sequence(F.lit(0), F.lit((replicas - 1) // 4)), lambda four: F.md5(F.concat_ws(":", F.col("image_id").cast("string"), four.cast("string"), F.lit(str(seed)))))
    limits = F.array(*[F.lit(f"{math.ceil(e * (1 << 32)):08x}") for e in POISSON])
    bits = F.flatten(F.transform(digests, lambda d: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.substring(d, i * 8 + 1, 8))))
    times = F.transform(bits, lambda u: F.size(F.filter(limits, lambda e: u >= e)))
    return F.slice(times, 1, replicas)


def _moment_size(d: int) -> int:
    return d * (d + 1) // 2 + d


def _passed(rows: DataFrame, models: list[tuple[int, int, bool, bool]], weights: np.ndarray) -> dict[int, np.ndarray]:
    """One Newton step of each model (probe, replica, logistic?, all rows?), from ``weights``.

    A pass adds up, for each model, the products of the vectors' columns and the slope; each task adds
    up its own first. Sums of a model meet in one row, where its equations are solved; the driver gets weights.
    """
    d = weights.shape[1]
    upper = np.triu_indices(d)
    shared = rows.sparkSession.sparkContext.broadcast((models, weights))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, w = shared.value
        total = np.zeros((len(own), _moment_size(d)))
        for part in batches:
            if not len(part):
                continue
            z = np.column_stack([np.ones(len(part)), np.stack(part["embedding"].to_numpy()).astype(float)])
            target, times = np.stack(part["y"].to_numpy()).astype(float), np.stack(part["times"].to_numpy()).astype(float)
            linear = z @ w.T
            for m, (probe, replica, is_logistic, whole) in enumerate(own):
                y = target[:, probe]
                count = np.where(np.isnan(y), 0.0, 1.0 if whole else times[:, replica])
                some = np.flatnonzero(count)
                if not some.size:
                    continue
                x, n, e = z[some], count[some], y[some] - linear[some, m]
                curve = n
                if is_logistic:
                    p = 1 / (1 + np.exp(-np.clip(linear[some, m], -30, 30)))
                    e, curve = y[some] - p, n * p * (1 - p)
                total[m] += np.concatenate([((x * curve[:, None]).T @ x)[upper], x.T @ (n * e)])
        hit = np.flatnonzero(np.abs(total).sum(1))
        if hit.size:  # Arrow takes no column of arrays without rows
            yield pd.DataFrame({"model": hit, "values": list(total[hit])})

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, w = shared.value
        for part in batches:
            if not len(part):
                continue
            out = []
            for m, values in zip(part["model"], part["values"], strict=True):
                products, slope = np.zeros((d, d)), np.asarray(values[-d:])
                products[upper] = values[:-d]
                products += np.triu(products, 1).T
                penalty = np.full(d, 1.0)
                penalty[0] = 1e-9 if own[m][2] else 0.0
                out.append(w[m] + np.linalg.lstsq(products + np.diag(penalty), slope - penalty * w[m], rcond=None)[0])
            yield pd.DataFrame({"model": part["model"], "weights": out})

    made = rows.mapInPandas(sums, "model int, values array<double>").groupBy("model").agg(vector_to_array(Summarizer.sum(array_to_vector("values"))).alias("values"))
    return {r["model"]: np.array(r["weights"]) for r in made.mapInPandas(steps, "model int, weights array<double>").collect()}


def fit(vectors: DataFrame, labels: DataFrame, columns: Sequence[str], replicas: int = 100, seed: int = 0) -> DataFrame:
    """(concept, replica, kind, weights): a model for each probe and resample, the intercept first.

    All models are fitted together, by passes over the vectors: a ridge in one, a logistic model by
    Newton's method in as many as it takes. At most ``MOST_NUMBERS`` sums are held at a time, so wide
    vectors take more passes of fewer models. A resample that lacks a class is replaced by the full
    sample. Rows without a vector, and a probe's rows without a label, do not count.
    """
    spark = vectors.sparkSession
    kinds = "concept string, replica int, kind string, weights array<double>"
    probes = plan(labels, columns)
    if not probes:
        return spark.createDataFrame([], kinds)
    target = [F.col(c).cast("double") if v is None else F.when(F.col(c).isNotNull(), (F.col(c) == F.lit(v)).cast("double")) for _, c, v in probes]
    joined = vectors.where("embedding is not null").select("image_id", "embedding").join(labels, "image_id")
    rows = staged(joined.select("embedding", F.array(*[F.coalesce(t, F.lit(float("nan"))) for t in target]).alias("y"), resamples(replicas, seed).alias("times")))
    first = rows.select(F.size("embedding").alias("d")).first()
    if first is None:
        return spark.createDataFrame([], kinds)
    d = first["d"] + 1

    # sizes of the classes in each resample, to find those that lack one
    each = rows.select(F.posexplode("y").alias("probe", "y"), "times").where(~F.isnan("y")).select("probe", "y", F.posexplode("times").alias("replica", "n"))
    logistic_probes = [p for p, (_, _, v) in enumerate(probes) if v is not None]
    per = each.where(F.col("probe").isin(logistic_probes) & (F.col("n") > 0)).groupBy("probe", "replica").agg(F.count_distinct("y").alias("classes"))
    both = {(r["probe"], r["replica"]) for r in per.where("classes = 2").collect()}
    models = [(p, r, p in logistic_probes, p in logistic_probes and (p, r) not in both) for p in range(len(probes)) for r in range(replicas)]

    out = []
    size = max(1, MOST_NUMBERS // _moment_size(d))
    for at in range(0, len(models), size):
        left, weights = list(range(at, min(at + size, len(models)))), np.zeros((len(models), d))
        for _ in range(NEWTON):
            found = _passed(rows, [models[m] for m in left], weights[left])
            moved = []
            for i, m in enumerate(left):
                new = found.get(i, weights[m])
                if models[m][2] and np.abs(new - weights[m]).max() >= 1e-9:
                    moved.append(m)
                weights[m] = new
            left = moved
            if not left:
                break
        out += [(probes[p][0], r, "logistic" if is_logistic else "ridge", weights[m].tolist()) for m, (p, r, is_logistic, _) in enumerate(models[at : at + size], at)]
    return spark.createDataFrame(out, kinds)


def predict(vectors: DataFrame, models: DataFrame) -> DataFrame:
    """(image_id, concept, value, std): mean and deviation over the replicas.

    Models are taken in blocks of concepts with at most ``MOST_NUMBERS`` weights, and a row of an
    image leaves a batch for each concept, not for each model.
    """
    kind = vectors.schema["image_id"].dataType.simpleString()
    held: dict[str, list] = {}
    for r in models.collect():
        held.setdefault(r["concept"], []).append(r)
    blocks, n = [[]], 0
    for concept, own in sorted(held.items()):
        numbers = sum(len(r["weights"]) for r in own)
        if blocks[-1] and n + numbers > MOST_NUMBERS:
            blocks.append([])
            n = 0
        n += numbers
        blocks[-1].append((concept, np.array([r["weights"] for r in own]), own[0]["kind"] == "logistic"))

    def scored(block: list[tuple[str, np.ndarray, bool]]) -> DataFrame:
        shared = vectors.sparkSession.sparkContext.broadcast(block)

        def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                if not len(part):
                    continue
                x = np.stack(part["embedding"].to_numpy()).astype(float)
                for concept, w, is_logistic in shared.value:
                    v = x @ w[:, 1:].T + w[:, 0]
                    v = 1 / (1 + np.exp(-v)) if is_logistic else v
                    yield pd.DataFrame({"image_id": part["image_id"], "concept": concept, "value": v.mean(1), "std": v.std(1)})

        return vectors.where("embedding is not null").select("image_id", "embedding").mapInPandas(parts, f"image_id {kind}, concept string, value double, std double")

    return functools.reduce(DataFrame.unionByName, map(scored, blocks))


def shared_out(predictions: DataFrame, temperature: float = 0.1) -> DataFrame:
    """Probes of one column's categories as probabilities that sum to 1; deviations stay."""
    column = F.substring_index("concept", ": ", 1)
    rows = predictions.withColumn("_of", column)
    e = F.exp((F.col("value") - F.col("_top")) / temperature)
    top = rows.groupBy("image_id", "_of").agg(F.max("value").alias("_top"), F.count(F.lit(1)).alias("_n"))
    both = rows.join(top, ["image_id", "_of"]).withColumn("_e", e)
    total = both.groupBy("image_id", "_of").agg(F.sum("_e").alias("_all"))
    return both.join(total, ["image_id", "_of"]).select("image_id", "concept", F.when(F.col("_n") > 1, F.col("_e") / F.col("_all")).otherwise(F.col("value")).alias("value"), "std")
