"""Quality classifier with hierarchical empirical Bayes over sites.

A document's own evidence is the log-odds of a logistic model over surface features, fitted on all
labelled documents at even prior odds: each of Newton's steps is a pass over them, in which tasks add up
gradients and products, Spark sums those of all tasks, and the driver holds weights alone. Sites then say how likely good documents
are where it came from: the expected number of good documents of each host is shrunk towards the
global rate, that of each path of a host towards the host's posterior. How strongly is estimated
from the spread of the groups' rates, so that sparse sites fall back on what is above them. The
posterior log-odds of a document are its evidence plus the log-odds of its path, from which the
document itself is left out. What a path says is bounded to a third of what a document can say, so
that bad documents can be told inside sites where nearly all are good, and the reverse.

Documents stay from a posterior on that costs the labelled documents least: the share of the good
ones that go and that of the bad ones that stay, by ``COSTS``. They are those of the fit, all of them,
in one order; a dozen weights and a threshold leave little room to fit them by chance, unless there are
only a few.

Group sums are formed before the shuffle; sums come back by a join on the group, in which Spark
splits a hot host. Null text counts as empty; a null host or path is a group of its own; null
labels are not used. If the labelled documents lack a class, all evidence is 0 and every document is kept.
Repeated rows are judged alike, an empty table gives an empty result, and columns beyond those
named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import bounded, staged, superseded
from tessera.operators.ordered import running_sums

#: Bounds for the log-odds of a document's evidence and of its site, the smaller by far.
BOUND, SITE_BOUND = 12.0, 4.0
#: What it costs to lose all good labelled documents, and to keep all bad ones.
COSTS = (1.0, 1.0)
#: Prior strength where groups show no spread beyond chance, in documents.
STRONGEST = 1e6
RIDGE = 1.0


def features(text: Column) -> list[Column]:
    """Surface features, each bounded or logarithmic."""
    chars = F.length(text)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    without = lambda drop: (chars - F.length(F.translate(text, drop, ""))).cast("double")
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    n = F.greatest(F.size(words), F.lit(1))
    long = F.greatest(chars, F.lit(1))
    upper = without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return [
        F.log1p(F.size(words).cast("double")),
        without("#*$%&<>") / n,
        without("|") / n,
        without("!?") / n,
        upper / long,
        without("0123456789") / long,
        F.least(chars / n, F.lit(40.0)) / 10,
        F.size(F.array_distinct(words)) / n,
        F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        without(".,;:") / n,
        F.least(count(r"[^\p{L}\x20\x09-\x0D.,]") / n, F.lit(3.0)),
    ]


def products(x: np.ndarray, y: np.ndarray, mean: np.ndarray, scale: np.ndarray, shares: tuple[float, float], w: np.ndarray) -> np.ndarray:
    """Hessian and gradient of the weighted log-likelihood of rows, in one vector that adds up."""
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    share = np.where(y == 1, shares[1], shares[0])
    p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
    return np.append((z * (share * p * (1 - p))[:, None]).T @ z, z.T @ (share * (y - p)))


def newton(sums: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Weights of a ridge logistic regression, from passes that add up ``products``."""
    w = np.zeros(size)
    penalty = RIDGE * np.eye(size)
    penalty[0, 0] = 1e-6
    for _ in range(30):
        found = sums(w)
        step = np.linalg.solve(found[: size * size].reshape(size, size) + penalty, found[size * size :] - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps, the classes weighted evenly: means, scales, weights."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    shares = (0.5 / max(1, (y == 0).sum()) * len(y), 0.5 / max(1, (y == 1).sum()) * len(y))
    return mean, scale, newton(lambda w: products(x, y, mean, scale, shares, w), x.shape[1] + 1)


def fit_all(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """``fit`` on all ``rows`` (x, y) by passes; None if a class is lacking."""
    size = rows.sparkSession.range(1).select(F.size(F.array(*features(F.lit(""))))).first()[0]
    at = range(size)
    first = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0)), *[F.avg(F.col("x")[i]) for i in at]).first()
    n, good, mean = first[0], first[1], np.array(first[2:], float)
    if not 0 < good < n:
        return None
    spread = rows.agg(*[F.avg((F.col("x")[i] - float(mean[i])) ** 2) for i in at]).first()
    scale = np.maximum(np.sqrt(np.array(spread, float)), 1e-9)
    shares = (0.5 / (n - good) * n, 0.5 / good * n)

    def sums(w: np.ndarray) -> np.ndarray:
        def task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((size + 1) * (size + 2))
            for part in parts:
                if len(part):
                    total += products(np.stack(part["x"].to_numpy()), part["y"].to_numpy(float), mean, scale, shares, w)
            yield pd.DataFrame({"at": np.arange(total.size), "sum": total})

        by = rows.select("x", "y").mapInPandas(task, "at long, sum double").groupBy("at").agg(F.sum("sum").alias("sum")).collect()
        out = np.zeros((size + 1) * (size + 2))
        for r in by:
            out[r["at"]] = r["sum"]
        return out

    return mean, scale, newton(sums, size + 1)


def threshold(odds: np.ndarray, y: np.ndarray) -> float:
    """The log-odds from which on documents stay at the least cost; of equal costs the one nearest to 0."""
    values = np.unique(odds)
    cuts = np.concatenate([[values[0] - 1, 0.0], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    below = lambda x: np.searchsorted(np.sort(x), cuts) / max(1, x.size)
    cost = COSTS[0] * below(odds[y == 1]) + COSTS[1] * (1 - below(odds[y != 1]))
    return float(min(zip(np.round(cost, 12), np.abs(cuts), cuts, strict=True))[2])


def threshold_of(rows: DataFrame) -> float:
    """``threshold`` of all ``rows`` (odds, y), a staged table with both classes.

    The costs follow from running sums over the distinct odds. Of those with the least cost only the two
    nearest below 0 and the one nearest above can have the cut that is nearest to 0.
    """
    n = rows.agg(F.sum("y").alias("good"), F.sum(1 - F.col("y")).alias("bad"), F.min("odds").alias("low"), F.max("odds").alias("high"), F.sum(F.when(F.col("odds") < 0, F.col("y"))).alias("good_0"), F.sum(F.when(F.col("odds") < 0, 1 - F.col("y"))).alias("bad_0")).first()
    cost = lambda good, bad: COSTS[0] * (good / float(n["good"])) + COSTS[1] * (1 - bad / float(n["bad"]))
    values = staged(rows.groupBy("odds").agg(F.sum("y").alias("good"), F.sum(1 - F.col("y")).alias("bad")), "odds")
    costs = staged(running_sums(values, "odds", ["good", "bad"]).select("odds", F.round(cost(F.col("cum_good"), F.col("cum_bad")), 12).alias("cost")), "costs")
    least = costs.agg(F.min("cost")).first()[0]
    best = costs.where(F.col("cost") == least)
    near = [r["odds"] for r in best.where("odds < 0").orderBy(F.desc("odds")).limit(2).collect() + best.where("odds >= 0").orderBy("odds").limit(1).collect()]
    cuts = [(round(cost(0, 0), 12), n["low"] - 1), (round(cost(n["good_0"] or 0, n["bad_0"] or 0), 12), 0.0)]
    for value in near:
        above = costs.where(F.col("odds") > value).agg(F.min("odds")).first()[0]
        cuts.append((least, value + 1 if above is None else (value + above) / 2))
    superseded(values, costs)
    return float(min((c, abs(cut), cut) for c, cut in cuts)[2])


def evidence(fitted: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Column:
    """The log-odds expression over a column ``x`` of features."""
    mean, scale, w = fitted
    terms = F.lit(float(w[0]))
    for i, (m, s, c) in enumerate(zip(mean, scale, w[1:], strict=True)):
        terms = terms + (F.col("x")[i] - float(m)) * float(c / s)
    return F.greatest(F.least(terms, F.lit(BOUND)), F.lit(-BOUND))


def _spread(rates: DataFrame, n: str, rate: str, above: str) -> float:
    """Prior strength by moments: spread of the groups' rates around ``above`` beyond chance."""
    chance = F.col(above) * (1 - F.col(above))
    row = rates.agg(F.sum(F.col(n) * (F.col(rate) - F.col(above)) ** 2).alias("q"), F.sum(chance).alias("noise"), F.sum(F.col(n) * chance).alias("room"), F.count(F.lit(1)).alias("g")).first()
    if not row["g"] or not row["room"]:
        return STRONGEST
    excess = (row["q"] - row["noise"]) / row["room"]  # about 1 / (strength + 1)
    return float(min(STRONGEST, max(1.0, 1 / excess - 1))) if excess > 0 else STRONGEST


def site_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """Rows (id, evidence, host_rate, path_rate, quality, kept) for the rows of ``docs``."""
    own = docs.select(docs[id_col].alias("id"), docs[host_col].alias("host"), docs[path_col].alias("path"), F.array(*features(F.coalesce(docs[text_col], F.lit("")))).alias("x"))
    own = staged(own, "features")
    given = labels.where(labels[label_col].isNotNull() & labels[id_col].isNotNull()).select(labels[id_col].alias("_id"), (labels[label_col].cast("int") == 1).cast("int").alias("y"))
    known = staged(own.select("id", "x").join(bounded(given), F.col("id") == F.col("_id")).select("_id", "y", "x"), "known")
    fitted = fit_all(known)
    superseded(known)
    rows = own.select("id", "host", "path", (F.lit(0.0) if fitted is None else evidence(fitted)).alias("evidence"))
    rows = staged(rows.withColumn("p", 1 / (1 + F.exp(-F.col("evidence")))), "scored")
    superseded(own)
    paths = staged(rows.groupBy("host", "path").agg(F.sum("p").alias("good"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n"))
    whole = hosts.agg(F.sum("host_good").alias("good"), F.sum("host_n").alias("n")).first()
    rate = ((whole["good"] or 0.0) + 1) / ((whole["n"] or 0) + 2)
    at_host = _spread(hosts.select("host_n", (F.col("host_good") / F.col("host_n")).alias("r"), F.lit(rate).alias("up")), "host_n", "r", "up")
    hosts = hosts.withColumn("host_rate", (F.col("host_good") + rate * at_host) / (F.col("host_n") + at_host))
    hosts = staged(hosts.withColumnRenamed("host", "h"), "hosts")
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    at_path = _spread(both.select("n", (F.col("good") / F.col("n")).alias("r"), F.col("host_rate").alias("up")), "n", "r", "up")
    both = staged(both.select(F.col("host").alias("h"), F.col("path").alias("q"), "good", "n", "host_rate"), "groups")
    others = (F.col("good") - F.col("p") + F.col("host_rate") * at_path) / (F.col("n") - 1 + at_path)
    path_rate = F.greatest(F.least(others, F.lit(0.999)), F.lit(0.001))
    site = F.greatest(F.least(F.log(path_rate / (1 - path_rate)), F.lit(SITE_BOUND)), F.lit(-SITE_BOUND))
    judged = lambda some: some.join(both, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q"))).withColumn("odds", F.col("evidence") + site)
    kept = F.lit(True)
    if fitted is not None:
        seen = staged(judged(rows.join(bounded(given), rows["id"] == F.col("_id"))).select("odds", "y"), "seen")
        kept = F.col("odds") >= threshold_of(seen)
        superseded(seen)
    quality = 1 / (1 + F.exp(-F.col("odds")))
    return judged(rows).select(F.col("id").alias(id_col), "evidence", "host_rate", path_rate.alias("path_rate"), quality.alias("quality"), kept.alias("kept"))
