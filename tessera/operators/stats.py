"""Rank statistics and classifier measures over whole tables.

Rows of equal value are summed up first, so that only distinct values are ordered; running sums
over the order are taken range by range (``ordered``). The summed tables are staged.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import draw
from tessera.operators.ordered import running_min, running_sums
from tessera.sources.storage import staged


#: Rows of the smaller class up to which p-values of U are exact.
EXACT = 8
#: Distribution function of a Poisson variable of mean 1, from 0 on.
POISSON = tuple(math.fsum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(7))


def _by_value(df: DataFrame, value: str, label: str, by: Sequence[str]) -> DataFrame:
    one = F.col(label) == 1
    rows = df.where(F.col(value).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(*by, value).agg(F.count_if(one).alias("pos"), F.count_if(~one).alias("neg"))


def mann_whitney(df: DataFrame, value: str, label: str, by: Sequence[str]) -> DataFrame:
    """For each group: class sizes, U of class 1, rank-biserial effect and class means.

    U counts the pairs in which class 1 is larger, ties for half.
    """
    run = running_sums(staged(_by_value(df, value, label, by)), value, ["neg"], by)
    u = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0))
    mean = lambda c: F.try_divide(F.sum(F.col(value) * F.col(c)), F.sum(c))
    out = run.groupBy(*by).agg(F.sum("pos").alias("n1"), F.sum("neg").alias("n0"), u.alias("u1"), mean("pos").alias("mean1"), mean("neg").alias("mean0"), F.sum(F.pow(F.col("pos") + F.col("neg"), F.lit(3)) - F.col("pos") - F.col("neg")).alias("ties"))
    pairs = (F.col("n0") * F.col("n1")).cast("double")
    return out.withColumn("effect_r", F.try_divide(2 * F.col("u1"), pairs) - 1)


def u_counts(n0: int, n1: int) -> np.ndarray:
    """How many of the ways to deal n0 + n1 ranks give each U from 0 to n0 * n1, as exact integers.

    The counts are the coefficients of a product of (1 - q^(n + i)) / (1 - q^i); each factor is a
    subtraction, or a running sum with a stride, over the smaller class's numbers.
    """
    few, many = sorted((n0, n1))
    out = np.zeros(n0 * n1 + 1, object)
    out[0] = 1
    for i in range(1, few + 1):
        if many + i <= out.size - 1:
            out[many + i :] = out[many + i :] - out[: -(many + i)]
        for r in range(min(i, out.size)):
            out[r::i] = np.cumsum(out[r::i])
    return out


@functools.lru_cache(maxsize=64)
def _u_sums(n0: int, n1: int) -> list[int]:
    return np.cumsum(u_counts(n0, n1)).tolist()


def _exact_p(n0: pd.Series, n1: pd.Series, u1: pd.Series) -> pd.Series:
    """Two-sided p: twice the share of deals with a U as far from the mean, at most 1. A row a test."""
    out = []
    for a, b, u in zip(n0.tolist(), n1.tolist(), u1.tolist(), strict=True):
        if a != a or b != b or u != u or min(a, b) > EXACT or not min(a, b):
            out.append(None)
            continue
        sums = _u_sums(int(a), int(b))
        out.append(min(1.0, 2 * sums[int(min(u, a * b - u))] / sums[-1]))
    return pd.Series(out, dtype="float64")


def with_p_values(tests: DataFrame) -> DataFrame:
    """Two-sided p of U. Without ties, and with ``EXACT`` rows or fewer in one class, it is exact, by
    the counts of all deals; else by the normal approximation with tie and continuity correction.

    The normal tail is Abramowitz and Stegun 7.1.26, with an absolute error below 1.5e-7. Values
    that are all equal have no p, and neither have tests without one of the classes.
    """
    n = F.col("n0") + F.col("n1")
    var = F.try_divide(F.col("n0") * F.col("n1") / 12.0 * ((n + 1) - F.try_divide(F.col("ties").cast("double"), (n * (n - 1)).cast("double"))), F.lit(1.0))
    z = F.try_divide(F.greatest(F.abs(F.col("u1") - F.col("n0") * F.col("n1") / 2.0) - 0.5, F.lit(0.0)), F.sqrt(var))
    x = z / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t
    small = (F.least("n0", "n1") <= EXACT) & (F.col("ties") == 0)
    # a row a test, and few of them have small classes
    exact = F.pandas_udf(_exact_p, "double")(F.when(small, F.col("n0")).cast("double"), F.col("n1").cast("double"), F.col("u1"))
    return tests.withColumn("p_value", F.when(small, exact).when(var > 0, F.least(F.lit(1.0), poly * F.exp(-x * x))))


def significant(tests: DataFrame, alpha: float = 0.05, p: str = "p_adjusted") -> DataFrame:
    """Tests with a p under ``alpha``; all of them where none has."""
    whole = tests.agg(F.coalesce(F.bool_or(F.col(p) < alpha), F.lit(False)).alias("_some"))
    return tests.join(F.broadcast(whole), how="inner").where(~F.col("_some") | (F.col(p) < alpha)).drop("_some")


def benjamini_hochberg(tests: DataFrame, p: str = "p_value") -> DataFrame:
    """Step-up adjusted p-values; null p-values do not count."""
    tests = staged(tests)
    known = tests.where(F.col(p).isNotNull())
    per = staged(known.groupBy(p).agg(F.count(F.lit(1)).alias("_n")))
    whole = per.agg(F.sum("_n").alias("_m"))
    ranked = staged(running_sums(per, p, ["_n"]).join(F.broadcast(whole), how="inner"))
    stepped = running_min(ranked, p, F.least(F.lit(1.0), F.col(p) * F.col("_m") / F.col("cum__n")), "p_adjusted")
    return tests.join(stepped.select(p, "p_adjusted"), p, "left")


def roc_points(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """True and false positives at each distinct score, taken as a threshold, from the top."""
    run = running_sums(staged(_by_value(df, score, label, by)), score, ["pos", "neg"], by, descending=True)
    return run.select(*by, F.col(score).alias("threshold"), "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"))


def auroc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; null if a class is missing."""
    tests = mann_whitney(df, score, label, by)
    return tests.select(*by, "n0", "n1", F.try_divide(F.col("u1"), (F.col("n0") * F.col("n1")).cast("double")).alias("auroc"))


def average_precision(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum over thresholds of the step in recall times the precision there."""
    points = roc_points(df, score, label, by)
    return points.groupBy(*by).agg(F.try_divide(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.sum("pos").cast("double")).alias("average_precision"))


def rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings of the same rows."""
    pairs = lambda c: c * (c - 1) / 2.0
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    side = lambda k: cells.groupBy(k).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias(f"s_{k}"))
    whole = cells.agg(F.sum(pairs(F.col("n"))).alias("same"), F.sum("n").alias("n"))
    rows = whole.join(F.broadcast(side(a)), how="inner").join(F.broadcast(side(b)), how="inner")
    chance = F.col(f"s_{a}") * F.col(f"s_{b}") / pairs(F.col("n"))
    most = (F.col(f"s_{a}") + F.col(f"s_{b}")) / 2
    return rows.select(F.col("n").alias("n_rows"), F.coalesce(F.try_divide(F.col("same") - chance, most - chance), F.lit(1.0)).alias("ari"))


def log_factorial(n: Column) -> Column:
    """Of whole numbers from 0 on: Stirling's series at n + 9, and the factors up to there taken off again."""
    x = n.cast("double") + 9.0
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0))) - 1 / (1680 * F.pow(x, F.lit(7.0)))
    return series - sum(F.log(x - i) for i in range(1, 9))


def mutual_information(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """For two labelings of the same rows (in each group ``by``): n_rows, mutual information, what is
    expected of it when rows are dealt at random with the same sizes, both entropies, and the
    adjusted value (1 where both labelings have one class or the rest is nothing).

    The expectation is a sum over the sizes of an overlap for each pair of different class sizes. Those
    sums are rows of a table, as many as the rows of the smaller classes, added up by all tasks.
    """
    by = list(by)
    cells = staged(df.groupBy(*by, F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count(F.lit(1)).alias("n")))
    whole = cells.groupBy(*by).agg(F.sum("n").alias("n_rows"))
    of = lambda names: [F.col(c) for c in names]

    def sizes(side: str, name: str) -> DataFrame:
        return cells.groupBy(*by, side).agg(F.sum("n").alias(name))

    def joined(x: DataFrame, y: DataFrame, keys: Sequence[str]) -> DataFrame:
        return x.join(y, list(keys)) if keys else x.join(F.broadcast(y), how="inner")

    n, share = F.col("n_rows").cast("double"), F.col("n") / F.col("n_rows")
    both = joined(joined(joined(cells, whole, by), sizes("_a", "ra"), [*by, "_a"]), sizes("_b", "rb"), [*by, "_b"])
    mi = both.groupBy(*by).agg(F.sum(share * F.log(F.col("n") * n / (F.col("ra") * F.col("rb")))).alias("mi"))
    entropy = lambda side, name: joined(sizes(side, "r"), whole, by).groupBy(*by).agg((-F.sum(F.col("r") / n * F.log(F.col("r") / n))).alias(name))

    # overlaps of each pair of different sizes; a size stands for all classes that have it
    times = lambda side, name: sizes(side, name).groupBy(*by, name).agg(F.count(F.lit(1)).alias(f"{name}_times"))
    first, second = joined(times("_a", "ra"), whole, by), times("_b", "rb")
    pairs = first.join(second, by) if by else first.join(F.broadcast(second), how="inner")  # class sizes are few
    low = F.greatest(F.lit(1).cast("long"), F.col("ra") + F.col("rb") - F.col("n_rows"))
    steps = pairs.withColumn("k", F.explode(F.sequence(low, F.least("ra", "rb"))))
    steps = steps.repartition(*by, "ra", "rb", F.col("k") % 64) if by else steps.repartition("ra", "rb", F.col("k") % 64)
    k, lf = F.col("k"), log_factorial
    log_p = lf(F.col("ra")) + lf(F.col("rb")) + lf(F.col("n_rows") - F.col("ra")) + lf(F.col("n_rows") - F.col("rb")) - lf(F.col("n_rows")) - lf(k) - lf(F.col("ra") - k) - lf(F.col("rb") - k) - lf(F.col("n_rows") - F.col("ra") - F.col("rb") + k)
    term = F.col("ra_times") * F.col("rb_times") * k / n * F.log(n * k / (F.col("ra").cast("double") * F.col("rb"))) * F.exp(log_p)
    emi = steps.groupBy(*by).agg(F.sum(term).alias("expected_mi"))

    out = whole
    for more in (mi, emi, entropy("_a", "h_a"), entropy("_b", "h_b")):
        out = joined(out, more, by)
    rest = (F.col("h_a") + F.col("h_b")) / 2 - F.col("expected_mi")
    single = (F.col("h_a") == 0) & (F.col("h_b") == 0)
    ami = F.when(single | (F.abs(rest) < 1e-15), 1.0).otherwise((F.col("mi") - F.col("expected_mi")) / rest)
    return out.select(*of(by), "n_rows", "mi", "expected_mi", "h_a", "h_b", ami.alias("ami"))


def agreement(labelings: DataFrame, item: str = "tile_id", run: str = "run", label: str = "cluster") -> DataFrame:
    """(run_a, run_b, n_rows, ari, ami) of each two runs that label the same items, a < b.

    Runs are few; items of two runs meet by id.
    """
    x = labelings.select(item, F.col(run).alias("run_a"), F.col(label).alias("a"))
    y = labelings.select(item, F.col(run).alias("run_b"), F.col(label).alias("b"))
    pairs = staged(x.join(y, item).where("run_a < run_b").groupBy("run_a", "run_b", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    two = lambda c: F.sum(c * (c - 1) / 2.0)
    side = lambda k: pairs.groupBy("run_a", "run_b", k).agg(F.sum("n").alias("n")).groupBy("run_a", "run_b").agg(two(F.col("n")).alias(f"s_{k}"))
    keys = ["run_a", "run_b"]
    sums = pairs.groupBy(*keys).agg(two(F.col("n")).alias("same"), F.sum("n").alias("m")).join(side("a"), keys).join(side("b"), keys)
    chance, most = F.try_divide(F.col("s_a") * F.col("s_b"), F.col("m") * (F.col("m") - 1) / 2.0), (F.col("s_a") + F.col("s_b")) / 2
    ari = sums.select(*keys, F.coalesce(F.try_divide(F.col("same") - chance, most - chance), F.lit(1.0)).alias("ari"))
    rows = x.join(y, item).where("run_a < run_b")
    return mutual_information(rows, "a", "b", keys).join(ari, keys).select(*keys, "n_rows", "ari", "ami")


def mean_and_spread(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean and population deviation over replicas."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("n"))


def bootstrap_auroc(df: DataFrame, score: str, label: str, id_col: str, replicas: int, seed: int = 0) -> DataFrame:
    """AUROC of Poisson resamples and their mean and 2.5 and 97.5 percentiles.

    Each row has a weight for each replica, a Poisson draw from 32 bits of a digest that serves four
    replicas, so a replica's sample needs no exchange of rows; replicas without one of the classes are skipped.
    """
    weight = F.lit(0)
    for e in POISSON:
        weight = weight + (F.col("u") >= f"{math.ceil(e * (1 << 32)):08x}").cast("int")
    fours = df.select(id_col, score, label, F.explode(F.sequence(F.lit(0), F.lit((replicas - 1) // 4))).alias("four")).withColumn("d", draw(seed, id_col, "four"))
    each = fours.select(score, label, "four", F.posexplode(F.array(*[F.substring("d", 8 * i + 1, 8) for i in range(4)])).alias("i", "u"))
    rows = each.select(score, label, (F.col("four") * 4 + F.col("i")).alias("replica"), weight.alias("w")).where((F.col("w") > 0) & (F.col("replica") < replicas))
    one = F.col(label) == 1
    per = rows.groupBy("replica", score).agg(F.sum(F.when(one, F.col("w")).otherwise(0)).alias("pos"), F.sum(F.when(one, 0).otherwise(F.col("w"))).alias("neg"))
    run = running_sums(staged(per), score, ["neg"], ["replica"]).withColumn("below", F.col("cum_neg") - F.col("neg"))
    auc = run.groupBy("replica").agg((F.try_divide(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)), (F.sum("pos") * F.sum("neg")).cast("double"))).alias("auc")).where("auc IS NOT NULL")
    return auc.agg(F.count(F.lit(1)).alias("replicas"), F.avg("auc").alias("mean"), F.percentile("auc", F.lit(0.025)).alias("low"), F.percentile("auc", F.lit(0.975)).alias("high"))


def kaplan_meier(df: DataFrame, time: str, event: str, by: Sequence[str]) -> DataFrame:
    """Share still without the event after each time with one, for each group.

    The product over times becomes a running sum of logarithms; after a time at which all at risk
    have the event the share is 0.
    """
    at = staged(df.where(F.col(time).isNotNull()).groupBy(*by, time).agg(F.sum(F.col(event).cast("long")).alias("events"), F.count(F.lit(1)).alias("leaving")))
    gone = running_sums(at, time, ["leaving"], by)
    whole = at.groupBy(*by).agg(F.sum("leaving").alias("_all"))
    risk = gone.join(whole, list(by)).withColumn("at_risk", F.col("_all") - F.col("cum_leaving") + F.col("leaving"))
    share = 1 - F.col("events") / F.col("at_risk")
    logs = risk.withColumn("_zero", (share <= 0).cast("int")).withColumn("_log", F.when(share > 0, F.log(share)).otherwise(0.0))
    done = running_sums(staged(logs), time, ["_zero", "_log"], by)
    kept = F.when(F.col("cum__zero") > 0, F.lit(0.0)).otherwise(F.exp("cum__log"))
    return done.where("events > 0").select(*by, F.col(time).alias("time"), "at_risk", "events", kept.alias("recurrence_free_prob"))
