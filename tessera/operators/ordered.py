"""Sums and ranks over one global order, without one task that sees all rows.

Quantiles cut the order into ranges. Sums of whole ranges are few and come first; sums within a
range are windows over that range alone. The quantiles are an action of their own: give tables
that are cheap to read twice, such as staged ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

RANGES = 64
#: Keys of the sample for each range.
SAMPLE = 32


def in_ranges(df: DataFrame, key: str, ranges: int = RANGES, by: Sequence[str] = ()) -> DataFrame:
    """Add ``_range``, which does not decrease with ``key``; equal keys share one.

    Numbers are cut at approximate quantiles, other keys at those of a bounded sample by hash.
    """
    if isinstance(df.schema[key].dataType, NumericType):
        cuts = sorted(set(df.approxQuantile(key, [i / ranges for i in range(1, ranges)], 0.001)))
    else:
        some = df.where(F.col(key).isNotNull()).select(key).orderBy(F.xxhash64(key)).limit(ranges * SAMPLE)
        keys = [r[0] for r in some.orderBy(key).collect()]
        cuts = sorted(set(keys[len(keys) // ranges :: max(1, len(keys) // ranges)]))
    place = F.lit(0)
    if cuts:
        place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(key)))
    return df.withColumn("_range", place)


def running_sums(df: DataFrame, key: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False, ranges: int = RANGES) -> DataFrame:
    """For rows with distinct ``key`` (in each group ``by``) add ``cum_<c>``: sums up to the row."""
    cut = in_ranges(df, key, ranges)
    order = (lambda c: F.col(c).desc()) if descending else F.col
    whole = cut.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    before = Window.partitionBy(*by).orderBy(order("_range")).rowsBetween(Window.unboundedPreceding, -1)
    base = whole.select(*by, "_range", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in sums])
    within = Window.partitionBy(*by, "_range").orderBy(order(key)).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select("*", *[F.sum(c).over(within).alias(f"cum_{c}") for c in sums])
    both = local.join(F.broadcast(base) if not by else base, [*by, "_range"])
    return both.select(*df.columns, *[(F.col(f"cum_{c}") + F.col(f"_{c}")).alias(f"cum_{c}") for c in sums])


def running_min(df: DataFrame, key: str, value: Column, name: str, ranges: int = RANGES) -> DataFrame:
    """For rows with distinct ``key`` add ``name``: the least ``value`` from this row on."""
    cut = in_ranges(df, key, ranges).withColumn("_v", value)
    whole = cut.groupBy("_range").agg(F.min("_v").alias("_m"))
    after = Window.orderBy("_range").rowsBetween(1, Window.unboundedFollowing)
    base = whole.select("_range", F.min("_m").over(after).alias("_after"))
    within = Window.partitionBy("_range").orderBy(key).rowsBetween(0, Window.unboundedFollowing)
    both = cut.withColumn("_own", F.min("_v").over(within)).join(F.broadcast(base), "_range")
    return both.select(*df.columns, F.least("_own", "_after").alias(name))
