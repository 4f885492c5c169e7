"""Attention mass, cluster presence and representatives."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-12


def mass_filter(tiles: DataFrame, cutoff: float, massless: bool = True) -> DataFrame:
    """The fewest tiles of each image, by falling attention, whose mass reaches ``cutoff``.

    Ties go by falling tile id. An image without mass keeps all its tiles, or none if not ``massless``.
    Where all of an image's attention has at most 12 decimals (8 of the cutoff), sums are exact: the set
    ends where it has the cutoff itself, which sums in floating point may miss either way.
    """
    order, whole = Window.partitionBy("image_id").orderBy(F.col("attention").desc(), F.col("tile_id").desc()), Window.partitionBy("image_id")
    prior = order.rowsBetween(Window.unboundedPreceding, -1)
    given = F.col("attention").try_cast("decimal(20,12)")
    share = Decimal(str(cutoff))
    fits = F.lit(share == share.quantize(Decimal("1e-8")) and abs(share) < 10) & (F.col("attention").isNull() | F.coalesce(given.cast("double") == F.col("attention").cast("double"), F.lit(False)))
    kept = tiles.withColumns({
        "_before": F.coalesce(F.sum("attention").over(prior), F.lit(0.0)), "_total": F.sum("attention").over(whole), "_exact": F.bool_and(fits).over(whole),
        "_sum": F.coalesce(F.sum(given.cast("decimal(28,20)")).over(prior), F.lit(0)), "_enough": F.sum(given * F.lit(f"{share:f}").try_cast("decimal(9,8)")).over(whole),
    })
    exact = F.when(F.col("_total") > 0, F.col("_sum") < F.col("_enough")).otherwise(F.col("_sum") > F.col("_enough"))
    below = F.when(F.col("_total") != 0, F.when(F.col("_exact"), exact).otherwise(F.col("_before") / F.col("_total") < cutoff))
    keep = (F.col("_total") <= 0) | below if massless else below
    return kept.where(keep).drop("_before", "_total", "_exact", "_sum", "_enough")


def top_tiles(tiles: DataFrame, n: int) -> DataFrame:
    """The ``n`` tiles of greatest attention of each image, ranked from 1."""
    order = Window.partitionBy("image_id").orderBy(F.col("attention").desc(), F.col("tile_id").desc())
    return tiles.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def presence(tiles: DataFrame, weight: str) -> DataFrame:
    """Weight of each cluster in each image, and its share of the image's weight."""
    sums = tiles.where(F.col("cluster").isNotNull()).groupBy("image_id", "cluster").agg(F.sum(weight).alias("weighted_count"), F.count(F.lit(1)).alias("hard_count"))
    whole = Window.partitionBy("image_id")
    return sums.select(
        "image_id", "cluster", "weighted_count", (F.col("weighted_count") / F.greatest(F.sum("weighted_count").over(whole), F.lit(EPS))).alias("weighted_presence"),
        "hard_count", (F.col("hard_count") / F.sum("hard_count").over(whole)).alias("hard_frac"),
    )


def presence_wide(tiles: DataFrame, weight: str, clusters: list[str]) -> DataFrame:
    """One column of presence for each of the given clusters; 0 where an image lacks it."""
    rows = tiles.groupBy("image_id").pivot("cluster", clusters).agg(F.sum(weight)).fillna(0.0)
    total = sum((F.col(c) for c in clusters), F.lit(0.0))
    return rows.select("image_id", *[(F.col(c) / F.greatest(total, F.lit(EPS))).alias(f"cluster_{c}_presence") for c in clusters])


def presence_of_foreground(tiles: DataFrame, weight: str) -> DataFrame:
    """Presence relative to all foreground tiles: ``presence`` sums to 1 over the clusters of an
    image, ``presence_abs`` is the mean weight for each of its tiles."""
    n = F.count(F.lit(1)).over(Window.partitionBy("image_id"))
    sums = tiles.withColumn("_n", n).where(F.col("cluster").isNotNull()).groupBy("image_id", "cluster").agg(F.sum(weight).alias("w"), F.count(F.lit(1)).alias("hard_count"), F.max("_n").alias("_n"))
    whole = F.sum("w").over(Window.partitionBy("image_id"))
    return sums.select("image_id", "cluster", (F.col("w") / F.greatest(whole, F.lit(EPS))).alias("presence"), (F.col("w") / F.col("_n")).alias("presence_abs"), "hard_count", (F.col("hard_count") / F.col("_n")).alias("hard_frac"))


def hybrid(attention: str, gradient: str) -> Column:
    """Attention times the gradient of the score: what a tile adds, not only how much it is seen."""
    return F.col(attention) * F.col(gradient)
