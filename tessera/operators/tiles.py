"""Tile grids and foreground."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import round_half_even


def tile_grid(images: DataFrame, size_mm: float, stride: float = 1.0) -> DataFrame:
    """Whole tiles of ``size_mm`` in row-major order; images smaller than a tile have none.

    A tile's width in pixels and the stride are rounded half to even, one pixel at least.
    """
    valid = F.col("image_mpp").isNotNull() & ~F.isnan("image_mpp") & (F.col("image_mpp") > 0) & (F.col("image_mpp") < float("inf"))
    size = F.greatest(F.lit(1), round_half_even(F.lit(size_mm * 1000) / F.col("image_mpp"))).cast("long")
    rows = images.where(valid).select("image_id", size.alias("w"), "image_width", "image_height")
    rows = rows.withColumn("step", F.greatest(F.lit(1), round_half_even(F.col("w") * stride)).cast("long"))
    rows = rows.where((F.col("image_width") >= F.col("w")) & (F.col("image_height") >= F.col("w")))
    per_row = F.floor((F.col("image_width") - F.col("w")) / F.col("step")) + 1
    rows = rows.withColumn("per_row", per_row.cast("long"))
    ys = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("image_height") - F.col("w"), F.col("step"))).alias("tile_y"))
    xs = ys.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("image_width") - F.col("w"), F.col("step"))).alias("tile_x"))
    row, col = F.floor(F.col("tile_y") / F.col("step")).cast("long"), F.floor(F.col("tile_x") / F.col("step")).cast("long")
    return xs.select("image_id", (row * F.col("per_row") + col).alias("tile_id"), row.alias("tile_row"), col.alias("tile_col"), "tile_x", "tile_y", F.col("w").alias("tile_width"), F.col("w").alias("tile_height"), F.lit(size_mm).alias("size_mm"))


def tile_totals(images: DataFrame, size_mm: float, stride: float = 1.0) -> DataFrame:
    """Number of tiles by image, without making them."""
    size = F.greatest(F.lit(1), round_half_even(F.lit(size_mm * 1000) / F.col("image_mpp"))).cast("long")
    rows = images.withColumn("w", size).withColumn("step", F.greatest(F.lit(1), round_half_even(F.col("w") * stride)))
    side = lambda c: F.when(F.col(c) >= F.col("w"), F.floor((F.col(c) - F.col("w")) / F.col("step")) + 1).otherwise(0)
    return rows.select("image_id", (side("image_width") * side("image_height")).cast("long").alias("n_tiles"), F.lit(size_mm).alias("size_mm"))


def foreground(tiles: DataFrame, background: str = "tile_background") -> DataFrame:
    """Tiles not marked as background; unmarked tiles are foreground."""
    return tiles.where(~F.coalesce(F.col(background), F.lit(False)))


def contiguous(tiles: DataFrame) -> DataFrame:
    """For each image: tiles, and whether their ids are 0 to n - 1, each once."""
    by = tiles.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_tiles"), F.max("tile_id").alias("last"), F.count_distinct("tile_id").alias("n_ids"), F.min("tile_id").alias("first"))
    ok = (F.col("first") == 0) & (F.col("last") == F.col("n_tiles") - 1) & (F.col("n_ids") == F.col("n_tiles"))
    return by.select("image_id", "n_tiles", ok.alias("ok"))


def tile_slice(tiles: DataFrame, start: int, stop: int) -> DataFrame:
    """Tiles ``start`` up to, not including, ``stop``, of each image."""
    return tiles.where(F.col("tile_id").between(start, stop - 1))


def cluster_map(tiles: DataFrame, clusters: DataFrame, background: int = -1) -> DataFrame:
    """Every tile of the grid with its cluster; tiles without one are ``background``."""
    return tiles.join(clusters.select("image_id", "tile_id", "cluster"), ["image_id", "tile_id"], "left").withColumn("cluster", F.coalesce("cluster", F.lit(background)))


def resolution(images: DataFrame, metadata: DataFrame, default: float | None = None) -> DataFrame:
    """``image_mpp`` of the image itself, else of the metadata, else the default; and which it was.

    Metadata hold a row for each image. Values that are not positive do not count.
    """
    known = lambda c: F.when((F.col(c) > 0) & ~F.isnan(c) & (F.col(c) < float("inf")), F.col(c))
    rows = images.join(metadata.select("image_id", F.col("image_mpp").alias("_other")), "image_id", "left")
    own, other = known("image_mpp"), known("_other")
    origin = F.when(own.isNotNull(), "image").when(other.isNotNull(), "metadata").when(F.lit(default is not None), "default")
    return rows.withColumn("_mpp", F.coalesce(own, other, F.lit(default).cast("double"))).withColumn("mpp_from", origin).drop("image_mpp", "_other").withColumnRenamed("_mpp", "image_mpp")
