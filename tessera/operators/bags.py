"""Training bags: the tiles of an image, alone or with those of its augmented copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import draw, uniform

MODES = ("replace", "augment", "separate")


def training_bags(tiles: DataFrame, augmented: DataFrame, mode: str, share: float, seed: int = 0) -> DataFrame:
    """(bag_id, image_id, tile_id, source, features): what each bag holds in training.

    ``tiles`` (image_id, tile_id, features) are the foreground; ``augmented`` also has ``source``,
    the name of the augmentation, and counts only where the tile is foreground.

    * ``replace``: each tile gives way, with probability ``share``, to its copy in one of the
      image's augmentations, drawn evenly; a copy that is not there leaves the tile.
    * ``augment``: all tiles, and each copy with probability ``share``.
    * ``separate``: a bag for the tiles and one for each augmentation, whole.

    Draws are digests of ids, so a lost task draws the same again.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    names = ["image_id", "tile_id", "source", "features"]
    own = tiles.select("image_id", "tile_id", F.lit("original").alias("source"), "features")
    copies = augmented.join(tiles.select("image_id", "tile_id"), ["image_id", "tile_id"], "left_semi").select(*names)
    image = F.col("image_id").cast("string")
    if mode == "separate":
        every = own.unionByName(copies)
        return every.select(F.concat_ws(":", image, "source").alias("bag_id"), *names)
    if mode == "augment":
        chosen = copies.where(uniform(draw(seed, "image_id", "tile_id", "source")) < share)
        return own.unionByName(chosen).select(image.alias("bag_id"), *names)
    sources = augmented.groupBy("image_id").agg(F.array_sort(F.collect_set("source")).alias("_sources"))
    swap = uniform(draw(seed, "image_id", "tile_id")) < share
    rows = own.join(sources, "image_id", "left").withColumn("_take", F.when(swap & F.col("_sources").isNotNull(), _pick(seed)))
    other = copies.select("image_id", "tile_id", F.col("source").alias("_take"), F.col("features").alias("_copy"))
    rows = rows.join(other, ["image_id", "tile_id", "_take"], "left")
    taken = F.col("_copy").isNotNull()
    return rows.select(image.alias("bag_id"), "image_id", "tile_id", F.when(taken, F.col("_take")).otherwise(F.col("source")).alias("source"), F.coalesce("_copy", "features").alias("features"))


def _pick(seed: int) -> Column:
    """One of the image's augmentations, by a second draw."""
    place = F.floor(uniform(draw(seed + 1, "image_id", "tile_id")) * F.size("_sources")).cast("int") + 1
    return F.element_at("_sources", place)
