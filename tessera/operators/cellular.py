"""Cells to tiles, and composition of images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import floor_bin

TUMOUR, LYMPHOCYTE = "Neoplastic", "Inflammatory"
COUNTS = ("n_cells", "n_tumor", "n_lymph", "n_mitosis")


def _counts() -> list[Column]:
    """All four counts in one pass; the partial sums are formed before the shuffle."""
    one = lambda cond: F.count_if(cond)
    return [F.count(F.lit(1)).alias("n_cells"), one(F.col("cell_type") == TUMOUR).alias("n_tumor"), one(F.col("cell_type") == LYMPHOCYTE).alias("n_lymph"), one(F.coalesce("is_mitotic", F.lit(False))).alias("n_mitosis")]


def tile_counts(cells: DataFrame, tiles: DataFrame, width: int, height: int, x0: int = 0, y0: int = 0) -> DataFrame:
    """Counts of cells for each tile on the lattice of pitch (width, height) from (x0, y0).

    Cells outside every tile vanish, as do those between tiles that overlap off the lattice.
    """
    keyed = cells.withColumns({"tile_x": floor_bin("x", x0, width), "tile_y": floor_bin("y", y0, height)})
    binned = keyed.groupBy("image_id", "tile_x", "tile_y").agg(*_counts())
    return tiles.join(binned, ["image_id", "tile_x", "tile_y"], "left").fillna(0, list(COUNTS))


def tile_counts_overlapping(cells: DataFrame, tiles: DataFrame, width: int, height: int, stride: int) -> DataFrame:
    """Counts of cells for tiles that overlap: each cell goes to every tile that contains it.

    A cell lies in at most ceil(width / stride) columns and as many rows of tiles, so it is
    exploded to those and meets tiles by an equi-join instead of a range join.
    """
    per_x, per_y = -(-width // stride), -(-height // stride)
    first = lambda c, i: (F.floor(F.col(c) / stride) - i) * stride
    xs = F.array(*[first("x", i) for i in range(per_x)])
    ys = F.array(*[first("y", i) for i in range(per_y)])
    wide = cells.withColumn("tile_x", F.explode(xs)).withColumn("tile_y", F.explode(ys))
    wide = wide.where((F.col("x") < F.col("tile_x") + width) & (F.col("y") < F.col("tile_y") + height))
    binned = wide.groupBy("image_id", "tile_x", "tile_y").agg(*_counts())
    return tiles.join(binned, ["image_id", "tile_x", "tile_y"], "left").fillna(0, list(COUNTS))


def totals(counts: DataFrame) -> DataFrame:
    """Whole-image totals and abundance ratios; null where a denominator is 0."""
    sums = counts.groupBy("image_id").agg(*[F.sum(c).alias(c) for c in COUNTS[1:]])
    return sums.withColumns({"etil": F.try_divide(F.col("n_lymph"), F.col("n_lymph") + F.col("n_tumor")), "mitosis_tumor_ratio": F.try_divide("n_mitosis", "n_tumor")})


def cellular_features(counts: DataFrame, tissue_min_cells: int = 64, tumor_percentile: float = 75.0, lymph_frac: float = 0.05, mitosis_min: int = 1) -> DataFrame:
    """One row for each image: totals, ratios and coverage over its tumour tiles.

    Tumour tiles are tissue tiles whose tumour fraction reaches the image's percentile; coverage is
    the share of them with more than ``lymph_frac`` lymphocytes, or more than ``mitosis_min``
    mitoses. Undefined values are null.
    """
    frac = F.try_divide(F.col("n_tumor"), F.col("n_cells"))
    tissue = F.col("n_cells") >= tissue_min_cells
    bar = counts.groupBy("image_id").agg(F.percentile(F.when(tissue, frac), F.lit(tumor_percentile / 100)).alias("bar"))
    tumour = tissue & (frac >= F.col("bar"))
    lymph = tumour & (F.try_divide(F.col("n_lymph"), F.col("n_cells")) > lymph_frac)
    by = counts.join(bar, "image_id").groupBy("image_id").agg(F.count_if(tumour).alias("tiles"), F.count_if(lymph).alias("lymph"), F.count_if(tumour & (F.col("n_mitosis") > mitosis_min)).alias("mitotic"))
    cover = by.select("image_id", F.try_divide("lymph", "tiles").alias("til_coverage"), F.try_divide("mitotic", "tiles").alias("mitotic_coverage"))
    return totals(counts).join(cover, "image_id")


def large_clusters(rows: DataFrame, by: Sequence[str], cluster: str, least_share: float) -> DataFrame:
    """Cluster sizes of each group, of clusters with at least ``least_share`` of the largest."""
    sizes = rows.groupBy(*by, cluster).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy(*by).agg(F.max("n").alias("most"))
    return sizes.join(most, list(by)).where(F.col("n") >= least_share * F.col("most")).drop("most")


#: Types whose sum stands in for a missing total.
TYPES = ("n_tumor", "n_lymph", "n_connective", "n_epithelial", "n_dead")


def with_totals(counts: DataFrame) -> DataFrame:
    """Counts with ``n_cells``: as given, or the sum of the types that the table has."""
    if "n_cells" in counts.columns:
        return counts
    known = [F.coalesce(F.col(c), F.lit(0)) for c in TYPES if c in counts.columns]
    return counts.withColumn("n_cells", sum(known, F.lit(0)).cast("long"))
