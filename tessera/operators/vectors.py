"""Vector columns: norms, centroids, cosines and nearest centroids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import draw

EPS = 1e-12
#: Centroids of a model at most; they travel to the tiles as one row.
MOST_CENTRES = 50_000


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: str) -> Column:
    """A vector over its length; a vector without length stays as it is."""
    size = F.greatest(norm(v), F.lit(EPS))
    return F.transform(v, lambda x: x.cast("double") / size)


def l2_normalised(df: DataFrame, column: str = "features") -> DataFrame:
    return df.withColumn("_norm", F.greatest(norm(column), F.lit(EPS))).withColumn(column, F.transform(F.arrays_zip(F.col(column).alias("x"), F.array_repeat("_norm", F.size(column)).alias("n")), lambda z: z["x"].cast("double") / z["n"])).drop("_norm")


def centroid_parts(tiles: DataFrame, by: str = "cluster", column: str = "features") -> DataFrame:
    """Mean of each dimension for each group; sums are formed before the shuffle."""
    return tiles.where(F.col(by).isNotNull()).select(by, F.posexplode(column).alias("dim", "x")).groupBy(by, "dim").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def centroids(tiles: DataFrame, by: str = "cluster", column: str = "features") -> DataFrame:
    """Unit centroid of each group; groups whose mean has no length are left out."""
    rows = centroid_parts(tiles, by, column).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("dim", "mean"))).alias("parts"))
    rows = rows.select(by, F.transform("parts", lambda p: p["mean"]).alias("mean")).withColumn("size", norm("mean")).where(F.col("size") > EPS)
    return rows.select(by, F.transform(F.arrays_zip(F.col("mean").alias("x"), F.array_repeat("size", F.size("mean")).alias("n")), lambda z: z["x"] / z["n"]).alias("centroid"))


def cosine_weights(tiles: DataFrame, centres: DataFrame, by: str = "cluster", column: str = "features", clipped: bool = False) -> DataFrame:
    """Each tile's cosine to its own centroid as a weight: rescaled to 0..1, or cut below 0.

    Tiles whose cluster has no centroid weigh 0.
    """
    cos = dot(column, "centroid") / F.greatest(norm(column), F.lit(EPS))
    weight = F.greatest(cos, F.lit(0.0)) if clipped else (cos + 1) / 2
    return tiles.join(centres, by, "left").withColumn("cos_weight", F.coalesce(weight, F.lit(0.0))).drop("centroid")


def model_row(centres: DataFrame, by: str) -> DataFrame:
    """One row with all centroids of a model, whose number is checked."""
    if centres.limit(MOST_CENTRES + 1).count() > MOST_CENTRES:
        raise ValueError(f"more than {MOST_CENTRES} centroids")
    return centres.agg(F.array_sort(F.collect_list(F.struct(F.col(by).alias("id"), "centroid"))).alias("model"))


def nearest_centroid(tiles: DataFrame, centres: DataFrame, by: str = "cluster", column: str = "features") -> DataFrame:
    """The centroid of greatest inner product for each tile; ties go to the smaller id.

    The centroids are a model: they travel to the tiles as one broadcast row and no pair of tile and
    centroid leaves a task. More than ``MOST_CENTRES`` are an error.
    """
    rows = tiles.drop(by).join(F.broadcast(model_row(centres, by)))
    best = F.aggregate(
        "model",
        F.struct(F.lit(None).cast(centres.schema[by].dataType).alias("id"), F.lit(float("-inf")).alias("sim")),
        lambda acc, m: F.when(dot(column, m["centroid"]) > acc["sim"], F.struct(m["id"].alias("id"), dot(column, m["centroid"]).alias("sim"))).otherwise(acc),
    )
    return rows.withColumn("_best", best).select(*[c for c in tiles.columns if c != by], F.col("_best.id").alias(by), F.col("_best.sim").alias("similarity"))


def knn_edges(centres: DataFrame, k: int, by: str = "cluster") -> DataFrame:
    """Undirected edges between each centroid and its k nearest, weighted by similarity.

    All centroids travel to each as one broadcast row, of which the k nearest leave it.
    """
    rows = centres.select(F.col(by).alias("a"), "centroid").join(F.broadcast(model_row(centres, by)))
    others = F.filter("model", lambda m: m["id"] != F.col("a"))
    sims = F.array_sort(F.transform(others, lambda m: F.struct((-dot("centroid", m["centroid"])).alias("less"), m["id"].alias("b"))))
    near = rows.select("a", F.explode(F.slice(sims, 1, k)).alias("near")).select("a", "near.b", (-F.col("near.less")).alias("sim"))
    ends = near.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"), F.greatest("sim", F.lit(1e-6)).alias("weight"))
    return ends.groupBy("src", "dst").agg(F.max("weight").alias("weight"))


def representatives(tiles: DataFrame, n: int, by: str = "cluster") -> DataFrame:
    """The n tiles of each cluster nearest its centroid, from rows with ``cos_weight``."""
    order = Window.partitionBy(by).orderBy(F.col("cos_weight").desc(), "image_id", "tile_id")
    return tiles.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def block_unit(v: str, widths: Sequence[int]) -> Column:
    """A vector made of blocks (one for each encoder), each block over its own length."""
    blocks, start = [], 1
    for w in widths:
        blocks.append(F.transform(F.arrays_zip(F.slice(v, start, w).alias("x"), F.array_repeat(F.greatest(norm(F.slice(v, start, w)), F.lit(EPS)), w).alias("n")), lambda z: z["x"].cast("double") / z["n"]))
        start += w
    return F.concat(*blocks)


def standardised(df: DataFrame, column: str = "features") -> DataFrame:
    """(image_id, dim, x, z): each dimension less its mean and over its population deviation, or
    over 1 where that is 0. The moments are one row a dimension and are broadcast."""
    rows = df.select("image_id", F.posexplode(column).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    moments = rows.groupBy("dim").agg(F.avg("x").alias("_mean"), F.stddev_pop("x").alias("_std"))
    return rows.join(F.broadcast(moments), "dim").select("image_id", "dim", "x", ((F.col("x") - F.col("_mean")) / F.when(F.col("_std") > 0, F.col("_std")).otherwise(1.0)).alias("z"))


def problems(df: DataFrame, width: int, column: str = "features") -> DataFrame:
    """Rows whose vector is missing, of another width, or not finite, and why."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    why = F.when(F.col(column).isNull() | (F.size(column) == 0), "empty").when(F.size(column) != width, "width").when(bad, "not finite")
    return df.withColumn("problem", why).where("problem IS NOT NULL")


def drawn(tiles: DataFrame, n: int, by: str = "cluster", seed: int = 0) -> DataFrame:
    """``n`` tiles of each cluster drawn at random, the same ones for the same seed."""
    order = Window.partitionBy(by).orderBy(draw(seed, "image_id", "tile_id"), "image_id", "tile_id")
    return tiles.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def cumulative_share(parts: DataFrame, key: str, variance: str) -> DataFrame:
    """Running share of the variance, for a table of one row a component."""
    order = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return parts.withColumn("cumulative", F.sum(variance).over(order) / F.sum(variance).over(Window.partitionBy()))
