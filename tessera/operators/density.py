"""Density clusters (DBSCAN) of cells as joins of squares, without gathering an image.

The plane of each image is cut into squares whose diagonal is ``eps``. A square with ``least`` cells
or more is dense: all its cells are core cells of one cluster, whatever their number, and no two of
them need to meet. Only cells of the other squares, fewer than ``least`` in each, are compared with
the cells of the squares around, so a cell takes part in a bounded number of comparisons. Dense
squares are linked by the boxes around their cells; where boxes leave it open whether two squares of
different clusters touch, those of smaller squares are compared, and at last the places of cells.

A cell that is no core cell but near some belongs to the cluster with the smallest core cell id, as
in the sequential algorithm over cells in the order of ids. Cells without a place are noise. Rows of
equal id are cells of their own. Inputs have no columns ``_row`` and ``_of``, nor ``cluster``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.graphs import components
from tessera.sources.storage import staged

#: Small squares on a side of a square.
PARTS = 8
_AROUND = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]


def _square(side: float) -> Column:
    return F.struct("image", F.floor(F.col("x") / side).alias("i"), F.floor(F.col("y") / side).alias("j"))


def _boxes(points: DataFrame, *by: str) -> DataFrame:
    return points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}{i}") for c in ("x", "y") for i, f in enumerate((F.min, F.max))])


def _spread(p: str, q: str) -> tuple[Column, Column]:
    """Least and greatest squared distance between cells of two boxes, of which the greatest is bound by the corners."""
    low, high = [], []
    for c in ("x", "y"):
        ahead, behind = F.col(f"{q}.{c}0") - F.col(f"{p}.{c}1"), F.col(f"{p}.{c}0") - F.col(f"{q}.{c}1")
        low.append(F.greatest(ahead, behind, F.lit(0.0)))
        high.append(F.greatest(F.col(f"{q}.{c}1") - F.col(f"{p}.{c}0"), F.col(f"{p}.{c}1") - F.col(f"{q}.{c}0")))
    return low[0] * low[0] + low[1] * low[1], high[0] * high[0] + high[1] * high[1]


def _met(boxes: DataFrame, pairs: DataFrame, eps: float) -> DataFrame:
    """``pairs`` (a, b, ...) with the boxes of both and ``meets``: true, false, or null where cells must tell."""
    p, q = boxes.select(F.col("square").alias("a"), F.struct("x0", "x1", "y0", "y1").alias("p"), "part"), boxes.select(F.col("square").alias("b"), F.struct("x0", "x1", "y0", "y1").alias("q"), F.col("part").alias("other"))
    low, high = _spread("p", "q")
    meets = F.when(high <= eps * eps, True).when(low > eps * eps, False)
    return pairs.join(p, "a").join(q, "b").select("a", "b", "part", "other", meets.alias("meets"))


def _dense_links(points: DataFrame, boxes: DataFrame, others: DataFrame, eps: float, side: float) -> DataFrame:
    """Links (a, b) between dense squares, as many as tell the components; ``others`` are links that are known."""
    sq = F.col("square")
    ahead = [(i, j) for i, j in _AROUND if (i, j) > (0, 0)]
    there = F.explode(F.array(*[F.struct(sq["image"].alias("image"), (sq["i"] + i).alias("i"), (sq["j"] + j).alias("j")) for i, j in ahead])).alias("b")
    whole = boxes.withColumn("part", F.lit(0))
    pairs = boxes.select(sq.alias("a"), there).join(boxes.select(sq.alias("b")), "b")
    first = staged(_met(whole, pairs, eps))
    known = staged(others.unionByName(first.where("meets").select("a", "b")))
    label = staged(components(known))
    of = lambda c, name: label.select(F.col("node").alias(c), F.col("part").alias(name))
    apart = F.coalesce("x", "a") != F.coalesce("y", "b")
    unsure = staged(first.where("meets is null").select("a", "b").join(of("a", "x"), "a", "left").join(of("b", "y"), "b", "left").where(apart).select("a", "b"))
    if unsure.isEmpty():
        return known
    ends = unsure.select(F.col("a").alias("square")).unionByName(unsure.select(F.col("b").alias("square"))).distinct()
    small = lambda c, o: F.floor((F.col(c) / side - F.col(f"square.{o}")) * PARTS)
    inner = staged(points.join(ends, "square", "left_semi").select("square", "x", "y").distinct().withColumn("part", (small("x", "i") * PARTS + small("y", "j")).cast("int")))
    second = staged(_met(_boxes(inner, "square", "part"), unsure, eps))
    sure = second.where("meets").select("a", "b").distinct()
    open_ = second.where("meets is null").join(sure, ["a", "b"], "left_anti")
    p = inner.select(F.col("square").alias("a"), "part", "x", "y")
    q = inner.select(F.col("square").alias("b"), F.col("part").alias("other"), F.col("x").alias("qx"), F.col("y").alias("qy"))
    near = (F.col("x") - F.col("qx")) ** 2 + (F.col("y") - F.col("qy")) ** 2 <= eps * eps
    last = open_.join(p, ["a", "part"]).join(q, ["b", "other"]).where(near).select("a", "b").distinct()
    return known.unionByName(sure).unionByName(last)


def _numbered(cells: DataFrame) -> DataFrame:
    """``cells`` with a number for each row, staged, so that it stays the same."""
    return staged(cells.withColumn("_row", F.monotonically_increasing_id()))


def _labels(numbered: DataFrame, eps: float, least: int, image: str, cell: str) -> DataFrame:
    """Rows (row, image, cluster) of the cells that have a place; null for noise."""
    side = eps / math.sqrt(2) * (1 - 1e-12)
    place = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
    rows = numbered.select(F.col(image).alias("image"), F.col(cell).alias("cell"), place("x"), place("y"), F.col("_row").alias("row")).where("x is not null and y is not null")
    rows = staged(rows.withColumn("square", _square(side)))
    boxes = staged(_boxes(rows, "square"))
    dense = boxes.where(F.col("n") >= least)
    points = staged(rows.join(boxes.select("square", (F.col("n") >= least).alias("dense")), "square"))

    sq = F.col("square")
    around = F.explode(F.array(*[F.struct(sq["image"].alias("image"), (sq["i"] + i).alias("i"), (sq["j"] + j).alias("j")) for i, j in _AROUND])).alias("square")
    sparse = points.where("not dense").select("row", F.col("square").alias("own"), "x", "y", around)
    others = points.select("square", F.col("row").alias("q"), F.col("x").alias("qx"), F.col("y").alias("qy"), "dense")
    near = (F.col("x") - F.col("qx")) ** 2 + (F.col("y") - F.col("qy")) ** 2 <= eps * eps
    met = sparse.join(others, "square").where(near).groupBy("row", "own", "square", F.when(~F.col("dense"), F.col("q")).alias("q")).agg(F.count(F.lit(1)).alias("n"))
    met = staged(met)
    core = staged(met.groupBy("row").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("row"))
    # of each sparse cell, the squares that hold core cells near it
    sure = met.where("q is null").select("row", "own", "square")
    touched = staged(sure.unionByName(met.where("q is not null").join(core.select(F.col("row").alias("q")), "q", "left_semi").select("row", "own", "square")).distinct())
    links = touched.join(core, "row", "left_semi").select(F.col("own").alias("a"), F.col("square").alias("b")).where("a <> b").distinct()
    part = staged(components(_dense_links(points.where("dense"), dense, links, eps, side)))

    cores = points.where("dense").select("square", "cell", "row").unionByName(points.where("not dense").join(core, "row", "left_semi").select("square", "cell", "row"))
    by_square = cores.groupBy("square").agg(F.min("cell").alias("cell")).join(part.withColumnRenamed("node", "square"), "square", "left")
    by_square = staged(by_square.select("square", "cell", F.coalesce("part", "square").alias("part")))
    names = by_square.groupBy("part").agg(F.min("cell").alias("cluster"))
    named = staged(by_square.join(names, "part").select("square", "cluster"))
    of_core = cores.join(named, "square").select("row", "cluster")
    border = touched.join(core, "row", "left_anti").join(named, "square").groupBy("row").agg(F.min("cluster").alias("cluster"))
    return rows.join(of_core.unionByName(border), "row", "left").select("row", "image", "cluster")


def density_clusters(cells: DataFrame, eps: float = 500.0, least: int = 10, image: str = "image_id", cell: str = "cell_id") -> DataFrame:
    """``cells`` with ``cluster``: the smallest id among the core cells of the cluster, null for noise."""
    numbered = _numbered(cells)
    found = _labels(numbered, eps, least, image, cell).select(F.col("row").alias("_of"), "cluster")
    return numbered.join(found, F.col("_row") == F.col("_of"), "left").drop("_row", "_of")


def dense_cells(cells: DataFrame, eps: float = 500.0, least: int = 10, share: float = 0.1, image: str = "image_id", cell: str = "cell_id") -> DataFrame:
    """``cells`` without noise and without clusters under ``share`` of the largest of their image."""
    if not 0 <= share <= 1:
        raise ValueError("share must be between 0 and 1")
    numbered = _numbered(cells)
    found = staged(_labels(numbered, eps, least, image, cell).where("cluster is not null"))
    sizes = staged(found.groupBy("image", "cluster").agg(F.count(F.lit(1)).alias("n")))
    top = sizes.groupBy(F.col("image").alias("of")).agg(F.max("n").alias("most"))
    large = sizes.join(top, F.col("image").eqNullSafe(F.col("of"))).where(F.col("n") >= share * F.col("most")).select(F.col("image").alias("of"), F.col("cluster").alias("kept"))
    stay = found.join(large, F.col("image").eqNullSafe(F.col("of")) & (F.col("cluster") == F.col("kept"))).select(F.col("row").alias("_row"))
    return numbered.join(stay, "_row", "left_semi").drop("_row")
