"""Rasters in blocks: windows around cells, resampling, and the blocks of a slide.

A raster is rows (image_id, block_row, block_col, height, width, rgb): blocks of ``side`` x ``side``
8-bit pixels from the upper left, smaller at the right and lower edges, so that no task needs a whole
slide. Results that take pixels of several blocks are put together from the parts that each block
gives; how many blocks that are depends on sizes alone, not on the slide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tessera.sources.storage import staged

#: Bits of the fixed-point weights of resampling, so that sums of parts are exact whatever their order.
BITS = 22
#: Output columns or rows that meet in a row of the result of a pass.
STRIP = 64
#: Cells whose patches are cut together.
CELLS = 256


def pixels(rgb: bytes, height: int, width: int) -> np.ndarray:
    return np.frombuffer(rgb, np.uint8).reshape(height, width, 3)


def triangle(x: np.ndarray) -> np.ndarray:
    return np.maximum(0, 1 - np.abs(x))


def cubic(x: np.ndarray) -> np.ndarray:
    """Cubic convolution with the slope -1/2."""
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0))


def resample_weights(size: int, new: int, kernel: Callable[[np.ndarray], np.ndarray] = triangle, reach: float = 1.0) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each new place the first old one it takes and the fixed-point weights from there on.

    Shrinking widens the kernel, so that every pixel counts."""
    scale = size / new
    wide = max(scale, 1.0)
    first, weights = [], []
    for i in range(new):
        centre = (i + 0.5) * scale
        low, high = max(0, int(centre - reach * wide + 0.5)), min(size, int(centre + reach * wide + 0.5))
        w = kernel((np.arange(low, high) - centre + 0.5) / wide)
        w = w / w.sum() * (1 << BITS)
        first.append(low)
        weights.append(np.trunc(w + np.where(w < 0, -0.5, 0.5)).astype(np.int64))
    return np.array(first), weights


def dense_weights(size: int, new: int, kernel: Callable[[np.ndarray], np.ndarray] = triangle, reach: float = 1.0) -> np.ndarray:
    first, weights = resample_weights(size, new, kernel, reach)
    out = np.zeros((new, size), np.int64)
    for i, (low, w) in enumerate(zip(first, weights, strict=True)):
        out[i, low : low + w.size] = w
    return out


def to_bytes(sums: np.ndarray) -> np.ndarray:
    """Fixed-point sums rounded and held within 8 bits."""
    return np.clip((sums + (1 << BITS - 1)) >> BITS, 0, 255).astype(np.uint8)


def resize(rgb: np.ndarray, height: int, width: int, kernel: Callable[[np.ndarray], np.ndarray] = triangle, reach: float = 1.0) -> np.ndarray:
    """A small image resampled: along rows, rounded to 8 bits, then along columns."""
    across = to_bytes(np.einsum("wi,hic->hwc", dense_weights(rgb.shape[1], width, kernel, reach), rgb.astype(np.int64)))
    return to_bytes(np.einsum("hi,iwc->hwc", dense_weights(rgb.shape[0], height, kernel, reach), across.astype(np.int64)))


def fitted(height: int, width: int, longest: int) -> tuple[int, int]:
    """Height and width of a thumbnail whose longest edge is ``longest``; smaller images stay."""
    if max(height, width) <= longest:
        return height, width
    share = longest / max(height, width)
    return max(1, round(height * share)), max(1, round(width * share))


def _passed(blocks: DataFrame, along: str) -> DataFrame:
    """Blocks (image_id, a block number, height, width, their place ``along`` left or top, full, new, rgb)
    resampled from ``full`` to ``new`` pixels along rows or columns: each block gives its part of every new strip, strips are summed and rounded."""
    kind = blocks.schema["image_id"].dataType.simpleString()
    other = "block_row" if along == "left" else "block_col"

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for r in part.itertuples():
                x = pixels(r.rgb, r.height, r.width).astype(np.int64)
                x = x if along == "left" else x.transpose(1, 0, 2)  # the resampled axis second
                at, n = getattr(r, along), x.shape[1]
                first, weights = resample_weights(r.full, r.new)
                hit = [i for i, w in enumerate(weights) if first[i] < at + n and first[i] + w.size > at]
                for strip in sorted({i // STRIP for i in hit}):
                    own = [i for i in hit if i // STRIP == strip]
                    w = np.zeros((min(STRIP, r.new - strip * STRIP), n), np.int64)
                    for i in own:
                        low, high = max(first[i], at), min(first[i] + weights[i].size, at + n)
                        w[i - strip * STRIP, low - at : high - at] = weights[i][low - first[i] : high - first[i]]
                    sums = np.einsum("wi,hic->hwc", w, x)
                    out.append((r.image_id, getattr(r, other), strip, sums.shape[0], sums.shape[1], r.new, sums.tobytes()))
            yield pd.DataFrame(out, columns=["image_id", "line", "strip", "h", "w", "new", "sums"])

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for r in part.itertuples():
                total = sum(np.frombuffer(s, np.int64) for s in r.all).reshape(r.h, r.w, 3)
                y = to_bytes(total)
                y = y if along == "left" else y.transpose(1, 0, 2)
                out.append((r.image_id, r.line, r.strip, y.shape[0], y.shape[1], y.tobytes()))
            yield pd.DataFrame(out, columns=["image_id", "line", "strip", "height", "width", "rgb"])

    made = blocks.mapInPandas(parts, f"image_id {kind}, line long, strip long, h long, w long, new long, sums binary")
    # a strip takes parts of the blocks that its pixels span, in one line of blocks
    summed = made.groupBy("image_id", "line", "strip", "h", "w").agg(F.collect_list("sums").alias("all"))
    return summed.mapInPandas(added, f"image_id {kind}, line long, strip long, height long, width long, rgb binary")


def thumbnails(blocks: DataFrame, side: int, longest: int = 2048) -> DataFrame:
    """(image_id, block_row, block_col, height, width, rgb): each image shrunk until its longest edge is
    ``longest``, as blocks of ``STRIP`` pixels; images that are no longer stay in size.

    Rows first, rounded to 8 bits, then columns, with a triangle as wide as the scale. Both passes are
    sums over blocks in fixed-point integers, so the numbers are those of resizing the whole at once.
    """
    extent = blocks.groupBy("image_id").agg((F.max(F.col("block_row") * side + F.col("height"))).alias("full_height"), F.max(F.col("block_col") * side + F.col("width")).alias("full_width"))
    most = F.greatest("full_height", "full_width")
    new = lambda c: F.when(most <= longest, F.col(c)).otherwise(F.greatest(F.lit(1), F.bround(F.col(c) * F.lit(float(longest)) / most).cast("long"))).cast("long")
    extent = extent.select("image_id", "full_height", "full_width", new("full_height").alias("new_height"), new("full_width").alias("new_width"))
    rows = blocks.join(extent, "image_id").withColumns({"left": F.col("block_col") * side, "full": F.col("full_width"), "new": F.col("new_width")})
    across = _passed(rows.select("image_id", "block_row", "height", "width", "left", "full", "new", "rgb"), "left")
    down = across.join(extent, "image_id").select("image_id", F.col("strip").alias("block_col"), "height", "width", (F.col("line") * side).alias("top"), F.col("full_height").alias("full"), F.col("new_height").alias("new"), "rgb")
    out = _passed(down, "top")
    return out.select("image_id", F.col("strip").alias("block_row"), F.col("line").alias("block_col"), "height", "width", "rgb")


def patches(blocks: DataFrame, cells: DataFrame, side: int, size: int = 64) -> DataFrame:
    """``cells`` (image_id, x, y, ...) with ``rgb``: the ``size`` x ``size`` pixels around each cell's rounded
    place, black beyond the slide.

    Cells meet the blocks that a window may touch by the block of its upper left corner, about
    ``CELLS`` at a time, so pixels are moved once for each block and corner, at most (size / side + 2)
    squared times, and never for each cell. Cells without a place have a black patch.
    """
    left, top = F.rint("x").cast("long") - size // 2, F.rint("y").cast("long") - size // 2
    rows = staged(cells.select(*cells.columns, left.alias("_left"), top.alias("_top"), F.monotonically_increasing_id().alias("_row")))
    placed = rows.where("_left is not null and _top is not null").withColumns({"_block_row": F.floor(F.col("_top") / side), "_block_col": F.floor(F.col("_left") / side)})
    corner = ["image_id", "_block_row", "_block_col"]
    sizes = staged(placed.groupBy(corner).agg(F.ceil(F.count(F.lit(1)) / CELLS).alias("_parts")))
    part = F.pmod(F.xxhash64("_row"), F.col("_parts")).alias("_part")
    groups = placed.join(sizes, corner).groupBy(*corner, part).agg(F.collect_list(F.struct("_left", "_top", *cells.columns)).alias("_cells"))

    more = (size + side - 2) // side  # blocks that a window reaches beyond its first
    back = lambda c: F.explode(F.sequence(F.col(c).cast("long") - more, F.col(c).cast("long")))
    copies = blocks.withColumn("_block_row", back("block_row")).withColumn("_block_col", back("block_col")).join(sizes.select(corner), corner, "left_semi")
    around = copies.groupBy(corner).agg(F.collect_list(F.struct("block_row", "block_col", "height", "width", "rgb")).alias("_blocks"))
    names = [*cells.columns, "rgb"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, col = batch.column("_block_row")[i].as_py(), batch.column("_block_col")[i].as_py()
                field = np.zeros(((more + 1) * side, (more + 1) * side, 3), np.uint8)
                for b in batch.column("_blocks")[i].as_py() or []:
                    y, x = (b["block_row"] - row) * side, (b["block_col"] - col) * side
                    field[y : y + b["height"], x : x + b["width"]] = pixels(b["rgb"], b["height"], b["width"])
                lefts, tops, *columns = batch.column("_cells").slice(i, 1).flatten().flatten()
                found = [field[y : y + size, x : x + size].tobytes() for y, x in zip((tops.to_numpy() - row * side).tolist(), (lefts.to_numpy() - col * side).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], names=names)

    kind = StructType([*cells.schema.fields, StructField("rgb", BinaryType())])
    joined = groups.join(around.hint("merge"), corner, "left").select("_block_row", "_block_col", "_blocks", "_cells")
    black = rows.where("_left is null or _top is null").select(*cells.columns, F.lit(bytearray(size * size * 3)).alias("rgb"))
    return joined.mapInArrow(cut, kind).unionByName(black)


def _window(flags: np.ndarray, size: int) -> np.ndarray:
    """How many flags hold in the square around each pixel, by running sums; nothing beyond the edges."""
    low, high = size // 2, size - size // 2 - 1
    total = np.pad(flags.astype(np.int64), ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    h, w = flags.shape
    y, x = np.arange(h)[:, None], np.arange(w)[None]
    y0, y1, x0, x1 = np.maximum(y - low, 0), np.minimum(y + high + 1, h), np.maximum(x - low, 0), np.minimum(x + high + 1, w)
    return total[y1, x1] - total[y0, x1] - total[y1, x0] + total[y0, x0], (y1 - y0) * (x1 - x0)


def eroded(flags: np.ndarray, size: int) -> np.ndarray:
    n, area = _window(flags, size)
    return n == area


def dilated(flags: np.ndarray, size: int) -> np.ndarray:
    return _window(flags, size)[0] > 0


def median(flags: np.ndarray, size: int) -> np.ndarray:
    """The more frequent value around a pixel; beyond an edge the pixels within it, mirrored."""
    n, _ = _window(np.pad(flags, size // 2, mode="symmetric"), size)
    inner = slice(size // 2, -(size // 2))
    return n[inner, inner] * 2 > size * size


def rejected_share(background: np.ndarray, ink: np.ndarray, smooth: int = 5, erode: int = 20, erode_ink: int = 10, dilate_ink: int = 100) -> float:
    """Share of a tile that is background, or near a large enough piece of ink."""
    return float((eroded(median(background, smooth), erode) | dilated(eroded(ink, erode_ink), dilate_ink)).mean())


def rejected_shares(masks: DataFrame, side: int = 100, smooth: int = 5, erode: int = 20, erode_ink: int = 10, dilate_ink: int = 100) -> DataFrame:
    """(image_id, share) of ``masks`` (image_id, background, ink): of each tile of ``side`` x ``side``
    pixels the places (row * side + col) of either kind, as arrays. A row is a tile."""
    kind = masks.schema["image_id"].dataType.simpleString()

    def flags(places: np.ndarray | None) -> np.ndarray:
        out = np.zeros(side * side, bool)
        out[np.asarray([] if places is None else places, np.int64)] = True
        return out.reshape(side, side)

    def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"image_id": part["image_id"], "share": [rejected_share(flags(b), flags(i), smooth, erode, erode_ink, dilate_ink) for b, i in zip(part["background"], part["ink"], strict=True)]})

    return masks.select("image_id", "background", "ink").mapInPandas(shares, f"image_id {kind}, share double")
