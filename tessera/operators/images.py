"""Background of slide thumbnails: which tiles hold no tissue."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import rasters

# Fixed values, on a hue, saturation and value scale of 0 to 255: ranges (low, high) of bright glass,
# then of ink and dark artifacts.
GLASS = (((0, 255), (0, 15), (215, 255)), ((0, 255), (0, 5), (245, 255)), ((25, 180), (0, 55), (229, 255)))
ARTIFACT = (((25, 180), (0, 255), (0, 220)), ((0, 255), (0, 225), (0, 70)))
#: Share of background pixels over which a tile is background, and the pixels a side at which it is taken.
MOST, ANALYSIS = 0.5, 100


def hsv(rgb: np.ndarray) -> np.ndarray:
    """Hue, saturation and value of 8-bit pixels, each from 0 to 255."""
    x = rgb.astype(float)
    top, low = x.max(-1), x.min(-1)
    span = top - low
    safe = np.where(span > 0, span, 1)
    r, g, b = ((top - x[..., i]) / safe for i in range(3))
    hue = np.where(x[..., 0] == top, b - g, np.where(x[..., 1] == top, 2 + r - b, 4 + g - r)) / 6 % 1
    sat = np.where(top > 0, span / np.where(top > 0, top, 1), 0)
    return np.stack([np.where(span > 0, hue * 255, 0), sat * 255, top], -1).astype(np.int64)


def in_ranges(pixels: np.ndarray, ranges: tuple) -> np.ndarray:
    hit = np.zeros(pixels.shape[:2], bool)
    for bounds in ranges:
        hit |= np.logical_and.reduce([(lo <= pixels[..., i]) & (pixels[..., i] <= hi) for i, (lo, hi) in enumerate(bounds)])
    return hit


def smoothed(mask: np.ndarray, size: int = 5) -> np.ndarray:
    """The median over a square window, the border repeated: for a mask, its majority."""
    pad = np.pad(mask.astype(np.int64), size // 2, mode="edge")
    total = np.pad(pad, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    window = total[size:, size:] - total[:-size, size:] - total[size:, :-size] + total[:-size, :-size]
    return window > size * size // 2


def background_mask(rgb: np.ndarray) -> np.ndarray:
    pixels = hsv(rgb)
    return smoothed(in_ranges(pixels, GLASS) | in_ranges(pixels, ARTIFACT))


def background_fraction(rgb: np.ndarray) -> float:
    """Share of a tile's region that is bright glass or near a piece of ink, at ``ANALYSIS`` pixels a side."""
    pixels = hsv(rasters.resize(rgb, ANALYSIS, ANALYSIS, rasters.cubic, 2.0))
    return rasters.rejected_share(in_ranges(pixels, GLASS), in_ranges(pixels, ARTIFACT))


def tile_background(thumbnails: DataFrame, tiles: DataFrame) -> DataFrame:
    """(image_id, tile_id, tile_background) of tiles, from thumbnails (image_id, height, width, rgb).

    Tiles are placed on the thumbnail by the extent of all tiles of the image. A tile's region is
    resampled to a fixed size, cleaned, and judged by ``background_fraction``; one without a pixel, and
    one of which more than half is background, is background. A task holds one thumbnail at a time.
    """
    box = F.struct("tile_id", "tile_x", "tile_y", "tile_width", "tile_height")
    placed = tiles.groupBy("image_id").agg(F.array_sort(F.collect_list(box)).alias("tiles"), F.max(F.col("tile_x") + F.col("tile_width")).alias("right"), F.max(F.col("tile_y") + F.col("tile_height")).alias("bottom"))

    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                whole = np.frombuffer(r.rgb, np.uint8).reshape(r.height, r.width, 3)
                sx, sy, out = r.width / r.right, r.height / r.bottom, []
                for t in r.tiles:
                    x0, y0 = int(np.floor(t["tile_x"] * sx)), int(np.floor(t["tile_y"] * sy))
                    x1, y1 = min(r.width, int(np.ceil((t["tile_x"] + t["tile_width"]) * sx))), min(r.height, int(np.ceil((t["tile_y"] + t["tile_height"]) * sy)))
                    region = whole[max(0, y0) : y1, max(0, x0) : x1]
                    out.append((r.image_id, t["tile_id"], bool(not region.size or background_fraction(region) > MOST)))
                yield pd.DataFrame(out, columns=["image_id", "tile_id", "tile_background"])

    kind = tiles.schema["image_id"].dataType.simpleString()
    return thumbnails.join(placed, "image_id").mapInPandas(judge, f"image_id {kind}, tile_id long, tile_background boolean")


def _reach(size: int) -> tuple[int, int]:
    """Pixels before and after the middle of a window of ``size``; an even one reaches back further."""
    return -(size // 2), size - size // 2 - 1


def _squares(pixels: DataFrame, columns: Sequence[str], size: int, total: Callable[[str], Column]) -> DataFrame:
    """Each column's aggregate over the square around a pixel: along rows, then along columns.

    Windows run within a row or a column of one image, whatever the number of images.
    """
    low, high = _reach(size)
    for fixed, along in (("row", "col"), ("col", "row")):
        near = Window.partitionBy("image_id", fixed).orderBy(along).rangeBetween(low, high)
        pixels = pixels.withColumns({c: total(c).over(near) for c in columns})
    return pixels


def eroded(pixels: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """Flags that hold over the whole square around a pixel. ``pixels``: (image_id, row, col, flags)."""
    return _squares(pixels, columns, size, F.bool_and)


def dilated(pixels: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """Flags that hold anywhere in the square around a pixel."""
    return _squares(pixels, columns, size, F.bool_or)


def median_flags(pixels: DataFrame, columns: Sequence[str], size: int, side: int) -> DataFrame:
    """The more frequent value of the odd square around a pixel of a ``side`` x ``side`` image.

    Pixels beyond an edge mirror those within it.
    """
    reach = size // 2
    rows = pixels.withColumns({c: F.col(c).cast("int") for c in columns})
    for axis in ("row", "col"):
        place = F.col(axis)
        mirrors = F.array(place, F.when(place < reach, -1 - place), F.when(place >= side - reach, 2 * side - 1 - place))
        rows = rows.withColumn(axis, F.explode(F.array_compact(mirrors)))
    inside = F.col("row").between(0, side - 1) & F.col("col").between(0, side - 1)
    sums = _squares(rows, columns, size, F.sum).where(inside)
    return sums.withColumns({c: F.col(c) * 2 > size * size for c in columns})


def background_share(pixels: DataFrame, side: int, median: int = 5, erode: int = 20, erode_ink: int = 10, dilate_ink: int = 100) -> DataFrame:
    """(image_id, share): pixels of a tile that are background or near a large enough piece of ink.

    ``pixels``: (image_id, row, col, background, ink), every pixel of each ``side`` x ``side`` tile.
    """
    clean = eroded(median_flags(pixels, ["background"], median, side), ["background"], erode)
    marked = dilated(eroded(clean, ["ink"], erode_ink), ["ink"], dilate_ink)
    return marked.groupBy("image_id").agg((F.count_if(F.col("background") | F.col("ink")) / F.count(F.lit(1))).alias("share"))
