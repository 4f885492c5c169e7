"""Arrays in NumPy's file format as tables: by ranges of rows, and by headers alone.

A file of any size is read by as many tasks as it has ranges; a task seeks to its range and holds a
batch of rows. Shapes come from the headers. Paths are of any store that pyarrow opens (local and
shared folders, HDFS, object stores); arrays of Python objects are refused, nothing is unpickled.
"""

from __future__ import annotations

import math
import posixpath
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.sources.storage import staged

#: Rows of a range, of a batch, and of a written file, at most.
RANGE, BATCH, ROWS = 65_536, 1_024, 4_096


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def listed(path: str, suffix: str = ".npy") -> list[str]:
    """Files at or below ``path``, sorted."""
    store, where = opened(path)
    info = store.get_file_info(where)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = store.get_file_info(fs.FileSelector(where, recursive=True))
    root = path.rstrip("/")
    return sorted(root + f.path[len(where.rstrip("/")) :] for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


def header(f: pa.NativeFile) -> tuple[tuple[int, ...], np.dtype, int]:
    """Shape, type and where the numbers begin."""
    version = np.lib.format.read_magic(f)
    read = {(1, 0): np.lib.format.read_array_header_1_0, (2, 0): np.lib.format.read_array_header_2_0}.get(version)
    if read is None:
        raise ValueError(f"npy version {version} is not known")
    shape, by_column, kind = read(f)
    if kind.hasobject:
        raise ValueError("arrays of objects are not read")
    if by_column and len(shape) > 1:
        raise ValueError("arrays stored by column are not read")
    return shape, kind, f.tell()


def shape_of(path: str) -> tuple[tuple[int, ...], np.dtype, int]:
    store, where = opened(path)
    with store.open_input_file(where) as f:
        return header(f)


def array_shapes(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_rows, width, dtype) of every array at or below ``path``; no numbers are read."""

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = [(p, *shape_of(p)[:2]) for p in part["path"]]
            yield pd.DataFrame([(p, s[0] if s else 1, math.prod(s[1:]), str(k)) for p, s, k in found], columns=["path", "n_rows", "width", "dtype"])

    files = listed(path)
    return spark.createDataFrame([(p,) for p in files], "path string").repartition(max(1, min(len(files), 64))).mapInPandas(shapes, "path string, n_rows long, width long, dtype string")


class _Range(InputPartition):
    def __init__(self, path: str, low: int, high: int):
        self.path, self.low, self.high = path, low, high


class _Reader(DataSourceReader):
    def __init__(self, path: str, rows: int):
        self.path, self.rows = path, rows

    def partitions(self) -> Sequence[InputPartition]:
        out = []
        for p in listed(self.path):
            n = shape_of(p)[0]
            out += [_Range(p, low, min(low + self.rows, n[0] if n else 1)) for low in range(0, n[0] if n else 1, self.rows)]
        return out or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, where = opened(partition.path)
        with store.open_input_file(where) as f:
            shape, kind, begin = header(f)
            width = math.prod(shape[1:])
            for low in range(partition.low, partition.high, BATCH):
                n = min(BATCH, partition.high - low)
                f.seek(begin + low * width * kind.itemsize)
                values = np.frombuffer(f.read(n * width * kind.itemsize), kind).astype(np.float64)
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * width)
                columns = [pa.array([partition.path] * n), pa.array(np.arange(low, low + n)), pa.ListArray.from_arrays(ends, pa.array(values))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "row", "features"])


class NpySource(DataSource):
    """``spark.read.format("npy").load(path)``: rows (path, row, features); option ``rows`` of a range."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return "path string, row long, features array<double>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("rows", RANGE)))


def read_arrays(spark: SparkSession, path: str, rows: int = RANGE) -> DataFrame:
    """Rows (path, row, features) of every array at or below ``path``; further dimensions are laid flat."""
    spark.dataSource.register(NpySource)
    return spark.read.format("npy").option("rows", rows).load(path)


def write_features(tiles: DataFrame, folder: str, kind: str = "<f4") -> DataFrame:
    """Write ``tiles`` (image_id, tile_id, features) as arrays below ``folder``, and return what was
    written: (image_id, chunk, n_rows, width).

    A file holds the rows of at most ``ROWS`` tile numbers of one image, in order, beside one with
    the numbers themselves. A task that is repeated writes the same files again; a file appears
    under its name only when it is whole. Features of unequal length are an error.
    """
    of = tiles.schema["image_id"].dataType.simpleString()

    def put(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("tile_id", kind="stable")
        image, chunk = part["image_id"].iloc[0], int(part["chunk"].iloc[0])
        store, root = opened(folder)
        where = posixpath.join(root, f"image_id={image}")
        store.create_dir(where, recursive=True)
        features = np.stack(part["features"].to_numpy()).astype(kind)
        for name, x in (("features", features), ("tiles", part["tile_id"].to_numpy("<i8"))):
            raw = pa.BufferOutputStream()
            np.lib.format.write_array(raw, np.ascontiguousarray(x), allow_pickle=False)
            path = posixpath.join(where, f"{name}-{chunk:06d}.npy")
            with store.open_output_stream(path + ".part") as out:
                out.write(raw.getvalue())
            store.move(path + ".part", path)
        return pd.DataFrame({"image_id": [image], "chunk": [chunk], "n_rows": [len(part)], "width": [features.shape[1]]})

    chunks = tiles.select("image_id", "tile_id", "features", F.floor(F.col("tile_id") / ROWS).alias("chunk"))
    return staged(chunks.groupBy("image_id", "chunk").applyInPandas(put, f"image_id {of}, chunk long, n_rows long, width long"), "arrays")


def read_features(spark: SparkSession, folder: str, image_type: str = "long") -> DataFrame:
    """(image_id, tile_id, features) of what ``write_features`` wrote."""
    rows = read_arrays(spark, folder)
    file = F.regexp_extract("path", r"/image_id=([^/]+)/(features|tiles)-(\d+)\.npy$", 0)
    named = rows.select(F.regexp_extract("path", r"/image_id=([^/]+)/", 1).cast(image_type).alias("image_id"), F.regexp_extract(file, r"(features|tiles)-", 1).alias("kind"), F.regexp_extract(file, r"-(\d+)\.npy", 1).alias("chunk"), "row", "features")
    keys = ["image_id", "chunk", "row"]
    numbers = named.where("kind = 'tiles'").select(*keys, F.col("features")[0].cast("long").alias("tile_id"))
    return named.where("kind = 'features'").join(numbers, keys).select("image_id", "tile_id", "features")
