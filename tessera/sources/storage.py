"""Reading and writing tables: formats, Hive-style trees, parts, status."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.scalar import hive_value, slide_stem

SLIDE_SUFFIXES = ("svs", "tif", "tiff", "ndpi", "vms", "vmu", "scn", "mrxs", "svslide", "bif", "dcm", "czi", "png")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """A table written once and read back, for results that several jobs take: nothing before it
    runs again, and it outlives executors. The folder may go once the final result is written."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file: path and text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), form: str = "parquet") -> None:
    """Write a table; a task's files appear only when the job commits."""
    writer = df.write.mode("overwrite").partitionBy(*by)
    (writer.option("header", True).csv if form == "csv" else writer.parquet)(path)


def write_parts(df: DataFrame, path: str, unit: str = "image_id", buckets: int = 64) -> None:
    """Replace the parts of the units in ``df`` and leave all others.

    Units fall into buckets by hash, so a cohort has few folders; a bucket is rewritten with what
    it had of other units.
    """
    spark = df.sparkSession
    fresh = df.withColumn("bucket", F.pmod(F.xxhash64(unit), F.lit(buckets)).cast("int"))
    if exists(spark, path):
        held = spark.read.parquet(path)
        touched = fresh.select("bucket").distinct()
        rest = held.join(F.broadcast(touched), "bucket", "left_semi").join(fresh.select(unit).distinct(), unit, "left_anti")
        copy = shared_folder(spark, "parts")
        fresh.unionByName(rest, allowMissingColumns=True).write.parquet(copy)
        fresh = spark.read.parquet(copy)
    fresh.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def read_parts(spark: SparkSession, path: str, ids: DataFrame | None = None, unit: str = "image_id") -> DataFrame:
    rows = spark.read.parquet(path).drop("bucket")
    return rows.join(ids.select(unit).distinct(), unit, "left_semi") if ids is not None else rows


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def pending(units: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Units that are still to do."""
    return units.join(done.where("status = 'done'").select(*keys).distinct(), list(keys), "left_anti")


def scan_hive(spark: SparkSession, root: str, form: str = "parquet", name: str = "*", defaults: Mapping[str, object] | None = None) -> DataFrame:
    """All files below ``root``, with typed columns from ``key=value`` folders.

    A column in a file goes before a folder of the same name; defaults fill columns that neither has.
    """
    reader = spark.read.option("basePath", root).option("pathGlobFilter", name).option("mergeSchema", True)
    rows = reader.option("header", True).option("inferSchema", True).csv(root) if form == "csv" else reader.parquet(root)
    for key, value in (defaults or {}).items():
        rows = rows if key in rows.columns else rows.withColumn(key, F.lit(value))
    return rows


def partition_filter(values: Mapping[str, object]) -> Column:
    """Rows of one partition, compared in the values' one spelling."""
    out = F.lit(True)
    for key, value in values.items():
        out = out & (F.col(key).cast("string") == hive_value(value))
    return out


def slide_index(spark: SparkSession, root: str, suffixes: Sequence[str] = SLIDE_SUFFIXES) -> DataFrame:
    """(image_id, wsi_path) of the slides below ``root``; ignored folders are left out.

    Only names are listed: the contents column is not asked for, so no file is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    wanted = F.lower("path").rlike(r"[.](" + "|".join(suffixes) + ")$") & ~F.contains("path", F.lit("/_ignore/"))
    return files.where(wanted).select(slide_stem(F.col("path")).alias("image_id"), F.col("path").alias("wsi_path"))


def dataset_table(images: DataFrame, slides: DataFrame) -> DataFrame:
    """Metadata with the path of each slide, empty where there is none; an id with two slides is an error."""
    several = F.raise_error(F.concat(F.lit("several slides have the id "), F.col("image_id").cast("string"))).cast("string")
    slides = slides.groupBy("image_id").agg(F.min("wsi_path").alias("_path"), F.count(F.lit(1)).alias("_n")).select("image_id", F.when(F.col("_n") > 1, several).otherwise(F.col("_path")).alias("wsi_path"))
    return images.join(slides, "image_id", "left").withColumn("wsi_path", F.coalesce("wsi_path", F.lit("")))


GEOJSON = "struct<features:array<struct<geometry:struct<type:string,coordinates:array<array<double>>>,properties:struct<classification:struct<name:string>>>>>"


def geojson_cells(documents: DataFrame, id_col: str = "image_id", text_col: str = "text") -> DataFrame:
    """One row for each cell of detection documents: (image, ordinal, x, y, cell_type).

    Features are point sets with a class; other shapes and points that are not finite are dropped,
    a third coordinate is ignored, and a missing class is ``unknown``.
    """
    feature = documents.select(id_col, F.posexplode(F.from_json(text_col, GEOJSON)["features"]).alias("f", "feature"))
    points = feature.where("feature.geometry.type = 'MultiPoint'").select(id_col, "f", F.coalesce("feature.properties.classification.name", F.lit("unknown")).alias("cell_type"), F.posexplode("feature.geometry.coordinates").alias("p", "xy"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = points.select(id_col, "f", "p", F.get("xy", F.lit(0)).alias("x"), F.get("xy", F.lit(1)).alias("y"), "cell_type")
    return rows.where(finite(F.col("x")) & finite(F.col("y"))).select(id_col, F.concat_ws("_", "f", "p").alias("cell_id"), "x", "y", "cell_type")


def to_geojson(cells: DataFrame, id_col: str = "image_id") -> DataFrame:
    """The reverse: a document for each image with a point set for each class."""
    points = cells.groupBy(id_col, "cell_type").agg(F.collect_list(F.array("x", "y")).alias("xy"))
    feature = F.struct(F.struct(F.lit("MultiPoint").alias("type"), F.col("xy").alias("coordinates")).alias("geometry"), F.struct(F.struct(F.col("cell_type").alias("name")).alias("classification")).alias("properties"))
    return points.groupBy(id_col).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("text"))


def manifest(files: Mapping[str, bytes], **meta: object) -> str:
    """A bundle's manifest: the digest of each file. It is written last, so it marks completeness."""
    return json.dumps(meta | {"files": {k: hashlib.sha256(v).hexdigest() for k, v in sorted(files.items())}}, sort_keys=True)


def verified(files: Mapping[str, bytes], text: str) -> Mapping[str, bytes]:
    """The files of a bundle if they are what the manifest says."""
    wrong = [k for k, digest in json.loads(text)["files"].items() if hashlib.sha256(files.get(k, b"")).hexdigest() != digest]
    if wrong:
        raise ValueError(f"files that differ from the manifest: {wrong}")
    return files
