"""Running counts over arriving files; an extension, as batch jobs have no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import floor_bin


def event_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Parquet files as they arrive, a few at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(folder)


def windowed_totals(events: DataFrame, time: str, value: str, by: str, window: str, delay: str) -> DataFrame:
    """Count and sum by time window; rows later than ``delay`` are dropped and state is let go."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", delay)
    sums = timed.groupBy(F.window("_t", window), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return sums.select(F.col("window.start").alias("window_start"), by, "n", "total")


def tile_totals(cells: DataFrame, width: int) -> DataFrame:
    """Running counts of cells by image and tile."""
    return cells.groupBy("image_id", floor_bin("x", 0, width).alias("tile_x"), floor_bin("y", 0, width).alias("tile_y")).agg(F.count(F.lit(1)).alias("n_cells"))


def drained(stream: DataFrame, folder: str, mode: str) -> DataFrame:
    """Run a stream over what is there, into files that are read back.

    In complete mode each batch writes the whole result so far to a folder of its own, and the last
    one is read; a batch that is repeated after a failure writes its folder again.
    """
    spark = stream.sparkSession
    done = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
    last = f"{folder}/rows"
    if mode == "complete":
        batches: list[int] = []

        def put(rows: DataFrame, batch: int) -> None:
            rows.write.mode("overwrite").parquet(f"{folder}/rows-{batch}")
            batches.append(batch)

        query = done.foreachBatch(put).start()
        query.awaitTermination()
        if not batches:
            return spark.createDataFrame([], stream.schema)
        last = f"{folder}/rows-{max(batches)}"
    else:
        query = done.format("parquet").option("path", last).start()
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(last)
