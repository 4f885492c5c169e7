"""Cohort tables derived from the given star-schema tables, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tile width and height of the lattice that the cells fall on, and tiles on a side.
TILE, SIDE = 100, 4


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _long(c: Column) -> Column:
    return c.cast("long")


def image_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    key = c["c_custkey"]
    return c.select(
        _long(key).alias("image_id"), _long(key % 300).alias("patient_id"), F.when(c["c_acctbal"] < 0, 1).otherwise(0).alias("recurred"),
        c["c_mktsegment"].alias("stage"), c["c_nationkey"].cast("int").alias("dataset"), _long(1000 + 8 * (key % 50)).alias("image_width"),
        _long(800 + 8 * (key % 25)).alias("image_height"), (0.25 + 0.25 * (key % 3)).cast("double").alias("image_mpp"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read(spark, sf_dir, "lineitem")
    x = t["l_partkey"] % 400
    kind = F.when(t["l_returnflag"] == "A", "Neoplastic").when((t["l_returnflag"] == "R") & (x > 100 + 4 * (t["l_orderkey"] % 50)), "Inflammatory").otherwise("Connective")
    return t.select(
        _long(t["l_orderkey"] % 50).alias("image_id"), _long(t["l_orderkey"] * 10 + t["l_linenumber"]).alias("cell_id"), x.cast("double").alias("x"),
        (t["l_suppkey"] * 4 % 400).cast("double").alias("y"), kind.alias("cell_type"), ((t["l_returnflag"] == "A") & (t["l_quantity"] >= 48)).alias("is_mitotic"),
    )


def tile_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    ordinal = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    return e.select(_long(e["user_id"]).alias("image_id"), _long(ordinal).alias("tile_id"), e["value"].alias("attention"), e["event_type"].alias("cluster"))


def fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    fold = (e["event_id"] % 5).cast("int")
    rows = e.where(e["user_id"] % 20 != e["event_id"] % 5).groupBy(_long(e["user_id"]).alias("image_id"), fold.alias("fold"))
    return rows.agg(F.round(F.avg("value") / 997.0, 10).alias("risk_score"))


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = read(spark, sf_dir, "events").select(_long(F.col("user_id")).alias("image_id")).distinct()
    rows = images.select("image_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("fold"))
    return rows.withColumn("split", F.when(F.col("image_id") % 5 == F.col("fold"), "test").otherwise("train"))


def tile_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return e.select(
        _long(e["vec_id"] % 20).alias("image_id"), _long(F.floor(e["vec_id"] / 20.0)).alias("tile_id"), e["embedding"].alias("features"),
        (e["label"] == 9).alias("tile_background"), e["label"].cast("int").alias("cluster"),
    )


def lattice(images: DataFrame) -> DataFrame:
    """The tiles of each image: a square lattice from the origin."""
    side = F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1)))
    rows = images.select("image_id", side.alias("tile_row")).select("image_id", "tile_row", side.alias("tile_col"))
    return rows.select("image_id", _long(F.col("tile_row") * SIDE + F.col("tile_col")).alias("tile_id"), _long(F.col("tile_col") * TILE).alias("tile_x"), _long(F.col("tile_row") * TILE).alias("tile_y"))


#: The views as SQL for the checking engine.
SQL = {
    "image_metadata": """select cast(c_custkey as bigint) as image_id, cast(c_custkey % 300 as bigint) as patient_id,
 cast(case when c_acctbal < 0 then 1 else 0 end as int) as recurred, c_mktsegment as stage, cast(c_nationkey as int) as dataset,
 cast(1000 + 8 * (c_custkey % 50) as bigint) as image_width, cast(800 + 8 * (c_custkey % 25) as bigint) as image_height,
 0.25e0 + 0.25e0 * (c_custkey % 3) as image_mpp from customer""",
    "cells": """select cast(l_orderkey % 50 as bigint) as image_id, cast(l_orderkey * 10 + l_linenumber as bigint) as cell_id,
 cast(l_partkey % 400 as double) as x, cast(l_suppkey * 4 % 400 as double) as y,
 case when l_returnflag = 'A' then 'Neoplastic' when l_returnflag = 'R' and (l_partkey % 400) > 100 + 4 * (l_orderkey % 50) then 'Inflammatory'
 else 'Connective' end as cell_type, (l_returnflag = 'A' and l_quantity >= 48) as is_mitotic from lineitem""",
    "tile_attention": """select cast(user_id as bigint) as image_id, cast(row_number() over (partition by user_id order by event_id) - 1 as bigint) as tile_id,
 value as attention, event_type as cluster from events""",
    "fold_scores": """select cast(user_id as bigint) as image_id, cast(event_id % 5 as int) as fold, round(avg(value) / 997.0e0, 10) as risk_score
 from events where user_id % 20 <> event_id % 5 group by user_id, event_id % 5""",
    "splits": """select m.image_id, cast(f.fold as int) as fold, case when m.image_id % 5 = f.fold then 'test' else 'train' end as split
 from (select distinct cast(user_id as bigint) as image_id from events) m cross join (select unnest(range(5)) as fold) f""",
    "tile_embeddings": """select cast(vec_id % 20 as bigint) as image_id, cast(floor(vec_id / 20.0e0) as bigint) as tile_id, embedding as features,
 (label = 9) as tile_background, cast(label as int) as cluster from embeddings""",
    "lattice": """select i.image_id, cast(r.k * 4 + c.k as bigint) as tile_id, cast(c.k * 100 as bigint) as tile_x, cast(r.k * 100 as bigint) as tile_y
 from (select distinct image_id from cells) i cross join (select unnest(range(4)) as k) r cross join (select unnest(range(4)) as k) c""",
}


def with_views(*names: str) -> str:
    """The head of a statement over the named views."""
    return "with " + ",\n".join(f"{n} as ({SQL[n]})" for n in names)
