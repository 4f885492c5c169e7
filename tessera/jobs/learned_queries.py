"""Queries that fit models, follow streams, or go through files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import attention, clustering, communities, concepts, density, folds, morphology, pooling, stats, tables, tiles, vectors
from tessera.sources import analogues as A
from tessera.sources import arrays, dictionary, storage
from tessera.sources.analogues import with_views
from tessera.streaming import cells as streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


@query()
def pca_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tiles.foreground(A.tile_embeddings(spark, sf_dir))
    mean, parts, _ = clustering.pca_fit(rows, 8)
    return clustering.pca_project(rows, mean, parts).select("image_id", "tile_id", F.transform("features", lambda x: F.round(x, 6)).alias("features"))


@query()
def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tiles.foreground(A.tile_embeddings(spark, sf_dir))
    return vectors.nearest_centroid(rows, clustering.spherical_kmeans(rows, 12)).select("image_id", "tile_id", "cluster", r("similarity"))


@query()
def morphology_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of tiles and their presence in each image."""
    rows = clustering.morphology(tiles.foreground(A.tile_embeddings(spark, sf_dir)), 24, 4, 1.0)
    weighted = vectors.cosine_weights(rows, vectors.centroids(rows))
    return attention.presence(weighted, "cos_weight").select("image_id", "cluster", r("weighted_count"), r("weighted_presence"), "hard_count", r("hard_frac"))


@query("with c as (select cast(c_custkey as bigint) as node, cast(c_custkey // 8 as bigint) as part, (select count(*) from customer) / 8 / 4.0e0 as r from customer) select unnest([r, r / 2]) as resolution, node, min(node) over (partition by part) as community from c")
def customer_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communities of a graph of known parts: eight customers of neighbouring keys know each other well,
    each part a little the next. Both resolutions lie where the parts are the best communities."""
    nodes = A.read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("node"))
    ahead = nodes.select(F.col("node").alias("src"), F.explode(F.sequence(F.col("node") + 1, F.floor(F.col("node") / 8) * 8 + 8)).alias("dst"))
    weight = F.when(F.floor(F.col("src") / 8) == F.floor(F.col("dst") / 8), 1.0).otherwise(0.1)
    edges = ahead.where((F.col("dst") % 8 != 0) | (F.col("src") % 8 == 7)).withColumn("weight", weight)
    r0 = nodes.count() / 8 / 4
    return communities.communities(nodes, edges, [r0, r0 / 2])


#: Core cells, what each reaches, and the cluster of each cell by its smallest core cell. Ids repeat, so rows are numbered.
DENSE = (
    with_views("cells").replace("with ", "with recursive ", 1)
    + """, tumour as materialized (select row_number() over (order by image_id, cell_id, x, y) as k, image_id, cell_id, x, y, cell_type from cells where cell_type = 'Neoplastic'),
 near as materialized (select a.k as a, b.k as b from tumour a join tumour b on a.image_id = b.image_id and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 400),
 core as (select a from near group by a having count(*) >= 5),
 link as materialized (select n.a, n.b from near n join core c on c.a = n.a join core d on d.a = n.b),
 reach as (select a as k, a as root from core union select l.b, r.root from reach r join link l on l.a = r.k),
 part as (select r.k, min(t.cell_id) as cluster from reach r join tumour t on t.k = r.root group by r.k),
 own as (select n.a as k, min(p.cluster) filter (where n.a = n.b) as as_core, min(p.cluster) as as_border from near n left join part p on p.k = n.b group by n.a),
 found as (select t.*, coalesce(as_core, as_border) as cluster from tumour t left join own using (k))
"""
)


@query(DENSE + "select image_id, cell_id, cluster from found")
def density_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of each tumour cell, null for noise."""
    cells = A.cells(spark, sf_dir).where("cell_type = 'Neoplastic'")
    return density.density_clusters(cells, eps=20.0, least=5).select("image_id", "cell_id", "cluster")


@query(DENSE + ", sizes as (select image_id, cluster, count(*) as n from found where cluster is not null group by all), top as (select image_id, max(n) as most from sizes group by image_id) select image_id, cell_id, x, y, cell_type from found join sizes using (image_id, cluster) join top using (image_id) where n >= 0.1e0 * most")
def dense_cell_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = A.cells(spark, sf_dir).select("image_id", "cell_id", "x", "y", "cell_type")
    return density.dense_cells(cells.where("cell_type = 'Neoplastic'"), eps=20.0, least=5)


@query()
def mil_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bags scored by the model of the fold that held them out; a fifth of the train images stops training."""
    bags = tiles.foreground(A.tile_embeddings(spark, sf_dir)).select("image_id", "tile_id", "features")
    images = bags.select("image_id").distinct()
    labels = images.select("image_id", (F.col("image_id") % 2).cast("int").alias("recurred"))
    splits = storage.staged(folds.carve_validation(folds.expand_flat(images.select("image_id", F.floor(F.col("image_id") % 4 / 2).cast("int").alias("fold")), 2), 0.2))
    models = pooling.train(bags, labels, splits, "recurred")
    return folds.out_of_fold(pooling.score(bags, models), splits).select("image_id", r("risk_score"), "fold")


@query()
def concept_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tile_embeddings(spark, sf_dir)
    pooled = rows.select("image_id", F.posexplode("features").alias("k", "x")).groupBy("image_id", "k").agg(F.avg(F.col("x").cast("double")).alias("x"))
    pooled = pooled.groupBy("image_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda s: s["x"]).alias("embedding"))
    labels = A.image_metadata(spark, sf_dir).select("image_id", F.col("stage").alias("path_stage"), F.col("image_width").cast("double").alias("path_thickness"), (F.col("image_id") % 2).alias("path_ulceration"))
    columns = [c for c in labels.columns if c.startswith("path_")]
    models = concepts.fit(pooled, labels.join(pooled.select("image_id"), "image_id", "left_semi"), columns)
    return concepts.shared_out(concepts.predict(pooled, models)).select("image_id", "concept", r("value", 4), r("std", 4))


@query(
    with_views("image_metadata")
    + """select image_id, stage, recurred, 'a+b' as model, image_mpp as size_mm from image_metadata"""
)
def hive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written by partition and read back as a tree with typed folders and a default."""
    folder = storage.shared_folder(spark, "tree")
    images = A.image_metadata(spark, sf_dir).select("image_id", "stage", "recurred", F.col("image_mpp").alias("size_mm"))
    storage.write_table(images, folder, ["size_mm"])
    return storage.scan_hive(spark, folder, defaults={"model": "a+b"})


@query(with_views("tile_embeddings") + "select image_id, tile_id, round(list_sum(list_transform(features, lambda x: cast(x as double))), 4) as total, round(cast(features[1] as double), 6) as first from tile_embeddings")
def array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written as arrays of an image's tiles, and read back by ranges of rows."""
    folder = storage.shared_folder(spark, "arrays")
    arrays.write_features(A.tile_embeddings(spark, sf_dir).select("image_id", "tile_id", "features"), folder)
    found = arrays.read_features(spark, folder)
    return found.select("image_id", "tile_id", F.round(F.aggregate("features", F.lit(0.0), lambda s, x: s + x), 4).alias("total"), F.round(F.get("features", F.lit(0)), 6).alias("first"))


@query(with_views("cells") + "select image_id, cell_type, x, y, count(*) as n from cells group by all")
def geojson_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells through detection documents and back."""
    found = storage.geojson_cells(storage.to_geojson(A.cells(spark, sf_dir)))
    return found.groupBy("image_id", "cell_type", "x", "y").agg(F.count(F.lit(1)).alias("n"))


@query(with_views("fold_scores") + "select image_id, fold, case when fold < 2 then -1.0e0 else risk_score end as risk_score from fold_scores")
def parts_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of some units replaced, the others left."""
    folder = storage.shared_folder(spark, "parts")
    rows = A.fold_scores(spark, sf_dir).withColumn("unit", F.concat_ws("-", "image_id", "fold"))
    storage.write_parts(rows, folder, "unit", 8)
    storage.write_parts(rows.where("fold < 2").withColumn("risk_score", F.lit(-1.0)), folder, "unit", 8)
    return storage.read_parts(spark, folder).select("image_id", "fold", "risk_score")


@query(with_views("fold_scores", "splits") + "select s.image_id, s.fold from splits s left join fold_scores f using (image_id, fold) where f.risk_score is null")
def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = A.fold_scores(spark, sf_dir).withColumn("status", F.lit("done"))
    return storage.pending(A.splits(spark, sf_dir).select("image_id", "fold"), done, ["image_id", "fold"])


STAGES = ("BUILDING", "MACHINERY", "AUTOMOBILE")


@query("select 'c_mktsegment' as \"column\", c_mktsegment as value, count(*) as n from customer where c_mktsegment not in ('BUILDING', 'MACHINERY', 'AUTOMOBILE') group by all")
def dictionary_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"c_mktsegment": {"type": "categorical", "values": STAGES}, "c_custkey": {"type": "integer"}}
    return dictionary.violations(A.read(spark, sf_dir, "customer"), columns)


@query(
    """select time_bucket(interval '1 hour', cast(ts as timestamp), timestamp '2000-01-01') as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all"""
)
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed totals by hour and type, drained to a table."""
    schema = A.read(spark, sf_dir, "events").schema
    folder = storage.shared_folder(spark, "stream")
    events = streams.event_stream(spark, f"{sf_dir}/events.parquet*", schema)
    out = streams.windowed_totals(events, "ts", "value", "event_type", "1 hour", "3650 days")
    return streams.drained(out, folder, "complete").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    with_views("fold_scores", "image_metadata")
    + """, s as (select f.image_id, f.fold, f.risk_score, m.recurred from fold_scores f join image_metadata m using (image_id)),
 cut as (select fold, quantile_cont(risk_score, 0.467) as lo, quantile_cont(risk_score, 0.832) as hi from s group by fold)
 select s.fold, case when risk_score < lo then 'low' when risk_score < hi then 'mid' else 'high' end as risk_group, count(*) as n, cast(sum(recurred) as bigint) as n_recurred from s join cut using (fold) group by all"""
)
def risk_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.fold_scores(spark, sf_dir).join(A.image_metadata(spark, sf_dir).select("image_id", "recurred"), "image_id")
    cuts = rows.groupBy("fold").agg(F.percentile("risk_score", F.lit(0.467)).alias("lo"), F.percentile("risk_score", F.lit(0.832)).alias("hi"))
    group = F.when(F.col("risk_score") < F.col("lo"), "low").when(F.col("risk_score") < F.col("hi"), "mid").otherwise("high")
    return rows.join(cuts, "fold").groupBy("fold", group.alias("risk_group")).agg(F.count(F.lit(1)).alias("n"), F.sum("recurred").cast("long").alias("n_recurred"))


@query(
    with_views("fold_scores", "image_metadata")
    + """select m.image_id, m.recurred, min_by(f.risk_score, f.fold) as risk_score from image_metadata m left join fold_scores f using (image_id) group by all"""
)
def risk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = A.image_metadata(spark, sf_dir).select("image_id", "recurred")
    return tables.first_match(images, A.fold_scores(spark, sf_dir), "image_id", "fold", "risk_score")


@query()
def morphology_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk of each image from the clusters of its tiles, by the fold that held it out, with the number of
    its tiles and clusters there."""
    seen = A.tile_attention(spark, sf_dir).select("image_id", "tile_id", "attention")
    rows = tiles.foreground(A.tile_embeddings(spark, sf_dir)).select("image_id", "tile_id", "features").join(seen, ["image_id", "tile_id"], "left").withColumn("attention", F.coalesce(F.abs("attention"), F.lit(0.5)))
    images = rows.select("image_id").distinct()
    labels = images.select("image_id", (F.col("image_id") % 2).cast("int").alias("recurred"))
    splits = folds.expand_flat(images.select("image_id", F.floor(F.col("image_id") % 4 / 2).cast("int").alias("fold")), 2)
    clusters, presence, risks = morphology.infer(rows, labels, splits, 2, "recurred", k=24, neighbours=4)
    sizes = clusters.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_tiles"), F.count_distinct("cluster").alias("n_clusters"))
    shares = presence.groupBy("image_id").agg(F.round(F.sum("weighted_presence"), 6).alias("total_presence"))
    return risks.join(sizes, "image_id").join(shares, "image_id").select("image_id", "fold", r("risk_score"), "n_tiles", "n_clusters", "total_presence")


@query()
def cluster_resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of tiles at several resolutions: how many, and the tiles of the largest."""
    rows = clustering.morphology_multi(tiles.foreground(A.tile_embeddings(spark, sf_dir)), 24, 4, [0.5, 1.0, 1.5, 2.0, 3.0])
    per = rows.groupBy("resolution", "cluster").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("resolution").agg(F.count(F.lit(1)).alias("n_clusters"), F.max("n").alias("largest"), F.sum("n").alias("n_tiles"))


@query()
def cluster_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How alike the clusters of two seeds are."""
    return clustering.stability(tiles.foreground(A.tile_embeddings(spark, sf_dir)), 24, 4, 1.0, seeds=(0, 1)).select("run_a", "run_b", "n_rows", r("ari"), r("ami"))


@query()
def cluster_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Association of learned clusters with an outcome, adjusted for their number."""
    rows = clustering.morphology(tiles.foreground(A.tile_embeddings(spark, sf_dir)), 24, 4, 1.0)
    shares = attention.presence(vectors.cosine_weights(rows, vectors.centroids(rows)), "cos_weight").select("image_id", "cluster", "weighted_presence")
    tests = stats.mann_whitney(shares.withColumn("recurred", (F.col("image_id") % 2).cast("int")), "weighted_presence", "recurred", ["cluster"])
    return stats.benjamini_hochberg(stats.with_p_values(tests)).select("cluster", "n1", "n0", r("u1"), r("effect_r"), r("p_value"), r("p_adjusted"))
