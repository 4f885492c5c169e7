"""Queries of outcome models, concept bottlenecks, training bags and checks of tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalar
from tessera.operators import attention, bags, bottleneck, cellular, clustering, folds, outcomes, pooling, rasters, tables, tiles, vectors
from tessera.sources import analogues as A
from tessera.sources import storage
from tessera.sources.analogues import with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r(name: str, digits: int = 8):
    return F.round(name, digits).alias(name)


def uniform_sql(text: str) -> str:
    return f"(cast('0x' || substr(md5({text}), 1, 13) as bigint) / 4503599627370496.0e0)"


# Checks and small tables


@query("select quality as recurred, count(*) as n from labels where quality is not null and quality not in (0, 1) group by 1 union all select 2, count(*) from labels where doc_id % 7 = 0 having count(*) > 0")
def label_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.read(spark, sf_dir, "labels").select(F.col("quality").cast("int").alias("recurred"))
    wrong = A.read(spark, sf_dir, "labels").where("doc_id % 7 = 0").select(F.lit(2).alias("recurred"))
    return tables.label_violations(rows.unionByName(wrong), "recurred")


@query(with_views("image_metadata") + "select image_id, patient_id, case when image_id % 4 = 0 then null else recurred end as recurred, stage, image_width, image_height, image_mpp from image_metadata where image_id % 4 <> 0")
def labelled_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows alone, without the column that says where they come from."""
    rows = A.image_metadata(spark, sf_dir).withColumn("recurred", F.when(F.col("image_id") % 4 != 0, F.col("recurred")))
    return tables.without_provenance(tables.labelled(rows, "recurred"))


@query(
    """with d as (select n_nationkey % 20 as dataset_id from nation), a as (select r_regionkey * 4 as augmentation, r_regionkey * 5 as source_dataset_id from region union all select 99, 77)
 select a.*, count(d.dataset_id) as n_owners, count(d.dataset_id) = 1 as ok from a left join d on d.dataset_id = a.source_dataset_id group by a.augmentation, a.source_dataset_id"""
)
def augmentation_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets = A.read(spark, sf_dir, "nation").select((F.col("n_nationkey") % 20).alias("dataset_id"))
    region = A.read(spark, sf_dir, "region").select((F.col("r_regionkey") * 4).alias("augmentation"), (F.col("r_regionkey") * 5).alias("source_dataset_id"))
    other = spark.range(1).select(F.lit(99).alias("augmentation"), F.lit(77).alias("source_dataset_id"))
    return tables.owners(region.unionByName(other), datasets)


@query(with_views("tile_attention") + "select image_id, min_by(cluster, tile_id) as cluster, min_by(attention, tile_id) as attention, count(*) as n_tiles from tile_attention group by image_id")
def first_by_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.first_and_count(A.tile_attention(spark, sf_dir), "image_id", "tile_id", ["cluster", "attention"])


@query(with_views("tile_attention") + "select * from tile_attention where tile_id >= 3 and tile_id < 7")
def tile_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.tile_slice(A.tile_attention(spark, sf_dir), 3, 7)


@query(with_views("cells", "lattice") + "select l.image_id, l.tile_id, l.tile_x, l.tile_y, coalesce(c.cluster, -1) as cluster from lattice l left join (select image_id, cast(image_id % 16 as bigint) as tile_id, cast(count(*) % 7 as int) as cluster from cells group by 1, 2) c using (image_id, tile_id)")
def cluster_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole grid with clusters, -1 where a tile has none."""
    cells = A.cells(spark, sf_dir)
    known = cells.groupBy("image_id", (F.col("image_id") % 16).alias("tile_id")).agg((F.count(F.lit(1)) % 7).cast("int").alias("cluster"))
    return tiles.cluster_map(A.lattice(cells.select("image_id").distinct()), known)


@query(
    with_views("image_metadata")
    + """select image_id, case when image_id % 3 = 0 then (case when image_id % 2 = 0 then 0.5e0 else 0.25e0 end) else image_mpp end as image_mpp,
 case when image_id % 3 <> 0 then 'image' when image_id % 2 = 0 then 'metadata' else 'default' end as mpp_from from image_metadata"""
)
def resolution_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.image_metadata(spark, sf_dir).select("image_id", "image_mpp")
    some = rows.where("image_id % 2 = 0").select("image_id", F.lit(0.5).alias("image_mpp"))
    holes = rows.withColumn("image_mpp", F.when(F.col("image_id") % 3 != 0, F.col("image_mpp")).otherwise(F.lit(-1.0)))
    return tiles.resolution(holes, some, 0.25)


@query(with_views("cells") + "select image_id, count(*) filter (where cell_type = 'Neoplastic') as n_tumor, count(*) filter (where cell_type = 'Inflammatory') as n_lymph, count(*) filter (where cell_type in ('Neoplastic', 'Inflammatory')) as n_cells from cells group by image_id")
def cell_total_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = A.cells(spark, sf_dir).groupBy("image_id").agg(F.count_if(F.col("cell_type") == cellular.TUMOUR).alias("n_tumor"), F.count_if(F.col("cell_type") == cellular.LYMPHOCYTE).alias("n_lymph"))
    return cellular.with_totals(by)


@query(
    with_views("image_metadata")
    + """select image_id, 'models/stage=' || stage || case when image_id % 2 = 0 then '/fold=' || (image_id % 5) else '' end || '/run=x/' || image_id || '.bin' as path, stage as parsed_stage,
 case when image_id % 2 = 0 then cast(image_id % 5 as varchar) end as parsed_fold from image_metadata"""
)
def rendered_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths from a template with an optional folder, and the folders read back."""
    rows = A.image_metadata(spark, sf_dir)
    fold = F.when(F.col("image_id") % 2 == 0, F.col("image_id") % 5)
    values = {"stage": F.col("stage"), "fold": fold, "image_id": F.col("image_id")}
    path = scalar.template_path("models/stage={stage}/fold={fold}/{image_id}.bin", values, ["fold"], {"run": F.lit("x")})
    read = scalar.hive_parse(F.col("path"))
    return rows.select("image_id", path.alias("path")).select("image_id", "path", read["stage"].alias("parsed_stage"), F.try_element_at(read, F.lit("fold")).alias("parsed_fold"))


@query(
    with_views("image_metadata")
    + "select g.stage, g.fold, count(m.image_id) as n from (select s.stage, f.fold from (select unnest(['BUILDING', 'MACHINERY']) as stage) s cross join (select unnest(['0', '1', '2']) as fold) f) g left join image_metadata m on m.stage = g.stage and cast(m.image_id % 4 as varchar) = g.fold group by all"
)
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every combination of partition values, with the images that it has."""
    grid = folds.partition_grid(spark, {"stage": ["BUILDING", "MACHINERY"], "fold": [str(f) for f in folds.fold_values(3)]})
    rows = A.image_metadata(spark, sf_dir).select("stage", (F.col("image_id") % 4).cast("string").alias("fold"), "image_id")
    return grid.join(rows, ["stage", "fold"], "left").groupBy("stage", "fold").agg(F.count("image_id").alias("n"))


# Folds and draws


@query(with_views("image_metadata") + "select image_id, cast((row_number() over (order by image_id) - 1) % 5 as int) as fold from image_metadata")
def modulo_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.modulo_folds(A.image_metadata(spark, sf_dir), 5)


@query(
    with_views("image_metadata")
    + """select image_id, case when row_number() over (partition by recurred order by md5(image_id || ':0')) <= round_even(count(*) over (partition by recurred) * 0.2e0, 0) then 'val' else 'train' end as split from image_metadata"""
)
def inner_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.inner_split(A.image_metadata(spark, sf_dir), "recurred", 0.2)


@query(with_views("tile_embeddings") + "select cluster, image_id, tile_id, row_number() over (partition by cluster order by md5(image_id || ':' || tile_id || ':0'), image_id, tile_id) as rank from tile_embeddings qualify rank <= 4")
def random_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few tiles of each cluster, drawn at random but alike on every run."""
    return vectors.drawn(A.tile_embeddings(spark, sf_dir), 4).select("cluster", "image_id", "tile_id", "rank")


BAGS = (
    with_views("tile_embeddings")
    + """, own as (select image_id, tile_id, 'original' as source from tile_embeddings where not tile_background),
 copies as (select image_id, tile_id, unnest(['blur', 'stain']) as source from own where image_id % 3 <> 0 and tile_id % 4 <> 1)
"""
)


def _bags(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    every = A.tile_embeddings(spark, sf_dir)
    copies = every.where("image_id % 3 <> 0 and tile_id % 4 <> 1").select("image_id", "tile_id", F.explode(F.array(F.lit("blur"), F.lit("stain"))).alias("source"), F.transform("features", lambda x: x * 2).alias("features"))
    return bags.training_bags(tiles.foreground(every), copies, mode, 0.3).select("bag_id", "image_id", "tile_id", "source")


@query(
    BAGS
    + f""", take as (select o.*, case when image_id % 3 <> 0 and {uniform_sql("image_id || ':' || tile_id || ':0'")} < 0.3 then (case when {uniform_sql("image_id || ':' || tile_id || ':1'")} < 0.5 then 'blur' else 'stain' end) end as other from own o)
 select cast(image_id as varchar) as bag_id, image_id, tile_id, case when other is not null and tile_id % 4 <> 1 then other else source end as source from take"""
)
def bags_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bags(spark, sf_dir, "replace")


@query(BAGS + f"select cast(image_id as varchar) as bag_id, * from own union all select cast(image_id as varchar), * from copies where {uniform_sql("image_id || ':' || tile_id || ':' || source || ':0'")} < 0.3")
def bags_augmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bags(spark, sf_dir, "augment")


@query(BAGS + "select image_id || ':' || source as bag_id, * from (select * from own union all select * from copies)")
def bags_separate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bags(spark, sf_dir, "separate")


# Vectors and attention


LONG = with_views("tile_embeddings") + ", p as (select image_id, tile_id, unnest(range(len(features))) as k, cast(unnest(features) as double) as x from tile_embeddings)\n"


@query(LONG + "select image_id, tile_id, cast(k as int) as dim, round(x / greatest(sqrt(sum(x * x) over (partition by image_id, tile_id, k >= 16)), 1e-12), 8) as x from p")
def block_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of two encoders, each over its own length."""
    rows = A.tile_embeddings(spark, sf_dir)
    width = len(rows.select("features").first()["features"])
    return rows.select("image_id", "tile_id", F.posexplode(vectors.block_unit("features", [16, width - 16])).alias("dim", "x")).withColumn("x", F.round("x", 8))


@query(LONG + ", m as (select k, avg(x) as mean, stddev_pop(x) as s from p group by k) select image_id * 100000 + tile_id as image_id, cast(k as int) as dim, round((x - mean) / (case when s > 0 then s else 1 end), 6) as z from p join m using (k)")
def standardised_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tile_embeddings(spark, sf_dir).select((F.col("image_id") * 100000 + F.col("tile_id")).alias("image_id"), "features")
    return vectors.standardised(rows).select("image_id", "dim", r("z", 6))


@query(with_views("tile_embeddings") + "select image_id, tile_id, case when tile_id % 11 = 0 then 'empty' when tile_id % 11 = 1 then 'width' else 'not finite' end as problem from tile_embeddings where tile_id % 11 < 3")
def vector_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tile_embeddings(spark, sf_dir)
    width = len(rows.select("features").first()["features"])
    part, wild = F.slice("features", 1, 3), F.transform("features", lambda x: F.when(x == F.element_at("features", 1), float("nan")).otherwise(x))
    kind = F.col("tile_id") % 11
    broken = rows.withColumn("features", F.when(kind == 0, F.lit(None)).when(kind == 1, part).when(kind == 2, wild).otherwise(F.col("features")))
    return vectors.problems(broken, width).select("image_id", "tile_id", "problem")


@query(LONG + ", v as (select cast(k as int) as dim, var_pop(x) as variance from p group by k) select dim, round(sum(variance) over (order by dim) / sum(variance) over (), 8) as cumulative from v")
def cumulative_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = A.tile_embeddings(spark, sf_dir).select(F.posexplode("features").alias("dim", "x")).groupBy("dim").agg(F.var_pop(F.col("x").cast("double")).alias("variance"))
    return vectors.cumulative_share(parts, "dim", "variance").select("dim", r("cumulative"))


@query(with_views("tile_attention") + "select image_id, tile_id, attention * (tile_id % 5 - 2) as hybrid from tile_attention")
def hybrid_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tile_attention(spark, sf_dir).withColumn("gradient", F.col("tile_id") % 5 - 2)
    return rows.select("image_id", "tile_id", attention.hybrid("attention", "gradient").alias("hybrid"))


@query(
    with_views("tile_embeddings")
    + """, t as (select row_number() over () as n, features from tile_embeddings where not tile_background),
 p as (select n, unnest(range(len(features))) as i, cast(unnest(features) as double) as x from t),
 u as (select n, i, x / greatest(sqrt(sum(x * x) over (partition by n)), 1e-12) as x from p),
 m as (select *, avg(x) over (partition by i) as mean from u),
 c as (select a.i, b.i as j, sum((a.x - a.mean) * (b.x - b.mean)) as v from m a join m b using (n) group by a.i, b.i)
 select cast(i as int) as dim, round(any_value(mean), 6) as mean, round((select sum(v * v) / pow(sum(v) filter (where i = j), 2) from c), 6) as concentration from m group by i"""
)
def pca_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean that a projection takes off, and the sum of the squared shares of variance of all its
    components, which the covariances alone tell too."""
    rows = tiles.foreground(A.tile_embeddings(spark, sf_dir))
    width = len(rows.select("features").first()["features"])
    mean, _, share = clustering.pca_fit(rows, width)
    whole = float((share * share).sum())
    return spark.createDataFrame([(i, round(float(v), 6), round(whole, 6)) for i, v in enumerate(mean)], "dim int, mean double, concentration double")


# Rasters


RASTER = (
    with_views("cells")
    + """, pixel as (select i.image_id, cast(a.k as int) as row, cast(b.k as int) as col from (select distinct image_id from cells) i cross join (select unnest(range(100)) as k) a cross join (select unnest(range(100)) as k) b),
 seen as (select distinct image_id, cast(floor(y / 40) as int) as r, cast(floor(x / 40) as int) as c from cells where cell_type = 'Neoplastic' and is_mitotic),
 flags as (select p.*, s.r is null as background, row + col < p.image_id % 40 as ink from pixel p left join seen s on s.image_id = p.image_id and s.r = p.row // 10 and s.c = p.col // 10),
 mirrored as (select image_id, unnest([row, case when row < 2 then -1 - row end, case when row >= 98 then 199 - row end]) as row, col, background from flags),
 edged as (select image_id, row, unnest([col, case when col < 2 then -1 - col end, case when col >= 98 then 199 - col end]) as col, background from mirrored where row is not null),
 m1 as (select image_id, row, col, sum(cast(background as int)) over (partition by image_id, row order by col range between 2 preceding and 2 following) as n from edged where col is not null),
 m2 as (select image_id, row, col, sum(n) over (partition by image_id, col order by row range between 2 preceding and 2 following) as n from m1),
 m3 as (select image_id, row, col, n * 2 > 25 as background from m2 where row between 0 and 99 and col between 0 and 99),
 e1 as (select image_id, row, col, bool_and(background) over (partition by image_id, row order by col range between 10 preceding and 9 following) as background from m3),
 e2 as (select image_id, row, col, bool_and(background) over (partition by image_id, col order by row range between 10 preceding and 9 following) as background from e1),
 i1 as (select image_id, row, col, bool_and(ink) over (partition by image_id, row order by col range between 5 preceding and 4 following) as ink from flags),
 i2 as (select image_id, row, col, bool_and(ink) over (partition by image_id, col order by row range between 5 preceding and 4 following) as ink from i1),
 d1 as (select image_id, row, col, bool_or(ink) over (partition by image_id, row order by col range between 50 preceding and 49 following) as ink from i2),
 d2 as (select image_id, row, col, bool_or(ink) over (partition by image_id, col order by row range between 50 preceding and 49 following) as ink from d1)
"""
)


@query(RASTER + "select image_id, round(count(*) filter (where e2.background or d2.ink) / count(*), 8) as share from e2 join d2 using (image_id, row, col) group by image_id")
def background_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each image's raster that is background or near a piece of ink, at the usual sizes.

    Mitotic tumour cells paint squares of 10 pixels as tissue, and a corner is ink."""
    cells = A.cells(spark, sf_dir)
    square = (F.floor(F.col("y") / 40) * 10 + F.floor(F.col("x") / 40)).cast("int")
    tissue = F.collect_set(F.when((F.col("cell_type") == "Neoplastic") & F.col("is_mitotic"), square))
    seen = cells.groupBy("image_id").agg(tissue.alias("tissue"))  # at most a number for each square
    every = F.sequence(F.lit(0), F.lit(100 * 100 - 1))
    of = lambda p: (F.floor(p / 1000) * 10 + F.floor(p % 100 / 10)).cast("int")
    ink = F.filter(every, lambda p: F.floor(p / 100) + p % 100 < F.col("image_id") % 40)
    masks = seen.select("image_id", F.filter(every, lambda p: ~F.array_contains("tissue", of(p))).alias("background"), ink.alias("ink"))
    return rasters.rejected_shares(masks, 100).select("image_id", r("share"))


#: Patches of 64 pixels on rasters of 400 x 400 whose red, green and blue follow a rule of place and image.
PATCHES = (
    with_views("cells")
    + """, own as (select row_number() over (order by image_id, cell_id, x, y) as k, image_id, cell_id, x, y from cells where cell_type = 'Neoplastic' and is_mitotic),
 w as (select own.*, a.i, b.j, cast(round_even(x, 0) as bigint) - 32 + b.j as px, cast(round_even(y, 0) as bigint) - 32 + a.i as py from own cross join (select unnest(range(64)) as i) a cross join (select unnest(range(64)) as j) b),
 v as (select *, px between 0 and 399 and py between 0 and 399 as inside from w)
"""
)


@query(
    PATCHES
    + """select image_id, cell_id, x, y, cast(sum(case when inside then (px * 7 + py * 3 + image_id) % 251 * (1 + (i * 64 + j) % 97) else 0 end) as bigint) as red,
 cast(sum(case when inside then (px * 5 + py * 11) % 241 * (1 + (i * 64 + j) % 97) else 0 end) as bigint) as green, cast(sum(case when inside then (px + py * image_id) % 239 * (1 + (i * 64 + j) % 97) else 0 end) as bigint) as blue
 from v group by k, image_id, cell_id, x, y"""
)
def mitosis_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches around cells, each told by sums of its pixels weighted by their place."""
    cells = A.cells(spark, sf_dir)
    side, full = 128, 400

    def painted(batches):
        for part in batches:
            out = []
            for t in part.itertuples():
                y, x = np.mgrid[t.block_row * side : min((t.block_row + 1) * side, full), t.block_col * side : min((t.block_col + 1) * side, full)]
                rgb = np.stack([(x * 7 + y * 3 + t.image_id) % 251, (x * 5 + y * 11) % 241, (x + y * t.image_id) % 239], -1).astype(np.uint8)
                out.append((t.image_id, t.block_row, t.block_col, rgb.shape[0], rgb.shape[1], rgb.tobytes()))
            yield pd.DataFrame(out, columns=["image_id", "block_row", "block_col", "height", "width", "rgb"])

    def told(batches):
        weight = 1 + np.arange(64 * 64) % 97
        for part in batches:
            sums = [weight @ np.frombuffer(b, np.uint8).reshape(-1, 3).astype(np.int64) for b in part["rgb"]]
            yield part[["image_id", "cell_id", "x", "y"]].assign(**{c: [int(s[i]) for s in sums] for i, c in enumerate(("red", "green", "blue"))})

    number = F.explode(F.sequence(F.lit(0), F.lit((full - 1) // side)))
    blocks = cells.select("image_id").distinct().select("image_id", number.alias("block_row")).select("image_id", "block_row", number.alias("block_col"))
    blocks = blocks.mapInPandas(painted, "image_id long, block_row int, block_col int, height int, width int, rgb binary")
    found = rasters.patches(blocks, cells.where("cell_type = 'Neoplastic' and is_mitotic").select("image_id", "cell_id", "x", "y"), side)
    return found.mapInPandas(told, "image_id long, cell_id long, x double, y double, red long, green long, blue long")


# Models: what SQL can state of their results


def _presence_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    seen = A.tile_attention(spark, sf_dir)
    names = sorted(x[0] for x in seen.select("cluster").distinct().collect())
    wide = attention.presence_wide(seen, "attention", names)
    vectors_ = wide.select("image_id", F.array(*wide.columns[1:]).alias("features"))
    return vectors_, A.image_metadata(spark, sf_dir).select("image_id", "recurred"), names


OUTCOMES = with_views("tile_attention") + ", ids as (select distinct image_id from tile_attention)"


@query()
def outcome_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold probabilities by each kind of model, in two folds. 20 trees and 10 rounds of
    boosting, where the operator's defaults are 500 and 300, keep the query short."""
    rows, labels, _ = _presence_vectors(spark, sf_dir)
    rows = storage.staged(rows)
    splits = folds.expand_flat(rows.select("image_id", (F.col("image_id") % 2).cast("int").alias("fold")), 2)
    parts = []
    for kind in outcomes.KINDS:
        scores = outcomes.fold_scores(rows, labels, splits, 2, "recurred", kind, trees=20, rounds=10)
        parts.append(folds.out_of_fold(scores, splits).select("image_id", "fold", F.lit(kind).alias("kind"), r("risk_score", 6)))
    return tables.union_all(*parts)


#: The L2 logistic model by accelerated steps along the gradient, in SQL: standardised shares ``x``, class
#: weights ``w``, and 4,000 rounds from 0; the intercept, the last term, is not penalised.
LOGISTIC = (
    with_views("tile_attention", "image_metadata").replace("with ", "with recursive ", 1)
    + """, share as (select image_id, cluster, sum(attention) as a from tile_attention group by all),
 names as (select cluster, row_number() over (order by cluster) as j from (select distinct cluster from tile_attention)),
 wide as (select i.image_id, n.j, coalesce(s.a, 0) / greatest(sum(coalesce(s.a, 0)) over (partition by i.image_id), 1e-12) as x
   from (select distinct image_id from tile_attention) i cross join names n left join share s on s.image_id = i.image_id and s.cluster = n.cluster),
 y as (select image_id, cast(recurred as double) as y, count(*) over () / (2.0e0 * count(*) over (partition by recurred)) as w from image_metadata join (select distinct image_id from tile_attention) using (image_id)),
 z as (select image_id, j, (x - avg(x) over (partition by j)) / (case when stddev_pop(x) over (partition by j) > 0 then stddev_pop(x) over (partition by j) else 1 end) as x from wide join y using (image_id)),
 data as materialized (select z.image_id, list(x order by j) || [1.0e0] as x, any_value(y) as y, any_value(w) as w from z join y using (image_id) group by z.image_id),
 size as (select 1 / (1 + sum(w * list_dot_product(x, x)) / 4) as step, max(len(x)) as d from data),
 run as (
   select 0 as i, list_transform(range(d), lambda k: 0.0e0) as b, list_transform(range(d), lambda k: 0.0e0) as v, 1.0e0 as t, step from size
   union all
   select i + 1, moved, list_transform(range(len(b)), lambda k: moved[k + 1] + (t - 1) / ((1 + sqrt(1 + 4 * t * t)) / 2) * (moved[k + 1] - b[k + 1])), (1 + sqrt(1 + 4 * t * t)) / 2, step
   from (select i, b, v, t, step, list_transform(range(len(v)), lambda k: v[k + 1] - step * (g[k + 1] + case when k + 1 < len(v) then v[k + 1] else 0 end)) as moved
     from (select i, b, v, t, step, (select list(total order by k) from (select k, sum(e * term) as total from (
         select w * (1 / (1 + exp(-list_dot_product(x, run.v))) - y) as e, unnest(x) as term, unnest(range(len(x))) as k from data) group by k)) as g from run where i < 4000))
 )
"""
)


@query(
    LOGISTIC
    + """, last as (select b from run where i = 4000), flat as (select unnest(b) as b, unnest(range(len(b))) as k from last)
 select coalesce(n.cluster, 'intercept') as term, round(b, 4) as weight, round(exp(b), 4) as odds_ratio from flat left join names n on n.j = k + 1"""
)
def logistic_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of a penalised logistic model of the presence of clusters, the intercept last."""
    rows, labels, names = _presence_vectors(spark, sf_dir)
    model, _ = outcomes.fit(rows.join(labels, "image_id"), "recurred", "logreg_l2")
    return spark.createDataFrame(outcomes.coefficients(model, names), "term string, weight double, odds_ratio double").select("term", r("weight", 4), r("odds_ratio", 4))


@query()
def concept_bottleneck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk as a sum of what concepts say and of what the embedding says of the rest."""
    e = A.read(spark, sf_dir, "embeddings")
    part = lambda i: F.get("embedding", F.lit(i)).cast("double")
    rows = e.select(F.col("vec_id").alias("image_id"), "embedding", F.array(F.col("label").cast("double"), F.pmod("vec_id", F.lit(7)).cast("double")).alias("concepts"), (part(0) + 0.5 * part(1) + 0.1 * F.col("label")).alias("risk"))
    rows = rows.join(folds.modulo_folds(rows, 5), "image_id")
    out = bottleneck.predict(rows, bottleneck.fit(rows, "concepts", "embedding", "risk"), "concepts", "embedding")
    return out.select("image_id", "fold", r("risk", 6), r("concept_risk_score", 6), r("concept_risk_score_residual", 6), r("risk_score", 6))


#: Gated attention by the rule of ``Pooling.of_rule`` with two branches of three units: each tile's logit ``s``,
#: share, and the logit's derivative ``q`` by a factor on the tile; ``c`` is the length of a branch's weights.
POOLED = (
    with_views("tile_embeddings")
    + """, t as (select image_id, tile_id, cast(cluster as varchar) as cluster, features from tile_embeddings where not tile_background),
 x as (select image_id, tile_id, unnest(range(len(features))) as i, cast(unnest(features) as double) as x, sqrt(len(features)) as d from t),
 kh as (select k.k, h.h from (select unnest(range(2)) as k) k cross join (select unnest(range(3)) as h) h),
 vu as (select image_id, tile_id, k, h, sum(x * sin(1 + 3 * k + 5 * h + 7 * i) / d) as v, sum(x * cos(2 + 5 * k + 3 * h + 11 * i) / d) as u from x cross join kh group by all),
 s as (select image_id, tile_id, k, sum(sin(1 + k + 2 * h) * tanh(v) / (1 + exp(-u))) as s,
   sum(sin(1 + k + 2 * h) * ((1 - tanh(v) * tanh(v)) * v / (1 + exp(-u)) + tanh(v) * u * exp(-u) / ((1 + exp(-u)) * (1 + exp(-u))))) as q from vu group by all),
 c as (select image_id, tile_id, k, sum(x * cos(k + 2 * i) / d) as share, sqrt(sum(cos(k + 2 * i) * cos(k + 2 * i) / (d * d))) as c from x cross join (select unnest(range(2)) as k) k group by all),
 a as (select *, exp(s) / sum(exp(s)) over (partition by image_id, k) as a from s join c using (image_id, tile_id, k) join t using (image_id, tile_id)),
 m as (select *, sum(a * share) over (partition by image_id, k) as m, c / (sum(c) over (partition by image_id, tile_id) + 1e-8) as b from a),
 z as (select image_id, 0.1e0 + sum(a * share) as z from a group by image_id)
"""
)


def _pooled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = tiles.foreground(A.tile_embeddings(spark, sf_dir)).select("image_id", "tile_id", "features", "cluster")
    width = len(rows.select("features").first()["features"])
    model = pooling.Pooling.of_rule(width, 2, 3)
    return rows, spark.createDataFrame([(0, bytearray(model.dump()))], "fold int, model binary")


@query(POOLED + "select image_id, cast(0 as int) as fold, round(1 / (1 + exp(-z)), 8) as risk_score from z")
def pooled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of bags by a given model."""
    return pooling.score(*_pooled(spark, sf_dir)).select("image_id", "fold", r("risk_score"))


@query(POOLED + "select image_id, tile_id, cast(0 as int) as fold, round(sum(b * a), 8) as attention, round(sum(a * (share + (share - m) * q)), 8) as gradient from m group by image_id, tile_id")
def tile_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each tile weighs in its image's score, and the score's slope in it."""
    return pooling.attributions(*_pooled(spark, sf_dir)).select("image_id", "tile_id", "fold", r("attention"), r("gradient"))


@query(
    POOLED
    + """, pairs as (select distinct image_id, cluster from t),
 rest as (select p.image_id, p.cluster, a.k, sum(exp(a.s) * a.share) / sum(exp(a.s)) as m, count(*) as n from pairs p join a on a.image_id = p.image_id and a.cluster <> p.cluster group by all),
 sizes as (select image_id, count(*) as n_tiles from t group by image_id)
 select image_id, cluster, cast(0 as int) as fold, n_tiles - any_value(n) as n_removed, n_tiles, round(1 / (1 + exp(-any_value(z))), 8) as p_full, round(1 / (1 + exp(-0.1e0 - sum(m))), 8) as p_without,
 round(1 / (1 + exp(-any_value(z))) - 1 / (1 + exp(-0.1e0 - sum(m))), 8) as delta_p from rest join sizes using (image_id) join z using (image_id) group by image_id, cluster, n_tiles having n_tiles - any_value(n) >= 0.01 * n_tiles"""
)
def cluster_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each cluster adds to an image's score by a given model."""
    out = pooling.marginals(*_pooled(spark, sf_dir))
    return out.select("image_id", "cluster", "fold", "n_removed", "n_tiles", r("p_full"), r("p_without"), r("delta_p"))


@query()
def external_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic model of one cohort, its strength chosen by folds, judged on itself and on another."""
    rows, labels, _ = _presence_vectors(spark, sf_dir)
    cohort = F.when(F.col("image_id") % 3 < 2, "own").otherwise("external")
    table = storage.staged(rows.join(labels, "image_id").withColumn("cohort", cohort).withColumn("fold", (F.col("image_id") % 2).cast("int")))
    own = table.where("cohort = 'own'")
    out = outcomes.evaluated(own, table.where("cohort = 'external'"), "recurred", "cohort", [0.1, 1.0])
    return out.select("cohort", "n0", "n1", r("auroc", 6))
