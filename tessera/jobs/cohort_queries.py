"""Queries over cells, tiles and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import composite_key
from tessera.operators import attention, cellular, folds, stats, tiles
from tessera.sources import analogues as A
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


def r(name: str, digits: int = 10):
    return F.round(name, digits).alias(name)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = A.cells(spark, sf_dir)
    return cellular.tile_counts(cells, A.lattice(cells.select("image_id").distinct()), A.TILE, A.TILE)


COUNTS_SQL = (
    with_views("cells", "lattice")
    + """, counts as (
 select t.image_id, t.tile_id, t.tile_x, t.tile_y, count(c.cell_id) as n_cells, count(c.cell_id) filter (where c.cell_type = 'Neoplastic') as n_tumor,
  count(c.cell_id) filter (where c.cell_type = 'Inflammatory') as n_lymph, count(c.cell_id) filter (where c.is_mitotic) as n_mitosis
 from lattice t left join cells c on c.image_id = t.image_id and cast(floor(c.x / 100) * 100 as bigint) = t.tile_x and cast(floor(c.y / 100) * 100 as bigint) = t.tile_y
 group by all)
"""
)


@query(COUNTS_SQL + "select * from counts")
def cellular_tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


@query(
    COUNTS_SQL
    + """select image_id, cast(sum(n_tumor) as bigint) as n_tumor, cast(sum(n_lymph) as bigint) as n_lymph, cast(sum(n_mitosis) as bigint) as n_mitosis,
 round(sum(n_lymph) / nullif(sum(n_lymph) + sum(n_tumor), 0), 10) as etil, round(sum(n_mitosis) / nullif(sum(n_tumor), 0), 10) as mitosis_tumor_ratio
 from counts group by image_id"""
)
def cellular_totals_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cellular.totals(_counts(spark, sf_dir)).select("image_id", "n_tumor", "n_lymph", "n_mitosis", r("etil"), r("mitosis_tumor_ratio"))


def _features_sql(tissue: int, percentile: float, lymph: float, mitosis: int) -> str:
    return (
        COUNTS_SQL
        + f""", bars as (select image_id, quantile_cont(n_tumor / n_cells, {percentile}) filter (where n_cells >= {tissue}) as bar from counts group by image_id),
 marked as (select c.*, n_cells >= {tissue} and n_tumor / n_cells >= bar as tumour from counts c join bars using (image_id))
 select image_id, cast(sum(n_tumor) as bigint) as n_tumor, cast(sum(n_lymph) as bigint) as n_lymph, cast(sum(n_mitosis) as bigint) as n_mitosis,
 round(sum(n_lymph) / nullif(sum(n_lymph) + sum(n_tumor), 0), 10) as etil, round(sum(n_mitosis) / nullif(sum(n_tumor), 0), 10) as mitosis_tumor_ratio,
 round(count(*) filter (where tumour and n_lymph / n_cells > {lymph}) / nullif(count(*) filter (where tumour), 0), 10) as til_coverage,
 round(count(*) filter (where tumour and n_mitosis > {mitosis}) / nullif(count(*) filter (where tumour), 0), 10) as mitotic_coverage
 from marked group by image_id"""
    )


def _features(spark: SparkSession, sf_dir: str, *args) -> DataFrame:
    out = cellular.cellular_features(_counts(spark, sf_dir), *args)
    return out.select("image_id", "n_tumor", "n_lymph", "n_mitosis", r("etil"), r("mitosis_tumor_ratio"), r("til_coverage"), r("mitotic_coverage"))


@query(_features_sql(4, 0.75, 0.05, 1))
def cellular_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, 4)


@query(_features_sql(64, 0.6, 0.3, 0))
def cellular_thresholds_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, 64, 60.0, 0.3, 0)


@query(
    with_views("cells")
    + """, tiles as (select i.image_id, cast(x.k * 50 as bigint) as tile_x, cast(y.k * 50 as bigint) as tile_y
  from (select distinct image_id from cells) i cross join (select unnest(range(7)) as k) x cross join (select unnest(range(7)) as k) y)
 select t.image_id, t.tile_x, t.tile_y, count(c.cell_id) as n_cells, count(c.cell_id) filter (where c.cell_type = 'Neoplastic') as n_tumor,
  count(c.cell_id) filter (where c.cell_type = 'Inflammatory') as n_lymph, count(c.cell_id) filter (where c.is_mitotic) as n_mitosis
 from tiles t left join cells c on c.image_id = t.image_id and c.x >= t.tile_x and c.x < t.tile_x + 100 and c.y >= t.tile_y and c.y < t.tile_y + 100 group by all"""
)
def cellular_containment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = A.cells(spark, sf_dir)
    k = F.explode(F.sequence(F.lit(0), F.lit(6)))
    grid = cells.select("image_id").distinct().select("image_id", k.alias("i")).select("image_id", "i", k.alias("j"))
    grid = grid.select("image_id", (F.col("i") * 50).cast("long").alias("tile_x"), (F.col("j") * 50).cast("long").alias("tile_y"))
    return cellular.tile_counts_overlapping(cells, grid, 100, 100, 50)


@query(
    with_views("tile_attention")
    + """, sizes as (select image_id, cluster, count(*) as n from tile_attention group by image_id, cluster)
 select image_id, cluster, n from sizes qualify n >= 0.5 * max(n) over (partition by image_id)"""
)
def cluster_size_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cellular.large_clusters(A.tile_attention(spark, sf_dir), ["image_id"], "cluster", 0.5)


GRID_SQL = """, sized as (select image_id, image_width, image_height, greatest(1, cast(round_even({mm} * 1000 / image_mpp, 0) as bigint)) as w from image_metadata),
 stepped as (select *, greatest(1, cast(round_even(w * 0.5, 0) as bigint)) as step from sized)
"""


@query(
    with_views("image_metadata")
    + GRID_SQL.format(mm=0.128)
    + """select image_id, row_number() over (partition by image_id order by r.y, c.x) - 1 as tile_id, r.y // step as tile_row, c.x // step as tile_col, c.x as tile_x, r.y as tile_y,
 w as tile_width, w as tile_height, 0.128e0 as size_mm
 from stepped, lateral (select unnest(generate_series(0, image_height - w, step)) as y) r, lateral (select unnest(generate_series(0, image_width - w, step)) as x) c"""
)
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.tile_grid(A.image_metadata(spark, sf_dir), 0.128, 0.5)


@query(
    with_views("image_metadata")
    + """, params as (select unnest([0.064e0, 0.128e0, 0.256e0]) as mm),
 sized as (select image_id, mm, image_width, image_height, greatest(1, cast(round_even(mm * 1000 / image_mpp, 0) as bigint)) as w from image_metadata cross join params)
 select image_id, mm as size_mm, cast(case when image_width >= w then (image_width - w) // w + 1 else 0 end * case when image_height >= w then (image_height - w) // w + 1 else 0 end as bigint) as n_tiles from sized"""
)
def tile_grid_counts_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = A.image_metadata(spark, sf_dir)
    parts = [tiles.tile_totals(images, mm) for mm in (0.064, 0.128, 0.256)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(with_views("tile_embeddings") + "select image_id, tile_id, cluster from tile_embeddings where not coalesce(tile_background, false)")
def tile_foreground(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.foreground(A.tile_embeddings(spark, sf_dir)).select("image_id", "tile_id", "cluster")


@query(
    with_views("tile_embeddings")
    + "select image_id, count(*) as n_tiles, min(tile_id) = 0 and max(tile_id) = count(*) - 1 and count(distinct tile_id) = count(*) as ok from tile_embeddings group by image_id"
)
def tile_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.contiguous(A.tile_embeddings(spark, sf_dir))


@query(
    with_views("image_metadata")
    + "select image_id, cast(k as int) as fold, case when patient_id % 5 = k then 'test' else 'train' end as split from image_metadata cross join (select unnest(range(5)) as k)"
)
def splits_expand_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = A.image_metadata(spark, sf_dir).select("image_id", (F.col("patient_id") % 5).cast("int").alias("fold"))
    return folds.expand_flat(flat, 5)


@query(
    with_views("image_metadata")
    + """, counts as (select patient_id, recurred, count(*) as k from image_metadata group by all),
 per as (select patient_id, min_by(recurred, (-k, recurred)) as label, sum(k) as n from counts group by patient_id),
 dealt as (select patient_id, (row_number() over (partition by label order by n desc, md5(patient_id || ':0')) - 1) % 5 as own from per),
 flat as (select m.image_id, d.own from image_metadata m join dealt d using (patient_id)),
 wide as (select image_id, cast(f as int) as fold, case when f = own then 'test' else 'train' end as split from flat cross join (select unnest(range(5)) as f) x)
 select image_id, fold, case when split = 'train' and row_number() over (partition by fold, split order by md5(image_id || ':' || fold || ':0')) <= greatest(1, round_even(count(*) over (partition by fold, split) * 0.1e0, 0)) then 'val' else split end as split from wide"""
)
def splits_group_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leakage-free folds by patient, stratified by outcome, with a validation share."""
    flat = folds.group_folds(A.image_metadata(spark, sf_dir), 5, "patient_id", ["recurred"])
    return folds.carve_validation(folds.expand_flat(flat, 5), 0.1)


@query(with_views("image_metadata") + "select image_id, cast((row_number() over (partition by recurred, stage order by md5(image_id || ':0')) - 1) % 5 as int) as fold from image_metadata")
def splits_stratified_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.stratified_folds(A.image_metadata(spark, sf_dir), 5, ["recurred", "stage"])


@query(with_views("splits") + "select distinct image_id from splits where fold = 1 and split = 'train'")
def splits_train_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.ids_of(A.splits(spark, sf_dir), 1, "train")


@query(with_views("splits") + "select distinct image_id from splits where fold = 1 and split = 'test'")
def splits_heldout_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.ids_of(A.splits(spark, sf_dir), 1, "test")


@query(
    with_views("splits", "image_metadata")
    + """, sides as (select fold, image_id, max(cast(split = 'train' as int)) as tr, max(cast(split = 'test' as int)) as te from splits group by fold, image_id)
 select fold, count(*) filter (where tr = 1) as n_train, count(*) filter (where te = 1) as n_test, count(*) filter (where tr = 1 and te = 1) as n_overlap,
 count(*) filter (where tr = 1 and recurred = 0) as n_negative, count(*) filter (where tr = 1 and recurred = 1) as n_positive
 from sides left join image_metadata using (image_id) group by fold"""
)
def splits_check_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.fold_checks(A.splits(spark, sf_dir), A.image_metadata(spark, sf_dir), "recurred")


@query(with_views("splits") + "select times, count(*) as n_images from (select image_id, count(*) filter (where split = 'test') as times from splits group by image_id) group by times")
def splits_held_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.held_out_times(A.splits(spark, sf_dir))


@query(with_views("image_metadata") + "select concat_ws('_', recurred, stage, dataset) as stratum, count(*) as n from image_metadata group by all")
def composite_strata_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.image_metadata(spark, sf_dir).groupBy(composite_key("recurred", "stage", "dataset").alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


@query(with_views("image_metadata") + "select recurred, count(*) as n, round(sum(count(*)) over () / (2.0e0 * count(*)), 10) as weight from image_metadata group by recurred")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.class_weights(A.image_metadata(spark, sf_dir), "recurred").select("recurred", "n", r("weight"))


@query(with_views("fold_scores", "splits") + "select s.image_id, f.risk_score, s.fold from splits s left join fold_scores f using (image_id, fold) where s.split = 'test'")
def oof_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.out_of_fold(A.fold_scores(spark, sf_dir), A.splits(spark, sf_dir))


@query(with_views("fold_scores", "splits") + "select s.image_id, f.risk_score, s.fold from splits s join fold_scores f using (image_id, fold) where s.split = 'test'")
def oof_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.out_of_fold(A.fold_scores(spark, sf_dir), A.splits(spark, sf_dir), "inner")


@query(with_views("fold_scores") + "select image_id, round(avg(risk_score), 12) as risk_score, cast(null as int) as fold from fold_scores group by image_id")
def ensemble_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.ensemble(A.fold_scores(spark, sf_dir)).select("image_id", r("risk_score", 12), "fold")


@query(
    with_views("fold_scores", "splits")
    + """, wanted as (select distinct f.image_id, coalesce(case when s.fold in (select fold from fold_scores) then s.fold end, (select min(fold) from fold_scores)) as fold
  from fold_scores f left join splits s on s.image_id = f.image_id and s.split = 'test')
 select f.image_id, f.fold, f.risk_score from fold_scores f join wanted using (image_id, fold)"""
)
def canonical_fold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.canonical_rows(A.fold_scores(spark, sf_dir), A.splits(spark, sf_dir)).select("image_id", "fold", "risk_score")


@query(
    with_views("tile_attention")
    + """select image_id, tile_id, attention, cluster from tile_attention
 qualify coalesce(sum(attention) over (partition by image_id order by attention desc, tile_id desc rows between unbounded preceding and 1 preceding), 0) / sum(attention) over (partition by image_id) < 0.8"""
)
def attention_mass_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.mass_filter(A.tile_attention(spark, sf_dir), 0.8, massless=False)


@query(with_views("tile_attention") + "select *, row_number() over (partition by image_id order by attention desc, tile_id desc) as rank from tile_attention qualify rank <= 3")
def attention_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.top_tiles(A.tile_attention(spark, sf_dir), 3)


@query(
    with_views("tile_attention")
    + """, w as (select image_id, cluster, sum(attention) as w, count(*) as n from tile_attention group by image_id, cluster)
 select image_id, cluster, round(w, 6) as weighted_count, round(w / sum(w) over (partition by image_id), 10) as weighted_presence, n as hard_count, round(n / sum(n) over (partition by image_id), 10) as hard_frac from w"""
)
def presence_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = attention.presence(A.tile_attention(spark, sf_dir), "attention")
    return out.select("image_id", "cluster", r("weighted_count", 6), r("weighted_presence"), "hard_count", r("hard_frac"))


@query(
    with_views("tile_attention")
    + """, w as (select image_id, cluster, sum(attention) as w, count(*) as n from tile_attention group by image_id, cluster)
 select image_id, cluster, round(w / sum(w) over (partition by image_id), 10) as presence, round(w / sum(n) over (partition by image_id), 8) as presence_abs, n as hard_count, round(n / sum(n) over (partition by image_id), 10) as hard_frac from w"""
)
def presence_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = attention.presence_of_foreground(A.tile_attention(spark, sf_dir), "attention")
    return out.select("image_id", "cluster", r("presence"), r("presence_abs", 8), "hard_count", r("hard_frac"))




@query(
    with_views("tile_attention")
    + "select image_id, "
    + ", ".join(f"round(coalesce(sum(attention) filter (where cluster = '{c}'), 0) / sum(attention), 6) as cluster_{c}_presence" for c in ("click", "error", "purchase", "signup", "view"))
    + " from tile_attention group by image_id"
)
def presence_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presence with a column for each cluster that occurs (a model's clusters, so few)."""
    rows = A.tile_attention(spark, sf_dir)
    clusters = sorted(x["cluster"] for x in rows.select("cluster").distinct().collect())
    wide = attention.presence_wide(rows, "attention", clusters)
    return wide.select("image_id", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])


RANKED = (
    with_views("tile_attention", "image_metadata")
    + """, p as (select image_id, cluster, round(sum(attention) / sum(sum(attention)) over (partition by image_id), 10) as v from tile_attention group by image_id, cluster),
 x as (select p.*, m.recurred, rank() over (partition by cluster order by v) + (count(*) over (partition by cluster, v) - 1) / 2.0e0 as rk, count(*) over (partition by cluster, v) as same from p join image_metadata m using (image_id))
"""
)


@query(
    RANKED
    + """select cluster, count(*) filter (where recurred = 1) as n1, count(*) filter (where recurred = 0) as n0,
 round(sum(case when recurred = 1 then rk else 0 end) - count(*) filter (where recurred = 1) * (count(*) filter (where recurred = 1) + 1) / 2.0e0, 6) as u1,
 round(2 * (sum(case when recurred = 1 then rk else 0 end) - count(*) filter (where recurred = 1) * (count(*) filter (where recurred = 1) + 1) / 2.0e0)
  / nullif(count(*) filter (where recurred = 1) * count(*) filter (where recurred = 0), 0) - 1, 8) as effect_r from x group by cluster"""
)
def mann_whitney_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cluster_tests(spark, sf_dir).select("cluster", "n1", "n0", r("u1", 6), r("effect_r", 8))


def _cluster_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = attention.presence(A.tile_attention(spark, sf_dir), "attention").select("image_id", "cluster", r("weighted_presence"))
    rows = shares.join(A.image_metadata(spark, sf_dir).select("image_id", "recurred"), "image_id")
    return stats.mann_whitney(rows, "weighted_presence", "recurred", ["cluster"])


@query(
    RANKED.replace("with ", "with recursive ", 1)
    + """, s as (select cluster, count(*) filter (where recurred = 1) as n1, count(*) filter (where recurred = 0) as n0, sum(case when recurred = 1 then rk else 0 end) as rs, sum(1.0e0 * same * same - 1) as ties, count(*) as n from x group by cluster),
 u as (select *, rs - n1 * (n1 + 1) / 2.0e0 as u1, n0 * n1 / 12.0e0 * ((n + 1) - ties / (n * (n - 1.0e0))) as var from s),
 z as (select *, greatest(abs(u1 - n0 * n1 / 2.0e0) - 0.5e0, 0) / sqrt(var) / sqrt(2.0e0) as z from u),
 t as (select *, 1 / (1 + 0.3275911e0 * z) as t from z),
 deal as (select cast(0 as bigint) as i, cast(0 as bigint) as j, cast(0 as bigint) as total, 1.0e0 as ways
   union all
   select i, j, total, sum(ways) from (
     select i + 1 as i, j + d.take as j, total + d.take * (i + 1) as total, ways from deal cross join (values (cast(0 as bigint)), (cast(1 as bigint))) d(take)
     where i < (select max(n) from s where least(n1, n0) <= 8 and ties = 0) and j + d.take <= 8) group by i, j, total),
 few as (select u.cluster, least(1, 2 * sum(ways) filter (where total - least(n1, n0) * (least(n1, n0) + 1) / 2 <= least(u1, n0 * n1 - u1)) / sum(ways)) as exact
   from u join deal d on d.i = u.n and d.j = least(n1, n0) where least(n1, n0) <= 8 and ties = 0 group by u.cluster, n1, n0, u1),
 q as (select t.* , coalesce(exact, p_normal) as p_value from (select *, least(1, ((((1.061405429e0 * t - 1.453152027e0) * t + 1.421413741e0) * t - 0.284496736e0) * t + 0.254829592e0) * t * exp(-z * z)) as p_normal from t) t left join few using (cluster)),
 b as (select *, p_value * count(*) over () / (rank() over (order by p_value) + count(*) over (partition by p_value) - 1) as v from q)
 select cluster, n1, n0, round(u1, 6) as u1, round(2 * u1 / (n0 * n1) - 1, 8) as effect_r, round(p_value, 6) as p_value,
 round(least(1, min(v) over (order by p_value rows between current row and unbounded following)), 6) as p_adjusted from b"""
)
def significant_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = stats.benjamini_hochberg(stats.with_p_values(_cluster_tests(spark, sf_dir)))
    return tests.select("cluster", "n1", "n0", r("u1", 6), r("effect_r", 8), r("p_value", 6), r("p_adjusted", 6))
