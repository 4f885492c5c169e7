"""Queries over embeddings, scores and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalar
from tessera.operators import filters, folds, stats, tables, vectors
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


UNPACKED = (
    with_views("tile_embeddings")
    + """, parts as (select image_id, tile_id, cluster, unnest(range(1, len(features) + 1)) as k, cast(unnest(features) as double) as x from tile_embeddings),
 means as (select cluster, k, avg(x) as m from parts group by cluster, k),
 sizes as (select cluster, sqrt(sum(m * m)) as s from means group by cluster),
 centres as (select cluster, k, m / s as c from means join sizes using (cluster) where s > 1e-12)
"""
)


@query(UNPACKED + "select image_id, tile_id, round(sqrt(sum(x * x)), 8) as norm from parts group by image_id, tile_id")
def l2_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.tile_embeddings(spark, sf_dir).select("image_id", "tile_id", F.round(vectors.norm("features"), 8).alias("norm"))


@query(UNPACKED + "select cluster, cast(k - 1 as int) as dim, round(m, 10) as mean from means")
def centroid_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.centroid_parts(A.tile_embeddings(spark, sf_dir)).select("cluster", "dim", r("mean"))


COSINES = UNPACKED + ", own as (select p.image_id, p.tile_id, p.cluster, sum(p.x * c.c) / greatest(sqrt(sum(p.x * p.x)), 1e-12) as cos from parts p join centres c using (cluster, k) group by all)\n"


def _weighted(spark: SparkSession, sf_dir: str, clipped: bool = False) -> DataFrame:
    rows = A.tile_embeddings(spark, sf_dir)
    return vectors.cosine_weights(rows, vectors.centroids(rows), clipped=clipped)


@query(COSINES + "select image_id, tile_id, cluster, round((cos + 1) / 2, 8) as cos_weight from own")
def cosine_to_own_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted(spark, sf_dir).select("image_id", "tile_id", "cluster", r("cos_weight", 8))


@query(COSINES + "select image_id, tile_id, cluster, round(greatest(cos, 0), 8) as cos_weight from own")
def cosine_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted(spark, sf_dir, True).select("image_id", "tile_id", "cluster", r("cos_weight", 8))


@query(
    UNPACKED
    + """, sims as (select p.image_id, p.tile_id, c.cluster, sum(p.x * c.c) as sim from parts p join centres c using (k) group by all)
 select image_id, tile_id, cluster, round(sim, 8) as similarity from sims qualify row_number() over (partition by image_id, tile_id order by sim desc, cluster) = 1"""
)
def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tile_embeddings(spark, sf_dir)
    return vectors.nearest_centroid(rows, vectors.centroids(rows)).select("image_id", "tile_id", "cluster", r("similarity", 8))


@query(
    UNPACKED
    + """, sims as (select a.cluster as a, b.cluster as b, sum(a.c * b.c) as sim from centres a join centres b on a.k = b.k and a.cluster <> b.cluster group by all),
 near as (select * from sims qualify row_number() over (partition by a order by sim desc, b) <= 3)
 select least(a, b) as src, greatest(a, b) as dst, round(max(greatest(sim, 1e-6)), 8) as weight from near group by 1, 2"""
)
def centroid_knn_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.knn_edges(vectors.centroids(A.tile_embeddings(spark, sf_dir)), 3).select("src", "dst", r("weight", 8))


@query(COSINES + "select cluster, image_id, tile_id, row_number() over (partition by cluster order by (cos + 1) / 2 desc, image_id, tile_id) as rank from own qualify rank <= 5")
def representative_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.representatives(_weighted(spark, sf_dir), 5).select("cluster", "image_id", "tile_id", "rank")


SCORED = (
    with_views("fold_scores", "image_metadata")
    + """, scored as (select s.fold, round(s.risk_score, 2) as score, m.recurred from fold_scores s join image_metadata m using (image_id)),
 steps as (select fold, score, count(*) filter (where recurred = 1) as pos, count(*) filter (where recurred = 0) as neg from scored group by fold, score),
 points as (select *, cast(sum(pos) over w as bigint) as tp, cast(sum(neg) over w as bigint) as fp from steps window w as (partition by fold order by score desc))
"""
)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.fold_scores(spark, sf_dir).join(A.image_metadata(spark, sf_dir).select("image_id", "recurred"), "image_id")
    return rows.select("image_id", "fold", F.round("risk_score", 2).alias("score"), "recurred")


@query(SCORED + "select fold, score as threshold, pos, neg, tp, fp from points")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.roc_points(_scored(spark, sf_dir), "score", "recurred", ["fold"])


@query(SCORED + "select fold, cast(sum(neg) as bigint) as n0, cast(sum(pos) as bigint) as n1, round(sum(neg * (tp - pos) + neg * pos / 2.0e0) / nullif(sum(neg) * sum(pos), 0), 9) as auroc from points group by fold")
def auroc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.auroc(_scored(spark, sf_dir), "score", "recurred", ["fold"]).select("fold", "n0", "n1", r("auroc", 9))


@query(SCORED + "select fold, round(sum(pos * tp / (tp + fp)) / nullif(sum(pos), 0), 9) as average_precision from points group by fold")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.average_precision(_scored(spark, sf_dir), "score", "recurred", ["fold"]).select("fold", r("average_precision", 9))


BOOTSTRAP = ", ".join(f"{e}e0" for e in stats.POISSON)


@query(
    SCORED
    + f""", d as (select s.image_id, s.score, s.recurred, t.k, (cast('0x' || substr(md5(s.image_id || ':' || (t.k // 4) || ':0'), cast(t.k % 4 * 8 + 1 as int), 8) as bigint) / 4294967296.0e0) as u
  from (select f.image_id, round(f.risk_score, 2) as score, m.recurred from fold_scores f join image_metadata m using (image_id)) s cross join (select unnest(range(1000)) as k) t),
 w as (select k, score, recurred, len(list_filter([{BOOTSTRAP}], lambda e: e <= u)) as w from d),
 g as (select k, score, sum(case when recurred = 1 then w else 0 end) as pos, sum(case when recurred = 1 then 0 else w end) as neg from w where w > 0 group by k, score),
 b as (select *, sum(neg) over (partition by k order by score) - neg as below from g),
 a as (select k, sum(pos * (below + neg / 2.0e0)) / nullif(sum(pos) * sum(neg), 0) as auc from b group by k)
 select count(auc) as replicas, round(avg(auc), 6) as mean, round(quantile_cont(auc, 0.025), 6) as low, round(quantile_cont(auc, 0.975), 6) as high from a where auc is not null"""
)
def bootstrap_auroc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and interval of the AUROC over 1,000 resamples."""
    out = stats.bootstrap_auroc(_scored(spark, sf_dir), "score", "recurred", "image_id", 1_000)
    return out.select("replicas", r("mean", 6), r("low", 6), r("high", 6))


@query(
    with_views("fold_scores", "image_metadata").replace("with ", "with recursive ", 1)
    + """, s as (select f.image_id, m.dataset, m.recurred, f.risk_score + f.image_id * 1e-7 as v from (select image_id, avg(risk_score) as risk_score from fold_scores group by image_id) f join image_metadata m using (image_id)),
 rk as (select *, row_number() over (partition by dataset order by v) as rk from s),
 t as (select dataset, count(*) filter (where recurred = 1) as n1, count(*) filter (where recurred = 0) as n0, sum(rk) filter (where recurred = 1) as rs from rk group by dataset),
 u as (select dataset, n1, n0, rs - n1 * (n1 + 1) // 2 as u1 from t where least(n1, n0) between 1 and 8),
 deal as (select cast(0 as bigint) as i, cast(0 as bigint) as j, cast(0 as bigint) as total, 1.0e0 as ways
   union all
   select i, j, total, sum(ways) from (
     select i + 1 as i, j + t.take as j, total + t.take * (i + 1) as total, ways from deal cross join (values (cast(0 as bigint)), (cast(1 as bigint))) t(take)
     where i < (select max(n0 + n1) from u) and j + t.take <= 8) group by i, j, total),
 few as (select *, least(n1, n0) as k, case when n1 <= n0 then least(u1, n0 * n1 - u1) else least(u1, n0 * n1 - u1) end as low from u)
 select f.dataset, f.n1, f.n0, cast(any_value(f.u1) as double) as u1, round(least(1, 2 * sum(d.ways) filter (where d.total - f.k * (f.k + 1) // 2 <= f.low) / sum(d.ways)), 9) as p_value
 from few f join deal d on d.i = f.n0 + f.n1 and d.j = f.k group by f.dataset, f.n1, f.n0"""
)
def exact_rank_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank tests of risk scores between outcomes in each data set of few cases, with exact p."""
    scores = A.fold_scores(spark, sf_dir).groupBy("image_id").agg(F.avg("risk_score").alias("risk_score"))
    rows = scores.join(A.image_metadata(spark, sf_dir).select("image_id", "dataset", "recurred"), "image_id").withColumn("v", F.col("risk_score") + F.col("image_id") * 1e-7)
    tests = stats.with_p_values(stats.mann_whitney(rows, "v", "recurred", ["dataset"]))
    return tests.where(F.least("n0", "n1").between(1, stats.EXACT)).select("dataset", "n1", "n0", "u1", r("p_value", 9))


RUNS = (
    with_views("tile_embeddings")
    + """, runs as (select image_id * 100000 + tile_id as tile_id, unnest([0, 1, 2]) as run, unnest([cluster, cluster // 2, (cluster + image_id) % 7]) as cluster from tile_embeddings),
 cells as (select x.run as run_a, y.run as run_b, x.cluster as a, y.cluster as b, count(*) as n from runs x join runs y on x.tile_id = y.tile_id and x.run < y.run group by all),
 sa as (select run_a, run_b, a, sum(n) as ra from cells group by all), sb as (select run_a, run_b, b, sum(n) as rb from cells group by all),
 w as (select run_a, run_b, sum(n) as n, sum(n * (n - 1) / 2) as same from cells group by all),
 ha as (select run_a, run_b, -sum(ra / n * ln(ra / n)) as h, sum(ra * (ra - 1) / 2) as s from sa join w using (run_a, run_b) group by all),
 hb as (select run_a, run_b, -sum(rb / n * ln(rb / n)) as h, sum(rb * (rb - 1) / 2) as s from sb join w using (run_a, run_b) group by all),
 mi as (select c.run_a, c.run_b, sum(c.n / w.n * ln(1.0e0 * c.n * w.n / (ra * rb))) as mi from cells c join sa using (run_a, run_b, a) join sb using (run_a, run_b, b) join w using (run_a, run_b) group by all),
 e as (select run_a, run_b, n, ra, rb, unnest(range(cast(greatest(1, ra + rb - n) as bigint), cast(least(ra, rb) + 1 as bigint))) as k from sa join sb using (run_a, run_b) join w using (run_a, run_b)),
 emi as (select run_a, run_b, sum(k / n * ln(n * k / (1.0e0 * ra * rb)) * exp(lgamma(ra + 1) + lgamma(rb + 1) + lgamma(n - ra + 1) + lgamma(n - rb + 1) - lgamma(n + 1) - lgamma(k + 1) - lgamma(ra - k + 1) - lgamma(rb - k + 1) - lgamma(n - ra - rb + k + 1))) as emi from e group by all)
 select w.run_a, w.run_b, cast(w.n as bigint) as n_rows, round((same - ha.s * hb.s / (w.n * (w.n - 1) / 2)) / ((ha.s + hb.s) / 2 - ha.s * hb.s / (w.n * (w.n - 1) / 2)), 8) as ari, round((mi - emi) / ((ha.h + hb.h) / 2 - emi), 8) as ami
 from w join ha using (run_a, run_b) join hb using (run_a, run_b) join mi using (run_a, run_b) join emi using (run_a, run_b)"""
)


@query(RUNS)
def labeling_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjusted Rand index and adjusted mutual information of each two of three labelings of the tiles."""
    rows = A.tile_embeddings(spark, sf_dir)
    labels = F.array("cluster", F.floor(F.col("cluster") / 2.0).cast("int"), ((F.col("cluster") + F.col("image_id")) % 7).cast("int"))
    runs = rows.select((F.col("image_id") * 100000 + F.col("tile_id")).alias("tile_id"), F.posexplode(labels).alias("run", "cluster"))
    return stats.agreement(runs).select("run_a", "run_b", "n_rows", r("ari", 8), r("ami", 8))


@query(
    with_views("tile_attention")
    + """, p as (select cluster, round(avg(attention) / 997.0e0, 8) as p_value from tile_attention group by cluster),
 ranked as (select *, p_value * count(*) over () / rank() over (order by p_value) as v, p_value * count(*) over () / (rank() over (order by p_value) + count(*) over (partition by p_value) - 1) as top from p)
 select cluster, p_value, round(least(1, min(top) over (order by p_value rows between current row and unbounded following)), 8) as p_adjusted from ranked"""
)
def bh_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.tile_attention(spark, sf_dir).groupBy("cluster").agg(F.round(F.avg("attention") / 997.0, 8).alias("p_value"))
    return stats.benjamini_hochberg(p).select("cluster", "p_value", r("p_adjusted", 8))


@query(
    with_views("tile_embeddings")
    + """, cells as (select cluster as a, image_id % 5 as b, count(*) as n from tile_embeddings group by all),
 s as (select sum(n * (n - 1) / 2) as same, sum(n) as n from cells), sa as (select sum(n * (n - 1) / 2) as v from (select sum(n) as n from cells group by a)),
 sb as (select sum(n * (n - 1) / 2) as v from (select sum(n) as n from cells group by b))
 select cast(s.n as bigint) as n_rows, round((same - sa.v * sb.v / (s.n * (s.n - 1) / 2)) / ((sa.v + sb.v) / 2 - sa.v * sb.v / (s.n * (s.n - 1) / 2)), 9) as ari from s, sa, sb"""
)
def contingency_ari(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tile_embeddings(spark, sf_dir).select(F.col("cluster").alias("a"), (F.col("image_id") % 5).alias("b"))
    return stats.rand_index(rows, "a", "b").select("n_rows", r("ari", 9))


@query(
    with_views("fold_scores")
    + """, wide as (select image_id, max(risk_score) filter (where fold = 0) as s0, max(risk_score) filter (where fold = 1) as s1, max(risk_score) filter (where fold = 2) as s2 from fold_scores group by image_id),
 e as (select image_id, exp((s0 - greatest(s0, s1, s2)) / 0.1e0) as e0, exp((s1 - greatest(s0, s1, s2)) / 0.1e0) as e1, exp((s2 - greatest(s0, s1, s2)) / 0.1e0) as e2 from wide where s0 is not null and s1 is not null and s2 is not null)
 select image_id, round(e0 / (e0 + e1 + e2), 9) as p0, round(e1 / (e0 + e1 + e2), 9) as p1, round(e2 / (e0 + e1 + e2), 9) as p2 from e"""
)
def ovr_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = A.fold_scores(spark, sf_dir).groupBy("image_id").pivot("fold", [0, 1, 2]).agg(F.max("risk_score")).dropna()
    p = scalar.softmax([F.col("0"), F.col("1"), F.col("2")], 0.1)
    return wide.select("image_id", *[F.round(x, 9).alias(f"p{i}") for i, x in enumerate(p)])


@query(with_views("fold_scores") + "select image_id, round(avg(risk_score), 12) as mean, round(stddev_pop(risk_score), 9) as std, count(*) as n from fold_scores group by image_id")
def bootstrap_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.mean_and_spread(A.fold_scores(spark, sf_dir), ["image_id"], "risk_score").select("image_id", r("mean", 12), r("std", 9), "n")


@query(
    with_views("fold_scores")
    + """, p as (select image_id, round(avg(risk_score), 12) as risk_score from fold_scores group by image_id), o as (select doc_id as image_id, cast(quality as double) as risk_score from labels where quality = 1)
 select p.image_id, coalesce(o.risk_score, p.risk_score) as risk_score from p left join o using (image_id)"""
)
def override_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = folds.ensemble(A.fold_scores(spark, sf_dir)).select("image_id", r("risk_score", 12))
    labels = A.read(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("image_id"), F.col("quality").cast("double").alias("risk_score"))
    return tables.overridden(means, labels)


@query(with_views("image_metadata") + "select * from image_metadata where stage in ('BUILDING', 'MACHINERY') and image_mpp > 0.3 and not recurred = 1 and (dataset + 1) % 3 = 0")
def filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = filters.combine("stage in ['BUILDING', 'MACHINERY'] and image_mpp > 0.3", "not (recurred == 1) and (dataset + 1) % 3 == 0")
    return filters.where(A.image_metadata(spark, sf_dir), text)


@query(
    with_views("image_metadata")
    + """, nulled as (select image_id, case when image_id % 3 = 0 then null else stage end as stage, case when image_id % 4 = 0 then null else recurred end as recurred from image_metadata)
 select * from nulled where (stage is null or stage <> 'BUILDING') and (stage is null or stage not in ('MACHINERY')) and not coalesce(recurred = 1, false)"""
)
def filter_null_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = A.image_metadata(spark, sf_dir)
    rows = m.select("image_id", F.when(F.col("image_id") % 3 != 0, F.col("stage")).alias("stage"), F.when(F.col("image_id") % 4 != 0, F.col("recurred")).alias("recurred"))
    return filters.where(rows, "stage != 'BUILDING' and stage not in ['MACHINERY'] and not (recurred == 1)")


def _cohorts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = A.image_metadata(spark, sf_dir)
    return m.where("dataset < 12").select("image_id", "stage"), m.where("dataset >= 10").select("image_id", "recurred")


@query(
    with_views("image_metadata")
    + "select 'a' as cohort, image_id, stage, cast(null as int) as recurred from image_metadata where dataset < 12 union all select 'b', image_id, null, recurred from image_metadata where dataset >= 10"
)
def union_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _cohorts(spark, sf_dir)
    return tables.union_all(tables.tagged(a, cohort="a"), tables.tagged(b, cohort="b"))


@query(with_views("image_metadata") + "select image_id from image_metadata where dataset < 12 union select image_id from image_metadata where dataset >= 10")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _cohorts(spark, sf_dir)
    return tables.union_distinct(a.select("image_id"), b.select("image_id"))


@query(with_views("image_metadata") + "select image_id, cast(2 as bigint) as n from image_metadata where dataset between 10 and 11")
def dup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.repeated(["image_id"], *_cohorts(spark, sf_dir))


@query(with_views("image_metadata") + "select distinct image_id from image_metadata where image_id not in (select user_id from events)")
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = A.read(spark, sf_dir, "events").select(F.col("user_id").cast("long").alias("image_id"))
    return tables.missing(A.image_metadata(spark, sf_dir), there, ["image_id"])


FUSED = (
    with_views("fold_scores", "image_metadata", "cells")
    + """, mil as (select image_id, round(avg(risk_score), 12) as s from fold_scores group by image_id),
 cellular as (select image_id, round(count(*) filter (where is_mitotic) / count(*), 9) as s from cells group by image_id),
 staging as (select image_id, case stage when 'BUILDING' then 0.1e0 when 'MACHINERY' then 0.9e0 else 0.5e0 end as s from image_metadata where dataset < 12),
 fused as (select image_id, mil.s as mil_risk_score, cellular.s as cellular_risk_score, staging.s as staging_risk_score from mil full join cellular using (image_id) full join staging using (image_id))
"""
)


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    mil = folds.ensemble(A.fold_scores(spark, sf_dir)).select("image_id", r("risk_score", 12))
    cells = A.cells(spark, sf_dir).groupBy("image_id").agg(F.round(F.count_if("is_mitotic") / F.count(F.lit(1)), 9).alias("risk_score"))
    level = F.when(F.col("stage") == "BUILDING", 0.1).when(F.col("stage") == "MACHINERY", 0.9).otherwise(0.5)
    staging = A.image_metadata(spark, sf_dir).where("dataset < 12").select("image_id", level.alias("risk_score"))
    return tables.fuse({"mil": mil, "cellular": cells, "staging": staging})


@query(FUSED + "select * from fused")
def fusion_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir)


@query(
    """with gaps as (select c.c_mktsegment as stage, date_diff('day', min(o.o_orderdate), max(o.o_orderdate)) as days, count(*) > 8 as event from orders o join customer c on o.o_custkey = c.c_custkey group by c.c_custkey, c.c_mktsegment),
 ends as (select stage, days, count(*) filter (where event) as events, count(*) as leaving from gaps group by all),
 risk as (select *, sum(leaving) over (partition by stage order by days desc) as at_risk from ends),
 run as (select *, exp(sum(case when events < at_risk then ln(1 - events / at_risk) else 0 end) over (partition by stage order by days)) * (1 - max(cast(events >= at_risk as int)) over (partition by stage order by days)) as p from risk)
 select stage, days as time, cast(at_risk as bigint) as at_risk, events, round(p, 9) as recurrence_free_prob from run where events > 0"""
)
def km_survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = A.read(spark, sf_dir, "orders"), A.read(spark, sf_dir, "customer")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("long").alias("days"), (F.count(F.lit(1)) > 8).alias("event"))
    rows = per.join(c.select("c_custkey", F.col("c_mktsegment").alias("stage")), "c_custkey")
    out = stats.kaplan_meier(rows, "days", "event", ["stage"])
    return out.select("stage", "time", "at_risk", "events", r("recurrence_free_prob", 9))


@query(FUSED + ", m as (select m.*, f.mil_risk_score, f.cellular_risk_score, f.staging_risk_score from image_metadata m left join fused f using (image_id)) select image_id, stage, recurred, mil_risk_score as risk_mil_risk_score, cellular_risk_score as risk_cellular_risk_score, staging_risk_score as risk_staging_risk_score from m")
def cohort_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = A.image_metadata(spark, sf_dir).select("image_id", "stage", "recurred")
    return tables.cohort_summary(images, {"risk": _fused(spark, sf_dir)})


@query(
    with_views("tile_attention", "splits")
    + """, part as (select image_id, 'splits' as t, to_json({'fold': fold, 'split': split}) as row from splits
  union all select image_id, 'tiles', to_json({'tile_id': tile_id, 'cluster': cluster}) from tile_attention),
 per as (select image_id, '"' || t || '":[' || string_agg(cast(row as varchar), ',' order by cast(row as varchar)) || ']' as text from part group by image_id, t)
 select image_id, '{' || string_agg(text, ',' order by text) || '}' as report from per group by image_id"""
)
def case_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"splits": A.splits(spark, sf_dir), "tiles": A.tile_attention(spark, sf_dir).select("image_id", "tile_id", "cluster")}
    return tables.case_reports(parts)


@query(
    with_views("fold_scores", "splits")
    + """, units as (select s.image_id, s.fold, case when f.risk_score is null then 'failed' when f.risk_score > 0.05 then 'done' else 'skipped' end as status from splits s left join fold_scores f using (image_id, fold))
 select fold, status, count(*) as n from units group by all"""
)
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = A.splits(spark, sf_dir).join(A.fold_scores(spark, sf_dir), ["image_id", "fold"], "left")
    status = F.when(F.col("risk_score").isNull(), "failed").when(F.col("risk_score") > 0.05, "done").otherwise("skipped")
    return units.groupBy("fold", status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """select c_custkey as image_id, regexp_replace(lower(c_mktsegment || ' / Run ' || c_custkey), '[^a-z0-9]+', '-', 'g') as tag, 'slide_' || c_custkey as stem,
 printf('%02d:%02d:%02d', c_custkey * 37 // 3600, c_custkey * 37 % 3600 // 60, c_custkey * 37 % 60) as took, sha256(c_mktsegment) as digest from customer"""
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = A.read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    path = F.concat(F.lit("/wsi/slide_"), key.cast("string"), F.when(key % 2 == 0, ".ome.tif").otherwise(".svs"))
    return c.select(
        key.alias("image_id"), scalar.run_tag(F.concat("c_mktsegment", F.lit(" / Run "), key.cast("string"))).alias("tag"),
        scalar.slide_stem(path).alias("stem"), scalar.duration(key * 37).alias("took"), F.sha2("c_mktsegment", 256).alias("digest"),
    )


@query(
    with_views("tile_attention")
    + """select image_id, tile_id, attention, cluster from tile_attention qualify row_number() over (partition by cluster order by attention desc, image_id, tile_id) <= 10"""
)
def top_tiles_by_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tile_attention(spark, sf_dir).withColumn("cos_weight", F.col("attention"))
    return vectors.representatives(rows, 10).select("image_id", "tile_id", "attention", "cluster")
