"""Cross-validation folds: making them, reading them, and reducing scores over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import composite_key, draw
from tessera.operators.ordered import running_sums
from tessera.sources.storage import staged


def expand_flat(flat: DataFrame, n_folds: int) -> DataFrame:
    """(image_id, fold) to (image_id, fold, split): an image is test in its fold, else train.

    Rows without a fold are dropped. The folds are few, so each row is exploded, not joined.
    """
    rows = flat.where(F.col("fold").isNotNull()).select("image_id", F.col("fold").alias("_own"), F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("fold"))
    return rows.select("image_id", "fold", F.when(F.col("fold") == F.col("_own"), "test").otherwise("train").alias("split"))


def repeated_ids(flat: DataFrame) -> DataFrame:
    """Ids that stand more than once, which a flat table must not have."""
    return flat.groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _ranked(rows: DataFrame, by: Sequence[str], key: str, first: Sequence[str] = ()) -> DataFrame:
    """Add ``_rank`` (from 1) and ``_all`` (the size) within each group ``by``, in the order of
    ``first`` and then of the hexadecimal digest ``key``.

    A digest's first two digits cut a group into 256 parts of like size. Parts are counted first,
    so that no task orders a whole group.
    """
    cut = rows.withColumn("_part", F.substring(key, 1, 2))
    parts = [*by, *first, "_part"]
    sizes = cut.groupBy(*parts).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*by).orderBy(*first, "_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(*parts, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"), F.sum("_size").over(Window.partitionBy(*by)).alias("_all"))
    own = cut.withColumn("_own", F.row_number().over(Window.partitionBy(*parts).orderBy(key)))
    return own.join(base, parts).withColumn("_rank", F.col("_before") + F.col("_own"))


def stratified_folds(images: DataFrame, n_folds: int, strata: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """A fold for each image: round-robin in the order of draws within each stratum."""
    rows = images.select("image_id", (composite_key(*strata) if strata else F.lit("all")).alias("_stratum"), draw(seed, "image_id").alias("_key"))
    return _ranked(rows, ["_stratum"], "_key").select("image_id", ((F.col("_rank") - 1) % n_folds).cast("int").alias("fold"))


def group_folds(images: DataFrame, n_folds: int, group: str, strata: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """A fold for each image, whole groups together: groups of like make-up are dealt round-robin,
    the largest first. A group's make-up is its most frequent stratum, the first of equals."""
    label = composite_key(*strata) if strata else F.lit("all")
    per = images.groupBy(group).agg((-F.count(F.lit(1))).alias("_less"), F.mode(label, True).alias("_label")).withColumn("_key", draw(seed, group))
    dealt = _ranked(per, ["_label"], "_key", ["_less"]).select(group, ((F.col("_rank") - 1) % n_folds).cast("int").alias("fold"))
    return images.join(dealt, group).select("image_id", "fold")


def modulo_folds(images: DataFrame, n_folds: int) -> DataFrame:
    """Images in the order of their ids, dealt round-robin."""
    ids = staged(images.select("image_id").distinct().withColumn("_one", F.lit(1)))
    return running_sums(ids, "image_id", ["_one"]).select("image_id", ((F.col("cum__one") - 1) % n_folds).cast("int").alias("fold"))


def carve_validation(splits: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Turn a share of each fold's train rows, one at least, into ``val``."""
    if fraction <= 0:
        return splits.select("image_id", "fold", "split")
    rows = splits.select("image_id", "fold", "split", draw(seed, "image_id", "fold").alias("_key"))
    val = (F.col("split") == "train") & (F.col("_rank") <= F.greatest(F.lit(1), F.rint(F.col("_all") * fraction)))
    return _ranked(rows, ["fold", "split"], "_key").select("image_id", "fold", F.when(val, "val").otherwise(F.col("split")).alias("split"))


def inner_split(images: DataFrame, label: str, fraction: float, seed: int = 0) -> DataFrame:
    """(image_id, split): a share of each class held out as ``val``, rounded half to even.

    Fewer than four images, or no share, leave all in ``train``. A class of one image makes the
    draw go over all classes together.
    """
    per = images.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = per.agg(F.sum("n").alias("_total"), ((F.count(F.lit(1)) > 1) & (F.min("n") >= 2)).alias("_by_class"))
    rows = images.select("image_id", F.col(label).cast("string").alias("_y")).join(F.broadcast(whole), how="inner")
    rows = rows.select("image_id", "_total", F.when(F.col("_by_class"), F.coalesce("_y", F.lit("nan"))).otherwise("all").alias("_stratum"), draw(seed, "image_id").alias("_key"))
    val = (F.col("_total") >= 4) & (F.lit(fraction) > 0) & (F.col("_rank") <= F.rint(F.col("_all") * fraction))
    return _ranked(rows, ["_stratum"], "_key").select("image_id", F.when(val, "val").otherwise("train").alias("split"))


def fold_values(n_folds: int | None) -> list[int | None]:
    """The folds of a run: one without a number where there is none to cross."""
    return list(range(n_folds)) if n_folds and n_folds > 1 else [None]


def partition_grid(spark: SparkSession, values: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """All combinations of a few partition values, a column for each."""
    rows = spark.range(1).select()
    for name, options in values.items():
        rows = rows.select("*", F.explode(F.array(*[F.lit(v).cast("string") for v in options])).alias(name))
    return rows


def ids_of(splits: DataFrame, fold: int, split: str) -> DataFrame:
    return splits.where((F.col("fold") == fold) & (F.col("split") == split)).select("image_id").distinct()


def fold_checks(splits: DataFrame, outcomes: DataFrame, label: str) -> DataFrame:
    """For each fold: sizes, images in both train and test, and train images of either class."""
    sides = splits.groupBy("fold", "image_id").agg(F.max((F.col("split") == "train").cast("int")).alias("tr"), F.max((F.col("split") == "test").cast("int")).alias("te"))
    rows = sides.join(outcomes.select("image_id", F.col(label).alias("_y")), "image_id", "left")
    count = lambda c: F.count_if(c)
    train, test = F.col("tr") == 1, F.col("te") == 1
    return rows.groupBy("fold").agg(
        count(train).alias("n_train"), count(test).alias("n_test"), count(train & test).alias("n_overlap"), count(train & (F.col("_y") == 0)).alias("n_negative"), count(train & (F.col("_y") == 1)).alias("n_positive")
    )


def held_out_times(splits: DataFrame) -> DataFrame:
    """How many images are held out how often; all of them should be once."""
    per = splits.groupBy("image_id").agg(F.count_if(F.col("split") == "test").alias("times"))
    return per.groupBy("times").agg(F.count(F.lit(1)).alias("n_images"))


def class_weights(images: DataFrame, label: str) -> DataFrame:
    """n / (2 n_class) for each class."""
    per = images.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = per.agg(F.sum("n").alias("_all"))
    return per.join(F.broadcast(whole), how="inner").select(label, "n", (F.col("_all") / (2.0 * F.col("n"))).alias("weight"))


def out_of_fold(scores: DataFrame, splits: DataFrame, how: str = "left") -> DataFrame:
    """Each image's score by the model that did not see it; ``left`` keeps images without one."""
    test = splits.where("split = 'test'").select("image_id", "fold")
    return test.join(scores, ["image_id", "fold"], how).select("image_id", "risk_score", "fold")


def ensemble(scores: DataFrame, columns: Sequence[str] = ("risk_score",)) -> DataFrame:
    """Mean over folds for each image; the fold is null."""
    return scores.groupBy("image_id").agg(*[F.avg(c).alias(c) for c in columns]).withColumn("fold", F.lit(None).cast("int"))


def canonical_rows(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows of each image's test fold; of the first fold where that has no rows at all."""
    folds = rows.select("fold").distinct()
    first = folds.agg(F.min("fold").alias("_first"))
    test = splits.where("split = 'test'").select("image_id", F.col("fold").alias("_test"))
    known = test.join(folds.select(F.col("fold").alias("_test"), F.lit(True).alias("_known")), "_test", "left")
    wanted = rows.select("image_id").distinct().join(known, "image_id", "left").join(F.broadcast(first), how="inner")
    wanted = wanted.select("image_id", F.when(F.col("_known"), F.col("_test")).otherwise(F.col("_first")).alias("fold"))
    return rows.join(wanted, ["image_id", "fold"])
