"""Joins, unions and checks between result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_distinct(*parts: DataFrame) -> DataFrame:
    return union_all(*parts).distinct()


def tagged(df: DataFrame, **columns: object) -> DataFrame:
    """Constant columns in front of the others, which they replace if named alike."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*[F.lit(v).alias(k) for k, v in columns.items()], *rest)


def repeated(keys: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Keys that stand in more than one row of all parts."""
    rows = union_all(*[p.select(*keys) for p in parts])
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing(wanted: DataFrame, there: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.select(*keys).distinct().join(there.select(*keys).distinct(), list(keys), "left_anti")


def select_ids(df: DataFrame, ids: DataFrame, key: str = "image_id") -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def fuse(scores: Mapping[str, DataFrame], key: str = "image_id", value: str = "risk_score") -> DataFrame:
    """Sub-scores side by side, one column for each kind; an image needs only one of them.

    The tables are stacked and summed up by key, which costs one shuffle instead of one for each.
    """
    rows = union_all(*[df.select(key, F.lit(kind).alias("_kind"), F.col(value).alias("_v")) for kind, df in scores.items()])
    return rows.groupBy(key).agg(*[F.max(F.when(F.col("_kind") == kind, F.col("_v"))).alias(f"{kind}_{value}") for kind in scores])


def overridden(predictions: DataFrame, overrides: DataFrame, key: str = "image_id") -> DataFrame:
    """Non-null overrides in place of predictions, for the columns that both have."""
    shared = [c for c in overrides.columns if c in predictions.columns and c != key]
    other = overrides.select(key, *[F.col(c).alias(f"_o_{c}") for c in shared])
    return predictions.join(other, key, "left").select(*[F.coalesce(f"_o_{c}", c).alias(c) if c in shared else F.col(c) for c in predictions.columns])


def first_match(labels: DataFrame, scores: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Each label row with the first of its key's scores."""
    first = scores.groupBy(key).agg(F.min_by(value, order).alias(value))
    return labels.join(first, key, "left")


def cohort_summary(images: DataFrame, tables: Mapping[str, DataFrame], key: str = "image_id") -> DataFrame:
    """One row for each image with the columns of all tables, named ``<table>_<column>``."""
    out = images
    for name, df in tables.items():
        out = out.join(df.select(key, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c != key]), key, "left")
    return out


def case_reports(tables: Mapping[str, DataFrame], key: str = "image_id") -> DataFrame:
    """A JSON report for each image with its rows of each table, in the order of the rows' text."""
    rows = union_all(*[df.select(key, F.lit(name).alias("table"), F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("row")) for name, df in tables.items()])
    per = rows.groupBy(key, "table").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    text = F.concat(F.lit('"'), F.col("table"), F.lit('":['), F.array_join("rows", ","), F.lit("]"))
    return per.select(key, text.alias("text")).groupBy(key).agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list("text")), ","), F.lit("}")).alias("report"))


def owners(augmentations: DataFrame, datasets: DataFrame) -> DataFrame:
    """Augmentations with the number of datasets whose id they name, and whether that is one."""
    ids = datasets.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n_owners"))
    rows = augmentations.join(ids, F.col("source_dataset_id") == F.col("dataset_id"), "left").drop("dataset_id")
    return rows.withColumn("n_owners", F.coalesce("n_owners", F.lit(0))).withColumn("ok", F.col("n_owners") == 1)


def label_violations(rows: DataFrame, label: str) -> DataFrame:
    """Values of a label other than 0 and 1, and their number; null is unlabelled, not wrong."""
    return rows.where(F.col(label).isNotNull() & ~F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def labelled(rows: DataFrame, label: str) -> DataFrame:
    return rows.where(F.col(label).isNotNull())


def without_provenance(rows: DataFrame) -> DataFrame:
    return rows.drop("dataset")


def first_and_count(tiles: DataFrame, by: str, order: str, columns: Sequence[str]) -> DataFrame:
    """For each image the first value of each column, in the order of ``order``, and its tiles."""
    return tiles.groupBy(by).agg(*[F.min_by(c, order).alias(c) for c in columns], F.count(F.lit(1)).alias("n_tiles"))
