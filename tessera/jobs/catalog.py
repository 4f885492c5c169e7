"""The registered queries of the library proper, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.jobs import cohort_queries, learned_queries, model_queries, outcome_queries


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort_queries.cellular_features(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return cohort_queries.QUERIES | model_queries.QUERIES | learned_queries.QUERIES | outcome_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return cohort_queries.SQL | model_queries.SQL | learned_queries.SQL | outcome_queries.SQL
