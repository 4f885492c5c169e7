"""The corpus pipeline: documents through five stages, each written as Parquet before the next.

Every stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of
documents; the last returns a row for each document with its token ids' digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, jaccard_join, mixing, quality_rules
from tessera.llm.work import staged, superseded


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word shingles at a similarity of 0.8 or more one stays."""
    return jaccard_join.keep_one(docs, k=5, num=80, den=100)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of what they decode to."""
    import public_tokenizers

    made = bpe.bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard_join", near_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

#: The near-duplicate groups, the compression ratios and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = staged(stage(spark, docs, sf_dir), name)
        if i:
            superseded(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
