"""Exact dedup against a persistent digest index.

The index is a table of (digest, keep_id, keep_chars, batch), bucketed and sorted by digest. A new
batch is first reduced to one row for each digest (partial sums before the shuffle), then a
sort-merge anti-join against the index leaves the digests that are new, and those are appended. The
index side of that join is read in its buckets, without a shuffle.

A batch has a name. A run that failed and is repeated under the same name finds what it had already
appended, treats it as new as it was, and appends only the rest, so that its result is the same. The
index keeps its number of buckets and its id type in a small table beside it; opening it with
others is an error.

Texts are equal when they are identical after deleting ASCII white space; null counts as empty, and
empty texts equal each other. Of equal texts of a batch the row with the most code points stays,
then that with the smallest id (null ids last). Against an index that already has the digest every
row of the batch goes. Repeated rows (same id and text) count one by one in the group, and one of
them stays. Digests are SHA-256. Columns other than id and text are ignored by ``digests``; an empty batch appends
nothing.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.work import SPACE, exists, new_folder, rows_that_stay, staged, superseded

#: A digest with more rows than one in so many is hot. At most as many digests can be hot, which
#: bounds the broadcast of their rows at any size of the corpus.
HOT_SHARE = 1_024
#: Code points from which a text belongs to the first and to the second of three batches.
LENGTHS = (4_096, 512)


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, chars, digest) for the rows of ``docs``."""
    return docs.select(
        docs[id_col].alias("id"),
        F.length(F.coalesce(docs[text_col], F.lit(""))).cast("long").alias("chars"),
        F.unhex(F.sha2(normalised(docs[text_col]), 256)).alias("digest"),
    )


def groups(rows: DataFrame) -> DataFrame:
    """One row for each digest: the row that stays and the size of the group."""
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "row"))
    return (
        rows.groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("best.id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"), F.col("best.row").alias("keep_row"), "group_size")
    )


class DigestIndex:
    """A bucketed and sorted table of the digests seen so far, at ``path`` in the shared folder.

    The table is registered from its path, so that a later session can go on with it. Buckets and
    id type need only be given for a new index.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str | None = None):
        self.spark, self.path = spark, path
        about = f"{path}-about"
        if exists(spark, f"{about}/_SUCCESS"):
            self.buckets, held_type = spark.read.parquet(about).select("buckets", "id_type").first()
            if buckets not in (None, self.buckets) or id_type not in (None, held_type):
                raise ValueError(f"the index at {path} has {self.buckets} buckets and ids of type {held_type}")
        else:
            self.buckets, held_type = buckets or 256, id_type or "bigint"
            spark.range(1).select(F.lit(self.buckets).alias("buckets"), F.lit(held_type).alias("id_type")).write.mode("overwrite").parquet(about)
        self.table = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {held_type}, keep_chars BIGINT, batch STRING) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows whose digest the index lacks."""
        return rows.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, fresh: DataFrame, batch: str) -> None:
        """Add digests. Dealt by digest into as many parts as buckets, each task writes one file."""
        fresh.select("digest", "keep_id", "keep_chars", F.lit(batch).alias("batch")).repartition(self.buckets, "digest").write.insertInto(self.table)


def resolve(rows: DataFrame, best: DataFrame, total: int) -> DataFrame:
    """Give each row the fields of its digest in ``best``.

    Digests that hold more than one row in ``HOT_SHARE`` are broadcast (there can't be more than
    that many); the others meet in a sort-merge join whose groups that share bounds.
    """
    hot = best.where(F.col("group_size") * HOT_SHARE > total)
    cold = best.where(F.col("group_size") * HOT_SHARE <= total)
    tagged = rows.join(F.broadcast(hot.withColumn("is_hot", F.lit(True))), "digest", "left")
    near = tagged.where("is_hot").drop("is_hot")
    far = tagged.where("is_hot IS NULL").select(*rows.columns).join(cold.hint("merge"), "digest")
    return near.unionByName(far)


def index_buckets(total: int) -> int:
    """About a million digests (some 60 MB) to a bucket."""
    return max(8, 1 << (total // 1_000_000).bit_length())


def _judged(docs: DataFrame, index: DigestIndex | None, id_col: str, text_col: str, batch: str | None) -> tuple[DataFrame, list[DataFrame]]:
    """Rows (id, keep_id, group_size, kept, chars, digest), and the staged tables they are read from."""
    spark = docs.sparkSession
    rows = staged(digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "digests")
    total = rows.count()
    if index is None:
        index = DigestIndex(spark, new_folder(spark, "digest-index"), index_buckets(total), docs.schema[id_col].dataType.simpleString())
    batch = batch or uuid.uuid4().hex
    found = staged(groups(rows), "groups")
    index.append(index.unseen(found), batch)
    held = index.read().select("digest", F.col("keep_id").alias("held_id"), (F.col("batch") == batch).alias("fresh"))
    best = found.join(held.hint("merge"), "digest").select("digest", F.col("held_id").alias("keep_id"), F.when(F.col("fresh"), F.col("keep_row")).alias("keep_row"), "group_size")
    kept = F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept")
    return resolve(rows, best, total).select("id", "keep_id", "group_size", kept, "chars", "digest"), [rows, found]


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, chars, digest.

    Without an index a new one is made for this batch. ``keep_id`` is the id in the index, of an
    earlier batch where that had the digest; ``group_size`` counts the rows of this batch. ``batch``
    names it, so that it can be run again after a failure; unnamed batches are never the same.
    """
    found, _ = _judged(docs, index, id_col, text_col, batch)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "chars", F.lower(F.hex("digest")).alias("digest"))


def exact_dedup_in_batches(docs: DataFrame, bounds: Sequence[int] = LENGTHS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``exact_dedup`` gives for all rows at once, by batches against one index: texts of ``bounds[0]``
    code points and more first, then those of ``bounds[1]`` and more, at last the rest.

    Of equal texts the longest stay, and those come first, so what the index has already is what stays.
    """
    chars = F.length(F.coalesce(docs[text_col], F.lit("")))
    edges = [None, *sorted(bounds, reverse=True), 0]
    index, parts, staging = None, [], []
    for high, low in zip(edges, edges[1:], strict=False):
        batch = docs.where(chars >= low if high is None else (chars >= low) & (chars < high))
        if index is None:
            index = DigestIndex(docs.sparkSession, new_folder(docs.sparkSession, "digest-index"), index_buckets(docs.count()), docs.schema[id_col].dataType.simpleString())
        rows, tables = _judged(batch, index, id_col, text_col, f"from-{low}")
        parts.append(rows.drop("group_size"))
        staging.append(tables)
    sizes = functools.reduce(DataFrame.unionByName, [found.select("digest", "group_size") for _, found in staging]).groupBy("digest").agg(F.sum("group_size").alias("group_size"))
    every = functools.reduce(DataFrame.unionByName, parts)
    found = resolve(every, staged(sizes, "sizes"), sum(rows.count() for rows, _ in staging))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "chars", F.lower(F.hex("digest")).alias("digest"))


def keep_first(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found, parts = _judged(docs, index, id_col, text_col, batch)
    stay = staged(found.select("id", F.col("digest").alias("mark"), F.col("kept").alias("stays")), "stay")
    superseded(*parts)
    return rows_that_stay(docs, stay, id_col, F.unhex(F.sha2(normalised(docs[text_col]), 256)))
