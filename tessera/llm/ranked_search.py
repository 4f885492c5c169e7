"""Ranked lexical search over norm buckets of impact vectors, exact in integers.

A document is a vector with a coordinate for each term of the items, ``sqrt(w) * impact``, an item one
with ``sqrt(w)``: their product is the score. Documents are stored by decreasing length of their
vectors and searched in waves, longest first; every wave raises the score that the next has to reach.
Within a wave a task takes its rows in buckets of similar length:

* the item's length times the bucket's greatest length, by Cauchy and Schwarz, prunes the bucket;
* inside, coordinates are added up from the item's heaviest term on, and a document goes as soon as
  what it has and the product of the remaining lengths fall short;
* survivors are scored again with 64-bit integers, and those decide.

Items are searched in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` terms, so what goes
to executors and to the driver (weights, counts of documents by term, scores to reach) is bounded
whatever the tables hold. Texts are read once for each block.

Null texts and texts without a term are in no result; a null item finds nothing. Rows of equal id are
documents of their own, and so are items of equal id; of equal scores the smaller id goes first, null
before all. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tessera.llm.work import small_batches, staged, superseded

#: Most items and terms of a block. An item with more terms is a block of its own.
BLOCK_ITEMS, BLOCK_TERMS = 4096, 1 << 16
#: Numbers of a bucket's term-by-document table.
CELLS = 1 << 23
#: Most documents of a bucket, those of the first wave, and how many times as many each next wave takes.
BUCKET, FIRST, TIMES = 1024, 1 << 14, 8
#: Terms of an item that are added up before documents are compared with their bounds again.
STEP = 8
#: Room for rounding in bounds, which are floating-point numbers; scores are not.
SLACK = 1 - 1e-9

_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Terms in order: runs of ASCII letters and digits and of whatever is not ASCII; A-Z become small."""
    return text.encode().translate(_BYTES).split()


def _counted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Rows (id, salt, n, term, tf) of documents with any term: those of the vocabulary, with counts.

    ``salt`` numbers a task's rows; it only deals out equal lengths.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, salt = shared.value.get, 0
        for part in parts:
            rows, total, at, tf = [], [], [], []
            for i, text in enumerate(part.column("text")):
                if found := terms(text.as_py() or ""):
                    counts = Counter(map(known, found))
                    counts.pop(None, None)
                    rows.append(i)
                    total.append(len(found))
                    at.append(list(counts))
                    tf.append(list(counts.values()))
            ids = part.column("id").take(pa.array(rows, pa.int32()))
            salts = pa.array(range(salt, salt + len(rows)), pa.int64())
            salt += len(rows)
            yield pa.RecordBatch.from_arrays([ids, salts, pa.array(total, pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))], names=["id", "salt", "n", "term", "tf"])

    rows = small_batches(docs).select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.where("text is not null").mapInArrow(batches, f"id {kind}, salt long, n long, term array<int>, tf array<long>")


def _weighed(counted: DataFrame, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Rows (id, salt, length, term, impact); documents without a weighted term go."""
    kind = counted.schema["id"].dataType.simpleString()
    schema = pa.schema([("length", pa.float64()), ("term", pa.list_(pa.int32())), ("impact", pa.list_(pa.int32()))])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column("term")
            size = np.diff(lists.offsets.to_numpy())
            term, tf = lists.flatten().to_numpy(), part.column("tf").flatten().to_numpy()
            m = 50 + 50 * part.column("n").to_numpy() * n_docs // n_terms
            impact = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, size))
            row = np.repeat(np.arange(size.size), size)
            keep = (impact > 0) & (weight[term] > 0)
            row, term, impact = row[keep], term[keep], impact[keep]
            squares = np.bincount(row, weight[term] * impact.astype(float) ** 2, size.size)
            some = pa.array(np.flatnonzero(squares > 0))
            ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=size.size)))).astype(np.int32))
            columns = [pa.array(np.sqrt(squares)), pa.ListArray.from_arrays(ends, pa.array(term)), pa.ListArray.from_arrays(ends, pa.array(impact.astype(np.int32)))]
            made = pa.RecordBatch.from_arrays([part.column("id"), part.column("salt"), *columns], names=["id", "salt", *schema.names])
            yield made.take(some)

    return counted.select("id", "salt", "n", "term", "tf").mapInArrow(batches, f"id {kind}, salt long, length double, term array<int>, impact array<int>")


class _Items:
    """The items of a block, as tasks search them."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, k: int):
        heaviest = [t[np.lexsort((t, -weight[t]))] for t in items]
        self.items = [t[weight[t] > 0] for t in heaviest]
        self.weight, self.k = weight, k
        self.length = np.array([math.sqrt(weight[t].sum()) for t in self.items])
        #: of each item, the length of what follows each step
        self.rest = [np.sqrt(np.concatenate((weight[t][::-1].cumsum()[::-1], [0]))[STEP::STEP] if t.size > STEP else np.zeros(1)) for t in self.items]

    def hits(self, table: np.ndarray, length: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a bucket whose score for item ``q`` is ``least`` or more (and over 0), and the scores."""
        own, weight = self.items[q], self.weight
        alive = np.flatnonzero(self.length[q] * length >= least * SLACK)
        got, left = np.zeros(alive.size), length[alive] ** 2
        for step, rest in zip(range(0, own.size, STEP), [*self.rest[q], 0.0], strict=False):
            part = own[step : step + STEP]
            values = table[part][:, alive].astype(float)
            w = weight[part].astype(float)
            got += w @ values
            left -= w @ (values * values)
            keep = got + rest * np.sqrt(np.maximum(left, 0)) >= least * SLACK
            alive, got, left = alive[keep], got[keep], left[keep]
            if not alive.size:
                break
        score = weight[own] @ table[own][:, alive].astype(np.int64)
        keep = score >= max(least, 1)
        return alive[keep], score[keep]


def _best(rows: list[tuple], k: int) -> list[tuple]:
    return sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1]))[:k]


def _searched(vectors: DataFrame, items: _Items, reached: np.ndarray) -> DataFrame:
    """Rows (item, id, score): of each task's documents, the ``k`` best for each item that reach its score."""
    kind = vectors.schema["id"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast((items, reached))
    size = max(1, min(BUCKET, CELLS // max(1, items.weight.size)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = shared.value
        least = least.copy()
        best: dict[int, list[tuple]] = {}
        table = np.zeros((own.weight.size, size), np.int32)
        for whole in parts:
            for at in range(0, whole.num_rows, size):
                part = whole.slice(at, size)
                length, lists = part.column("length").to_numpy(), part.column("term")
                term = lists.flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                table[term, row] = part.column("impact").flatten().to_numpy()
                for q in np.flatnonzero((own.length > 0) & (own.length * length.max() >= least * SLACK)):
                    rows, score = own.hits(table, length, q, least[q])
                    if rows.size > own.k:
                        keep = score >= np.partition(score, -own.k)[-own.k]
                        rows, score = rows[keep], score[keep]
                    if rows.size:
                        ids = part.column("id").take(pa.array(rows)).to_pylist()
                        best[q] = _best([*best.get(q, ()), *zip(score.tolist(), ids, strict=True)], own.k)
                        if len(best[q]) == own.k:
                            least[q] = max(least[q], best[q][-1][0])
                table[term, row] = 0
        found = [(q, i, s) for q, rows in best.items() for s, i in rows]
        yield pa.RecordBatch.from_pydict({"item": [r[0] for r in found], "id": [r[1] for r in found], "score": [r[2] for r in found]}, schema=pa.schema([("item", pa.int32()), vector_id, ("score", pa.int64())]))

    vector_id = pa.field("id", to_arrow_type(vectors.schema["id"].dataType))
    return vectors.select("id", "length", "term", "impact").mapInArrow(batches, f"item int, id {kind}, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _waves(vectors: DataFrame) -> list[tuple[float, float]]:
    """(least, greatest) lengths of each wave, longest first: eighths of powers of two, as many
    together as make up the wave. Lengths span a few hundred such eighths at most."""
    by = vectors.groupBy(F.floor(F.log2("length") * 8).alias("band")).agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("low"), F.max("length").alias("high"))
    out, n, most, high = [], 0, FIRST, None
    for r in sorted(by.collect(), key=lambda r: -r["band"]):
        high, n, low = high or r["high"], n + r["n"], r["low"]
        if n >= most:
            out.append((low, high))
            n, most, high = 0, most * TIMES, None
    return out + ([(low, high)] if n else [])


def _block(docs: DataFrame, items: list[list[bytes]], k: int, id_col: str, text_col: str) -> DataFrame | None:
    """Rows (item, id, score, rank) of a block; items are numbered from 0."""
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for own in items for t in own))}
    counted = staged(_counted(docs, vocabulary, id_col, text_col), "counted")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in counted.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():
        df[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    found = None
    if n_docs and vocabulary:
        made = _weighed(counted, weight, n_docs, n_terms)
        vectors = staged(made.repartitionByRange(F.desc("length"), "salt", F.xxhash64("id")).sortWithinPartitions(F.desc("length")), "vectors")
        block = _Items([np.array([vocabulary[t] for t in own], np.int64) for own in items], weight, k)
        reached = np.zeros(len(items), np.int64)
        for low, high in _waves(vectors):
            if found is not None and not (block.length * high >= reached * SLACK).any():
                break
            new = _searched(vectors.where(F.col("length").between(low, high)), block, reached)
            before, found = found, staged(_ranked(new if found is None else found.drop("rank").unionByName(new), k), "found")
            for r in found.where(F.col("rank") == k).select("item", "score").toLocalIterator():
                reached[r["item"]] = r["score"]
            if before is not None:
                superseded(before)
        superseded(vectors)
    superseded(counted)
    return found


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (item, rank, id, score): each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    kinds = StructType([StructField("item", IntegerType()), StructField("own", items.schema[item_col].dataType)])
    named = staged(items.select(items[item_col].alias("own"), items[item_text].alias("text")), "items")
    out = []

    def flush(names: list, block: list[list[bytes]]) -> None:
        found = _block(docs, block, k, id_col, text_col) if block else None
        if found is not None:
            out.append(found.join(F.broadcast(spark.createDataFrame(list(enumerate(names)), kinds)), "item"))

    names, block, seen = [], [], set()
    for r in named.toLocalIterator():
        own = list(dict.fromkeys(terms(r["text"] or "")))
        if block and (len(block) == BLOCK_ITEMS or len(seen.union(own)) > BLOCK_TERMS):
            flush(names, block)
            names, block, seen = [], [], set()
        names.append(r["own"])
        block.append(own)
        seen.update(own)
    flush(names, block)
    superseded(named)
    if not out:
        nothing = StructType([*kinds, StructField("rank", IntegerType()), StructField("id", docs.schema[id_col].dataType), StructField("score", LongType())])
        out = [spark.createDataFrame([], nothing)]
    whole = functools.reduce(DataFrame.unionByName, out)
    return whole.select(F.col("own").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
