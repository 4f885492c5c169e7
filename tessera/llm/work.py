"""What the operators share: working tables in the cluster's shared folder, and word hashes."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, which alone separates words: ``[\x20\x09-\x0D]``.
SPACE = " \t\n\x0b\x0c\r"
#: A word, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"

#: Ids that are broadcast at most (some 32 MB); beyond, a sort-merge join takes over.
BROADCAST_IDS = 1_000_000

#: Rows of a batch that goes to Python, at most: texts are long, and a batch is held several times
#: over, by the JVM, by Arrow and by Python.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_SALT = 0x2545F4914F6CDD1D


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a local master gets a temporary folder (tests); on a cluster that is an
    error, because executors do not see each other's local folders.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: a cut in the lineage that
    outlives executors, with column pruning for each later reader."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, in a session that sends at most ``BATCH_ROWS`` rows at a time to Python."""
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, BATCH_ROWS)
    return docs


def giving_back(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over a task's batches. At its end the worker, which lives on beside the executor for
    other tasks, returns the memory that it holds without using it."""

    def run(parts: Iterator) -> Iterator:
        yield from function(parts)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return run


def _on_store(spark: SparkSession, path: str):
    """A path, and the file system that has it, as Spark sees them."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _on_store(spark, path)
    return store.exists(where)


def superseded(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what followed from them has been written."""
    for table in tables:
        where, store = _on_store(table.sparkSession, table.staged_path)
        store.delete(where, True)


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, lengthened until no column has it, in whatever case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded(rows: DataFrame, most: int | None = None) -> DataFrame:
    """``rows`` for a join: broadcast if they are few (they are counted), else by sort-merge."""
    return F.broadcast(rows) if rows.count() <= (BROADCAST_IDS if most is None else most) else rows.hint("merge")


def rows_that_stay(docs: DataFrame, judged: DataFrame, id_col: str, mark: Column) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    ``judged``, a staged table, has a row (id, mark, stays) for each row of ``docs``; ``mark`` gives
    the same mark to a row of ``docs``, and rows of equal id and mark count as repeated. Texts move
    only where too many ids go for a broadcast. Rows whose id is null or not theirs alone are told
    apart by their marks, and of repeated rows one stays.
    """
    name, other, theirs = (unused(x, docs.columns) for x in ("gone", "mark", "their_mark"))
    by_id = judged.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.every("stays").alias("stays"))
    unclear = F.col("id").isNull() | (F.col("n") > 1)
    gone = staged(by_id.where(unclear | ~F.col("stays")).select(F.col("id").alias(name), unclear.alias("unclear")), "gone")
    clear = docs.join(bounded(gone.select(name)), docs[id_col].eqNullSafe(F.col(name)), "left_anti")
    doubts = gone.where("unclear").select(name)
    if doubts.isEmpty():
        return clear
    marked = docs.join(bounded(doubts), docs[id_col].eqNullSafe(F.col(name)), "left_semi").withColumn(other, mark)
    stays = judged.where("stays").select(F.col("id").alias(name), F.col("mark").alias(theirs)).hint("merge")
    kept = marked.join(stays, marked[id_col].eqNullSafe(F.col(name)) & (marked[other] == F.col(theirs)), "left_semi")
    return clear.unionByName(kept.dropDuplicates([id_col, other]).drop(other))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(maxsize=4)
def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, _MULT, _U)
    down = np.full(n + 1, _U(pow(int(_MULT), -1, 1 << 64)), _U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the odd multiplier and of its inverse, modulo 2**64."""
    kept = 1 << max(16, n.bit_length())
    up, down = _power_table(kept) if kept <= 1 << 20 else _power_table.__wrapped__(n)
    return up[: n + 1], down[: n + 1]


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(_SALT))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE.encode())] = True


def hash_words(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order, without a Python object for each word."""
    raw = np.frombuffer(text, np.uint8)
    if not raw.size:
        return np.empty(0, _U)
    gap = _IS_SPACE[raw]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    if not start.size:
        return np.empty(0, _U)
    up, down = _powers(raw.size)
    sums = np.zeros(raw.size + 1, _U)
    np.cumsum(_BYTE[raw] * up[:-1], out=sums[1:])
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(_U))


def hash_runs(raw: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` bytes."""
    if raw.size < k:
        return np.empty(0, _U)
    up, down = _powers(raw.size)
    sums = np.zeros(raw.size + 1, _U)
    np.cumsum(_BYTE[raw] * up[:-1], out=sums[1:])
    return mix64((sums[k:] - sums[:-k]) * down[: raw.size - k + 1])


def hash_shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words; of the whole sequence where there are fewer."""
    if not words.size:
        return words
    n = min(k, words.size)
    out = np.zeros(words.size - n + 1, _U)
    for i in range(n):
        out = mix64(out * _MULT + words[i : words.size - n + 1 + i] + _U(i + 1))
    return mix64(out + _U(n))
