"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: each source has a weight and asks for its share of 150 % of all words; none gets more than
twice its size, and what is over goes to the others by weight until none is above.

Schedule: slot t has the golden-ratio point frac(t * phi), which falls into one interval of the
sources' cumulative shares and so names a source; the slots of a source are ranked in order. Each
source's documents stand in a shuffled line that is cut into blocks of equally many words, and the
slot of rank r takes block r, beginning again at the end of the line, twice at most. Neighbouring
points are far apart, so any stretch of the schedule is mixed as the whole is.

Every prefix sum is taken in two steps, over ranges of the line or of the slots and then within a
range, so that a source with a third of all rows is never in one task.

Sources are ordered by code point, null last (a null source is a source), and weighted 5, 2, 1 in
turn. Null or empty text has size 0 and takes nothing. Rows of equal hash order are ordered by id;
repeated rows stand in the line one after another. With no words at all every target is 0. The order is that of a
hash, so reruns agree. Columns other than id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.work import WORD, bounded, staged, unused

WEIGHTS = (5, 2, 1)
TOTAL_SHARE, MOST_PASSES = 1.5, 2
#: Words in a block: at most, and as a share of all words or of the source's.
BLOCK_WORDS, LEAST_BLOCKS, LEAST_OF_SOURCE = 1_024, 1 << 17, 256
#: Rows of a source's line, and slots, that one range of a prefix sum holds.
RANGE_ROWS = 1 << 12
CELLS = 4_096
PHI = 0.6180339887498949


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Rows (source, source_size, weight, target) from rows (source, size).

    The table has a row for each source. Sources are filled in the order of cap over weight, in
    which the water level at any point follows from two running sums.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (turn + 1).cast("int"))
    caps = by.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(MOST_PASSES))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) * TOTAL_SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # the level for all sources from here on; the first that is not full fixes it for the rest
    place = F.row_number().over(Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()))
    rows = caps.withColumn("level", level).withColumn("place", place).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    final = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(every)
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.coalesce(F.least(F.col("cap"), final["level"] * F.col("weight")), F.col("cap")))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def in_order(rows: DataFrame, order: list[Column], amount: Column, range_id: Column) -> DataFrame:
    """Add ``offset``, the sum of ``amount`` over the rows of the source before this one.

    ``range_id`` cuts the order into ranges of bounded size.
    """
    cut = rows.withColumn("_range", range_id).withColumn("_amount", amount)
    sums = cut.groupBy("source", "_range").agg(F.sum("_amount").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("source").alias("_source"), F.col("_range").alias("_at"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("source", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_within", F.coalesce(F.sum("_amount").over(within), F.lit(0)))
    both = local.join(base, local["source"].eqNullSafe(base["_source"]) & (local["_range"] == base["_at"]))
    return both.withColumn("offset", F.col("_base") + F.col("_within")).drop("_source", "_at", "_base", "_within", "_range", "_amount")


def schedule(shares: DataFrame, n_slots: int) -> DataFrame:
    """Rows (source, rank) for the slots; shares: rows (source, low, high) that fill 0 to 1.

    Points meet intervals by the cells of the unit interval that they share.
    """
    spark = shares.sparkSession
    cell = lambda x: F.least(F.floor(x * CELLS), F.lit(CELLS - 1))
    wide = shares.select("source", "low", "high", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("cell"))
    point = F.col("t") * F.lit(PHI) - F.floor(F.col("t") * F.lit(PHI))
    slots = spark.range(1, n_slots + 1, 1, max(8, n_slots >> 20)).toDF("t").withColumn("point", point).withColumn("cell", cell(F.col("point")))
    named = slots.join(wide, "cell").where((F.col("low") <= F.col("point")) & (F.col("point") < F.col("high"))).select("t", "source")
    return in_order(named, [F.col("t")], F.lit(1).cast("long"), F.floor(F.col("t") / RANGE_ROWS)).select("source", F.col("offset").alias("rank"))


def mixing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: id, size, source_size, target, taken, offset."""
    sizes = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), words_in(docs[text_col]).alias("size"))
    sizes = staged(sizes.withColumn("row", F.monotonically_increasing_id()), "sizes")
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    aims = staged(source_targets(sizes), "targets")
    base = max(1, min(BLOCK_WORDS, total // LEAST_BLOCKS))
    block = F.greatest(F.lit(1), F.least(F.lit(base), F.floor(F.col("source_size") / LEAST_OF_SOURCE))).cast("long")
    blocks = F.ceil(F.col("source_size") / F.col("block")).cast("long")
    aims = aims.withColumn("block", block).withColumn("blocks", F.when(F.col("source_size") > 0, blocks).otherwise(0))
    aims = aims.withColumn("slots", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    run = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    aims = staged(aims.withColumn("upto", F.sum("slots").over(run)).withColumn("all", F.sum("slots").over(every)), "shares")
    n_slots = int(round(aims.agg(F.coalesce(F.sum("slots"), F.lit(0.0))).first()[0]))
    shares = aims.where("slots > 0").select("source", ((F.col("upto") - F.col("slots")) / F.col("all")).alias("low"), (F.col("upto") / F.col("all")).alias("high"))
    turns = schedule(shares, n_slots).withColumnRenamed("source", "s")
    laps = turns.join(aims.select("source", "blocks"), turns["s"].eqNullSafe(F.col("source")))
    taken = laps.where(F.col("rank") < MOST_PASSES * F.col("blocks")).groupBy(F.col("s"), (F.col("rank") % F.col("blocks")).alias("b")).agg(F.count(F.lit(1)).alias("times"))

    ranges = max(1, rows // RANGE_ROWS)
    key = F.xxhash64("id", F.lit(7))
    line = in_order(sizes.withColumn("key", key), [F.col("key"), F.col("id"), F.col("row")], F.col("size"), F.floor((F.shiftrightunsigned(F.col("key"), 33) / (1 << 31)) * ranges))
    own = aims.select(F.col("source").alias("own"), "source_size", "target", "block")
    line = line.join(own, F.col("source").eqNullSafe(F.col("own")))
    first, last = F.floor(F.col("offset") / F.col("block")), F.floor((F.col("offset") + F.col("size") - 1) / F.col("block"))
    pieces = line.select("*", F.explode(F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))).alias("b"))
    part = F.least(F.col("offset") + F.col("size"), (F.col("b") + 1) * F.col("block")) - F.greatest(F.col("offset"), F.col("b") * F.col("block"))
    met = pieces.join(taken.withColumnRenamed("b", "tb"), F.col("source").eqNullSafe(F.col("s")) & (F.col("b") == F.col("tb")), "left")
    words = F.sum(F.coalesce(part * F.col("times"), F.lit(0))).cast("long")
    return met.groupBy("row", "id", "source", "size", "source_size", "target", "offset").agg(words.alias("taken")).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken", "offset"
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    Of a document that the end of a source's quota cuts, the share taken is rounded. Rows that
    repeat an id are taken equally often, the mean of what falls to them. Texts move only where the
    plan has too many rows for a broadcast; they are repeated last.
    """
    whose, name, lap = (unused(x, docs.columns) for x in ("taken_id", "times", "lap"))
    plan = mixing(docs, id_col, text_col, source_col).where("size > 0").groupBy(F.col(id_col).alias(whose))
    plan = plan.agg(F.floor(F.sum(F.round(F.col("taken") / F.col("size"))) / F.count(F.lit(1))).cast("int").alias(name))
    plan = staged(plan.where(F.col(name) > 0), "plan")
    both = docs.join(bounded(plan), docs[id_col].eqNullSafe(F.col(whose))).select(*[docs[c] for c in docs.columns], name)
    return both.withColumn(lap, F.explode(F.sequence(F.lit(1), F.col(name)))).drop(lap, name)
