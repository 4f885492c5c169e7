"""Places of pattern matches in text, by DataFrame functions.

Spark returns what a pattern matches but not where. The text between matches is what ``split``
leaves, so the lengths of both, summed up, give the places (code points, end exclusive).

Patterns must take time linear in the text and no stack for each repetition: single-character
classes with possessive quantifiers, and a run entered only at its start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements that one running sum takes at a time, so that long arrays cost no quadratic copying.
BLOCK = 256
#: The last and the first word of the text between two matches; a run is entered only at its start.
LAST_WORD, FIRST_WORD = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+\z", r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"


def running(df: DataFrame, name: str, values: Column, start: int, op: Callable[[Column, Column], Column]) -> DataFrame:
    """Add ``name``: for each element of an array of ints, ``op`` folded over those before it."""
    v, b = f"_{name}v", f"_{name}b"

    def fold(xs: Column, first: Column) -> Column:
        zero = F.struct(first.cast("int").alias("s"), F.array().cast("array<int>").alias("l"))
        return F.aggregate(xs, zero, lambda acc, x: F.struct(op(acc["s"], x).cast("int").alias("s"), F.concat(acc["l"], F.array(acc["s"])).alias("l")), lambda acc: acc["l"])

    df = df.withColumn(v, values)
    last = F.floor((F.size(v) - 1) / BLOCK).cast("int")
    numbers = F.when(F.size(v) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(b, F.zip_with(numbers, F.array_repeat(F.col(v), last + 1), lambda k, xs: F.slice(xs, k * BLOCK + 1, BLOCK)))
    whole = F.transform(b, lambda xs: F.aggregate(xs, F.lit(start), lambda a, x: op(a, x).cast("int")))
    df = df.withColumn(v, fold(whole, F.lit(start)))
    return df.withColumn(name, F.flatten(F.zip_with(b, v, fold))).drop(v, b)


def with_spans(df: DataFrame, name: str, text: Column, pattern: str, when: Column, context: bool = False) -> DataFrame:
    """Add column ``name``: array of (start, stop, value[, before, after]) for all leftmost matches
    that do not overlap. ``when`` is a cheap test without which a text can't match."""
    m, g, p, s = (f"_{name}_{x}" for x in "mgps")
    none = F.array().cast("array<string>")
    df = df.withColumn(m, F.when(when, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(text, pattern, -1)).otherwise(none))
    edges = lambda x: [F.regexp_extract(x, LAST_WORD, 1).alias("before"), F.regexp_extract(x, FIRST_WORD, 1).alias("after")] if context else []
    df = df.withColumn(g, F.transform(g, lambda x: F.struct(F.length(x).alias("g"), *edges(x))))
    n = F.size(m)
    df = df.withColumn(p, F.zip_with(F.slice(g, 1, n), m, lambda x, y: F.struct(x["g"].alias("g"), F.length(y).alias("n"), y.alias("value"), *([x["before"].alias("before")] if context else []))))
    df = running(df, s, F.transform(p, lambda x: x["g"] + x["n"]), 0, lambda a, x: a + x)
    out = F.zip_with(p, s, lambda x, at: F.struct((at + x["g"]).alias("start"), (at + x["g"] + x["n"]).alias("stop"), x["value"].alias("value"), *([x["before"].alias("before")] if context else [])))
    if context:
        after = F.transform(F.slice(g, 2, n), lambda x: x["after"])
        out = F.zip_with(out, after, lambda x, a: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), x["before"].alias("before"), a.alias("after")))
    return df.withColumn(name, out).drop(m, g, p, s)


def without_overlaps(df: DataFrame, name: str, others: str) -> DataFrame:
    """Keep of the spans in ``name`` those that overlap none in ``others``; both sorted by start."""
    at, low, high = f"_{name}_at", f"_{name}_low", f"_{name}_high"
    most = (1 << 31) - 1
    mark = lambda spans, own: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(own).alias("own"), x["stop"].alias("stop")))
    df = df.withColumn(at, F.array_sort(F.concat(mark(others, 0), mark(name, 1))))
    df = running(df, low, F.transform(at, lambda x: F.when(x["own"] == 0, x["stop"]).otherwise(0)), 0, F.greatest)
    df = running(df, high, F.reverse(F.transform(at, lambda x: F.when(x["own"] == 0, x["start"]).otherwise(most))), most, F.least)
    free = F.zip_with(F.zip_with(at, low, lambda x, y: F.struct(x.alias("x"), y.alias("low"))), F.reverse(high), lambda z, h: F.when(z["x"]["own"] == 1, (z["low"] <= z["x"]["start"]) & (h >= z["x"]["stop"])))
    df = df.withColumn(at, F.filter(free, lambda x: x.isNotNull()))
    kept = F.filter(F.zip_with(name, at, lambda t, ok: F.struct(t.alias("t"), ok.alias("ok"))), lambda z: z["ok"])
    return df.withColumn(name, F.transform(kept, lambda z: z["t"])).drop(at, low, high)


def labelled(spans: Column, kind: str, order: int) -> Column:
    """Spans as (start, order, kind, stop): they sort by start, then kind as listed."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), s["stop"].alias("stop")))


def joined(spans: Column) -> Column:
    """``kind:start:stop`` of sorted spans, with commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
