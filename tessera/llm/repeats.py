"""Substring dedup: remove what stands anywhere else, by bounded interval expansion on a BWT.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same
document or another; matches never cross documents, overlaps count, and all is judged on the input.

1. Equal strings of ``length`` bytes have the same smallest hash of a run of ``RUN`` bytes, at the
   same place. Each document is cut into segments, one for each such anchor, which hold all strings
   that the anchor stands for. Only segments whose anchor occurs twice can hold a repeat; their
   bytes are fetched, and equal segments become one, with a count.
2. Segments are dealt by anchor into shards of bounded size. A shard's segments make one text; its
   suffixes are sorted, as far as ``length`` or their border, to build its Burrows-Wheeler
   transform, kept as runs. Backward extension of intervals by one byte after another, breadth
   first, derives the common prefixes of neighbouring suffixes in increasing order and stops at
   ``length``: what has no value by then is a repeated string.
3. An anchor with more distinct segments than a shard may hold is too hot for one task. Its strings
   are counted by their hashes instead, summed before the shuffle; this gives the same answer.

Texts are known by a 64-bit hash in the search; results go to texts of equal SHA-256 only. Copies of a text of at least ``length`` bytes go entirely; one of
them stands for all in the search. Null counts as empty; texts shorter than ``length`` lose nothing;
rows with a null id and repeated rows are texts like any others (repeated rows are copies).
Columns beyond those named are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import hash_runs, mix64, small_batches, staged, superseded

_U = np.uint64
#: Bytes of an anchor.
RUN = 128
#: Bytes of segments in a shard, about, and of one anchor at most.
SHARD, HOT = 1 << 20, 2 << 20
#: Bytes of a document taken at a time; positions in a piece fit in 24 bits.
PIECE = 1 << 22
#: Bytes of documents that are hashed at a time, about.
BLOCK = 1 << 16
#: Bytes of segments in a batch, about.
BATCH = 1 << 22
#: Ids that are broadcast at most; beyond, a sort-merge join takes over.
BROADCAST_IDS = 1_000_000


def segments(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The segments of texts that lie end to end in ``data``, each from one of ``bounds`` to the next.

    For each segment: number of its text, anchor hash, and, counted from the start of that text, the
    anchor's place and the first and last start of the segment's strings.
    """
    found = [(np.empty(0, np.int64), np.empty(0, _U), *np.empty((3, 0), np.int64))]
    for base in range(int(bounds[0]), int(bounds[-1]) - length + 1, PIECE):
        part = data[base : min(base + PIECE + length - 1, int(bounds[-1]))]
        runs = hash_runs(part, RUN)
        low = (runs & ~_U((1 << 24) - 1)) | np.arange(runs.size, dtype=_U)
        width, span = length - RUN + 1, 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if width > span:
            low = np.minimum(low[: low.size - (width - span)], low[width - span :])
        place = low & _U((1 << 24) - 1)
        # of all starts, those whose string ends in the same text
        begin, end = (np.clip(x - base, 0, low.size) for x in (bounds[:-1], bounds[1:] - length + 1))
        first = np.union1d(begin[begin < end], np.flatnonzero(place[1:] != place[:-1]) + 1)
        of = np.searchsorted(bounds, first + base, "right") - 1
        inside = first < end[of]
        first, of = first[inside], of[inside]
        last = np.minimum(np.append(first[1:], low.size)[: first.size], end[of]) - 1
        own = place[first].astype(np.int64)
        found.append((of, runs[own], *(x + base - bounds[of] for x in (own, first, last))))
    of, hashes, *places = (np.concatenate(x) for x in zip(*found, strict=True))
    return of, hashes.view(np.int64), *places


def joined_ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges, as maximal ranges."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.flatnonzero(np.append(True, starts[1:] > stops[:-1]))
    return starts[new], stops[np.append(new[1:], starts.size) - 1]


def _ahead(values: np.ndarray, by: int) -> np.ndarray:
    """Values ``by`` places on; 0 past the end."""
    return np.concatenate((values[by:], np.zeros(min(by, values.size), values.dtype)))


def grouped(major: np.ndarray, minor: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by (major, minor), neither over ``most``, equal ones as they come; and where a new pair begins in it."""
    bits, index = int(most).bit_length(), major.size.bit_length()
    keys = major.astype(np.int64)
    keys <<= bits
    keys |= minor
    if 2 * bits + index <= 63:  # keys that hold their places sort several times faster than places do
        keys <<= index
        keys |= np.arange(keys.size)
        keys.sort()
        order = keys & ((1 << index) - 1)
        keys >>= index
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    new = np.ones(keys.size, bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return order, new


def suffix_order(text: np.ndarray, length: int) -> np.ndarray:
    """Places of all suffixes in the order of their first ``length`` symbols, equal ones in any.

    A suffix ends at its first border (0), and the text ends with one. As many symbols as fit make
    the first key; each sort doubles the depth, over those suffixes alone that still equal another
    and have not ended.
    """
    n = text.size
    borders = np.flatnonzero(text == 0)
    left = np.repeat(borders.astype(np.int32), np.diff(borders, prepend=-1))
    left -= np.arange(n, dtype=np.int32)  # symbols before the border
    present = np.bincount(text) > 0
    code = (np.cumsum(present) - 1).astype(np.int16)[text]
    bits = max(1, int(present.sum() - 1).bit_length())
    size = max(2, (63 - n.bit_length()) // bits // 2 * 2)
    keys = np.zeros(n, np.int64)
    for i in range(size // 2):
        keys <<= bits
        keys |= _ahead(code, i)
    some, fresh = grouped(keys, _ahead(keys, size // 2), (1 << (bits * (size // 2))) - 1)
    del keys, code
    order, rows, rank = some.astype(np.int32), np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
    while size < length:
        begin = np.flatnonzero(fresh)
        sizes = np.diff(np.append(begin, rows.size))
        group = np.repeat(rows[begin], sizes)
        rank[some] = group  # the first row of a suffix's group
        tied = np.flatnonzero(np.repeat((sizes > 1) & (left[some[begin]] >= size), sizes))
        if not tied.size:
            break
        rows, some = rows[tied], some[tied]
        more = min(size, length - size)
        by, fresh = grouped(group[tied], rank[some + more], n)
        some = some[by]
        order[rows] = some
        size += more
    return order


def short_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Of the longest common prefix of each two neighbouring suffixes (row and the one before): the
    values under ``length``, from the Burrows-Wheeler transform alone; -1 where it is ``length`` or more.

    Breadth first, strings of 1, 2, 3, ... symbols: the interval of a string is extended by every
    symbol that stands before its suffixes. Where the new interval ends, a prefix of just the old
    string's length ends too, unless a shorter one did, in which case nothing new can follow and the
    interval is dropped. So each value is found once, in increasing order, and the intervals that are
    looked at are no more than the suffixes. The transform is kept as runs of equal symbols, each of
    which moves as one: an interval costs as many steps as it meets runs, however wide it is. Borders
    (0) end strings and are not extended over, so values between two suffixes that share a border stay -1.
    """
    n = order.size
    before = np.where(order > 0, text[order - 1], 0).astype(np.int16)  # nothing stands before the first
    change = np.diff(before, prepend=-1) != 0
    start = np.flatnonzero(change)
    stop = np.append(start[1:], n)
    run = np.cumsum(change, dtype=np.int32) - 1
    symbol = before[start].astype(np.int64)
    by = np.argsort(before[start], kind="stable")
    goes = np.empty(start.size, np.int64)  # from a row of the run to the row of the suffix that is one symbol longer
    goes[by] = np.cumsum((stop - start)[by]) - stop[by]
    prefix = np.full(n + 1, -1, np.int32)
    prefix[0] = 0
    low = np.flatnonzero(np.diff(text[order], prepend=-1))
    high = np.append(low[1:], n)
    prefix[high] = 0
    for size in range(1, length):
        if not low.size:
            break
        a, z = run[low], run[high - 1]
        more = np.flatnonzero(a != z)
        one = np.flatnonzero((a == z) & (symbol[a] > 0))
        by = goes[a[one]]
        pairs = [(low[one] + by, high[one] + by)]
        if more.size:
            low, high, a, count = low[more], high[more], a[more], z[more] - a[more] + 1
            of = np.repeat(np.arange(more.size), count)
            piece = np.arange(of.size) + (a - (np.cumsum(count) - count))[of]
            real = np.flatnonzero(symbol[piece])
            of, piece = of[real], piece[real]
            by, new = grouped(of, symbol[piece], max(more.size, 512))
            new = np.flatnonzero(new)
            # pieces of one interval and symbol are neighbours once moved
            head, tail = by[new], by[np.append(new[1:], by.size)[: new.size] - 1]
            pairs.append((np.maximum(start[piece[head]], low[of[head]]) + goes[piece[head]], np.minimum(stop[piece[tail]], high[of[tail]]) + goes[piece[tail]]))
        low, high = (np.concatenate(x) for x in zip(*pairs, strict=True))
        fresh = np.flatnonzero(prefix[high] < 0)
        low, high = low[fresh], high[fresh]
        prefix[high] = size
    return prefix


def repeated_starts(parts: list[np.ndarray], length: int) -> np.ndarray:
    """Places in the parts laid end to end, each followed by a border, where a string of ``length``
    bytes starts that starts at another place too."""
    sizes = np.array([x.size + 1 for x in parts])
    text = np.zeros(int(sizes.sum()), np.int16)
    for x, at in zip(parts, np.cumsum(sizes) - sizes, strict=True):
        text[at : at + x.size] = x.astype(np.int16) + 1
    order = suffix_order(text, length)
    long = short_prefixes(text, order, length) < 0
    hit = order[long[:-1] | long[1:]]
    borders = np.cumsum(sizes) - 1
    return hit[hit + length <= borders[np.searchsorted(borders, hit)]]


def _fetch(texts: DataFrame, reps: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows (key, text), one for each of ``keys``: the text of the row that stands for the key."""
    wanted = staged(reps.join(keys, "key", "left_semi").select("key", "rep"), "wanted")
    match = F.col("id").eqNullSafe(F.col("rep")) & (F.col("own") == F.col("key"))
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted.hint("merge")
    return texts.withColumn("own", F.xxhash64("text")).join(side, match).select("key", "text")


def _blocks(part: pa.RecordBatch, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
    """Of the texts of a batch, some at a time: number of the first, all bytes of the batch, where these texts begin and end, and their segments."""
    texts = part.column("text").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    edges = np.flatnonzero(np.diff(bounds[:-1] // BLOCK, prepend=-1))
    for a, b in zip(edges.tolist(), np.append(edges[1:], len(texts)).tolist(), strict=True):
        yield a, data, bounds[a : b + 1], segments(data, bounds[a : b + 1], length)


def _anchors(parts: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of each text, with the first and last place of each."""
    for part in parts:
        found = [(of + at, hashes, places) for at, _, _, (of, hashes, places, _, _) in _blocks(part, length)]
        if found:
            of, hashes, places = (np.concatenate(x) for x in zip(*found, strict=True))
            by = np.lexsort((hashes, of))
            of, hashes, places = of[by], hashes[by], places[by]
            new = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(hashes, prepend=0) != 0))
            last = np.append(new[1:], of.size)[: new.size] - 1
            yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(of[new])), *map(pa.array, (hashes[new], places[new], places[last]))], names=["key", "anchor", "low", "high"])


def _cut(parts: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The segments of each text whose anchor is listed; equal ones of a text become one row."""
    names = ["key", "anchor", "lead", "content", "starts", "bytes"]
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for part in parts:
        keys, rows, held = part.column("key").to_pylist(), [], 0
        wanted = np.unique(part.column("anchors").flatten().to_numpy(zero_copy_only=False))
        for at, data, bounds, (of, hashes, places, first, last) in _blocks(part, length):
            hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, hashes), wanted.size - 1)] == hashes)
            begin = bounds[of[hit]] - bounds[0]
            raw, out = data[bounds[0] : bounds[-1]].tobytes(), {}
            for k, h, lead, a, i, j in zip(of[hit].tolist(), hashes[hit].tolist(), (places - first)[hit].tolist(), first[hit].tolist(), (begin + first[hit]).tolist(), (begin + last[hit] + length).tolist(), strict=True):
                out.setdefault((k, h, lead, raw[i:j]), []).append(a)
            for (k, h, lead, seg), starts in out.items():
                rows.append((keys[at + k], h, lead, int.from_bytes(hashlib.blake2b(seg, digest_size=8).digest(), "big", signed=True), starts, seg))
                held += len(seg)
                if held >= BATCH:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)


def _expand(part: pd.DataFrame, length: int) -> pd.DataFrame:
    """For each segment of a shard, the ranges of starts whose strings repeat in the shard."""
    parts = [np.frombuffer(x, np.uint8) for x in part["bytes"]]
    found = np.sort(repeated_starts(parts, length))
    sizes = np.array([x.size + 1 for x in parts])
    begin = np.cumsum(sizes) - sizes
    of = np.searchsorted(begin, found, "right") - 1
    ranges: list[list[int]] = [[] for _ in parts]
    new = np.flatnonzero(np.append(True, (np.diff(found) > 1) | (np.diff(of) > 0))) if found.size else found
    for a, b in zip(new.tolist(), np.append(new[1:], found.size).tolist(), strict=True):
        k = int(of[a])
        ranges[k] += [int(found[a] - begin[k]), int(found[b - 1] - begin[k]) + 1]
    return part[["anchor", "lead", "content"]].assign(ranges=ranges)


def _strings(parts: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """The strings of hot segments, as hashes with their places."""
    for part in parts:
        for anchor, lead, content, seg in zip(part["anchor"], part["lead"], part["content"], part["bytes"], strict=True):
            hashes = hash_runs(np.frombuffer(seg, np.uint8), length)
            at = np.arange(hashes.size)
            yield pd.DataFrame({"anchor": anchor, "lead": lead, "content": content, "at": at, "string": mix64(hashes ^ (lead - at + 1).astype(_U)).view(np.int64)})


def _erase(parts: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    for part in parts:
        out = []
        for key, text, flat in zip(part["key"], part["text"], part["ranges"], strict=True):
            raw = text.encode()
            pairs = np.concatenate(list(flat)).reshape(-1, 2)
            starts, stops = joined_ranges(pairs[:, 0], pairs[:, 1] - 1 + length)
            ends = np.append(starts, len(raw))
            kept = b"".join(raw[a:b] for a, b in zip([0, *stops.tolist()], ends.tolist(), strict=True))
            out.append((key, hashlib.sha256(raw).hexdigest(), len(raw) - len(kept), starts.size, hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(out, columns=["key", "sha", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_removed, n_spans, kept_sha256) for the rows of ``docs``.

    ``length`` is greater than ``RUN``.
    """
    if length <= RUN:
        raise ValueError(f"length must be over {RUN}")
    texts = small_batches(docs).select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = staged(texts.select("id", F.xxhash64("text").alias("key"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    long_rows = rows.where(F.col("n_bytes") >= length)
    reps = staged(long_rows.groupBy("key", "sha").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "reps")

    long_texts = texts.where(F.octet_length("text") >= length)
    keyed = long_texts.select(F.xxhash64("text").alias("key"), "text")
    anchors = staged(keyed.mapInArrow(lambda parts: _anchors(parts, length), "key long, anchor long, low long, high long"), "anchors")
    ends = anchors.groupBy("anchor").agg(F.min(F.struct("key", "low")).alias("a"), F.max(F.struct("key", F.col("high").alias("low"))).alias("z"))
    twice = staged(ends.where("a <> z").select("anchor"), "twice")
    lists = staged(anchors.select("key", "anchor").join(twice, "anchor").distinct().groupBy("key").agg(F.collect_list("anchor").alias("anchors")), "lists")
    superseded(anchors, twice)

    source = _fetch(long_texts, reps, lists.select("key")).join(lists, "key").dropDuplicates(["key"])
    cut = staged(source.mapInArrow(lambda parts: _cut(parts, length), "key long, anchor long, lead long, content long, starts array<long>, bytes binary"), "segments")
    superseded(lists)
    uniq = staged(cut.groupBy("anchor", "lead", "content").agg(F.sum(F.size("starts")).alias("n"), F.first("bytes").alias("bytes")), "distinct")
    loads = uniq.groupBy("anchor").agg(F.sum(F.length("bytes")).alias("load"), F.count(F.lit(1)).alias("kinds"))
    loads = staged(loads.where("kinds > 1"), "loads")
    total = loads.where(F.col("load") <= HOT).agg(F.coalesce(F.sum("load"), F.lit(0))).first()[0]
    shards = int(total) // SHARD + 1
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int")
    dealt = uniq.join(loads.select("anchor", "load"), "anchor")
    cold = dealt.where(F.col("load") <= HOT).select("anchor", "lead", "content", "bytes", shard.alias("shard"))
    found = cold.repartition(shards, "shard").groupBy("shard").applyInPandas(lambda part: _expand(part, length), "anchor long, lead long, content long, ranges array<int>")
    strings = dealt.where(F.col("load") > HOT).select("anchor", "lead", "content", "bytes").mapInPandas(lambda parts: _strings(parts, length), "anchor long, lead long, content long, at int, string long")
    strings = staged(strings, "strings")
    again = strings.groupBy("anchor", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", "string")
    hot = strings.join(again, ["anchor", "string"]).groupBy("anchor", "lead", "content").agg(F.flatten(F.collect_list(F.array(F.col("at"), F.col("at") + 1))).alias("ranges"))
    partly = staged(found.unionByName(hot).where(F.size("ranges") > 0), "found")
    marks = uniq.select("anchor", "lead", "content", "n", (F.length("bytes") - length + 1).alias("strings")).join(partly, ["anchor", "lead", "content"], "left")
    marks = marks.select("anchor", "lead", "content", F.when(F.col("n") > 1, F.array(F.lit(0), F.col("strings"))).otherwise(F.col("ranges")).alias("ranges")).where("ranges IS NOT NULL")
    marks = staged(marks, "marks")
    superseded(uniq, loads, strings, partly)
    placed = cut.select("key", "anchor", "lead", "content", F.explode("starts").alias("start")).join(marks, ["anchor", "lead", "content"])
    by = placed.select("key", F.transform("ranges", lambda x: x + F.col("start")).alias("ranges")).groupBy("key").agg(F.collect_list("ranges").alias("ranges"))
    ranges = staged(by.join(reps.where("copies = 1").select("key"), "key", "left_semi"), "ranges")
    superseded(cut, marks)

    text = _fetch(long_texts, reps, ranges.select("key")).join(ranges, "key")
    erased = text.mapInPandas(lambda parts: _erase(parts, length), "key long, sha string, n_removed long, n_spans long, kept_sha256 string, kept binary").drop("kept")
    whole = reps.where("copies > 1").select("key", "sha", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(""), 256).alias("kept_sha256"))
    results = staged(erased.unionByName(whole), "results")
    out = rows.join(results, ["key", "sha"], "left")
    removed = F.when(F.col("n_spans").isNull(), F.lit(0)).otherwise(F.coalesce("n_removed", "n_bytes")).cast("long")
    return out.select(F.col("id").alias(id_col), "n_bytes", removed.alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
