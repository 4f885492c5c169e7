"""Quality rules: base counts, and limits for zstandard compression ratios.

A document compresses within limits that depend on its length: text that repeats itself compresses
far better than prose of its length, and noise hardly at all. The whole text is held against the
limits for its length, and so are its chunks of two sizes, which find a random or repetitive passage
that the rest dilutes: 1 KB ones short passages, 4 KB ones repeats of a longer period. The last chunk
ends with the text. A text goes if more than a small share of the chunks of either size are odd, or
odd ones follow each other for 3 KB.

The limits of whole texts are fixed ones, narrowed by what the corpus shows: for each class of
lengths, four to an octave, the quartiles of the ratio over all documents tell how far from the
median ordinary texts of that length lie, and ``SPREADS`` such spreads are the limit. Quartiles do
not move with a few per cent of junk. Texts of equal length and ratio count once there, so that a
group of copies has no say by its size. A class of few texts leans on the fixed limits (``LEAN``).

What ratios can't tell stays: noise over few characters (hexadecimal digits, letters of one case)
compresses as dense prose does, and texts under 200 bytes have no stable ratio.

Null or empty text: no words, all counts 0, rejected by the base rule. Rows are judged one by
one, so repeated rows and ties give repeated results, a null id is kept, and columns beyond the
two that are named are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import SPACE, giving_back, hash_shingles, hash_words, small_batches

#: (bytes, least ratio, greatest ratio); in between by the logarithm of the bytes. Random base64 words
#: reach 1.07, 1.13, 1.21, 1.29 and 1.36 at 200, 300, 500, 1,000 and 64,000 bytes; real prose, lists and
#: code start at 1.12, 1.18, 1.37, 1.55 and 2.0 and, but for tables and rulers of up to 700 bytes, end at
#: 3.1 at 1,000 bytes and 3.8 at 8,000.
LIMITS = (
    (200, 1.09, 2.4), (250, 1.15, 2.5), (300, 1.16, 2.6), (400, 1.22, 2.7), (500, 1.28, 2.8), (700, 1.34, 3.0), (1_000, 1.40, 3.3),
    (2_000, 1.45, 3.6), (4_096, 1.50, 3.9), (8_000, 1.55, 4.2), (16_000, 1.55, 4.4), (64_000, 1.55, 4.8),
)
#: Bytes of a chunk, the share of odd ones that a text may have, and the odd bytes in a row that reject it.
CHUNKS, CHUNK_SHARE, RUN = (1_024, 4_096), 0.1, 3_072
LEVEL = 3
#: Length classes to an octave, and steps of the ratio to 1 in which it is counted, up to so many.
CLASSES, STEPS, MOST_STEPS = 4, 200, 4_000
#: Spreads from the median to a limit, the least spread as a share of the median, and the number of
#: texts that the fixed limits count as.
SPREADS, LEAST_SPREAD, LEAN = 5.0, 0.015, 8.0
#: A standard deviation of a normal distribution, in quartile distances.
QUARTILE = 0.6745

COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "kept": "boolean", "ratio": "double", "n_chunks": "long", "n_odd_chunks": "long",
}
_SYMBOLS = "#*$%&|<>"
_NO_SPACE = str.maketrans("", "", SPACE)


def repeat_words(words: np.ndarray, window: int = 5) -> int:
    """Words inside windows that the text has twice or more, the first included."""
    if words.size < window:
        return 0
    _, place, count = np.unique(hash_shingles(words, window), return_inverse=True, return_counts=True)
    hit = np.flatnonzero(count[place] > 1)
    cover = np.zeros(words.size + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def limits(n: int) -> tuple[float, float]:
    """Least and greatest ratio of a text of ``n`` bytes."""
    at, low, high = zip(*LIMITS, strict=True)
    return float(np.interp(np.log(n), np.log(at), low)), float(np.interp(np.log(n), np.log(at), high))


def length_class(n: int) -> int:
    return int(np.floor(np.log2(n) * CLASSES))


def learned_limits(counts: dict[int, dict[int, int]]) -> dict[int, tuple[float, float]]:
    """Least and greatest ratio by length class, from the counts of texts by class and ratio step."""
    out = {}
    for of, by_step in counts.items():
        steps = np.array(sorted(by_step))
        n = np.array([by_step[x] for x in steps], float)
        upto = np.cumsum(n)
        low, mid, high = ((steps[i] + (share * upto[-1] - (upto[i] - n[i])) / n[i]) / STEPS for share in (0.25, 0.5, 0.75) for i in [np.searchsorted(upto, share * upto[-1])])
        fixed = limits(2 ** ((of + 0.5) / CLASSES))
        weight = upto[-1] / (upto[-1] + LEAN)
        below, above = (max(x / QUARTILE, LEAST_SPREAD * mid) * SPREADS for x in (mid - low, high - mid))
        out[of] = max(fixed[0], weight * (mid - below) + (1 - weight) * fixed[0]), min(fixed[1], weight * (mid + above) + (1 - weight) * fixed[1])
    return out


def survey(docs: DataFrame, text_col: str = "text") -> dict[int, tuple[float, float]]:
    """The limits that the whole corpus gives. Only counts by class and step come to the driver."""

    def sizes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for part in parts:
            raws = [x.as_buffer() for x in part.column(0).cast(pa.binary()) if x.is_valid]
            raws = [x for x in raws if x.size >= LIMITS[0][0]]
            yield pa.RecordBatch.from_pydict({"n": pa.array([x.size for x in raws], pa.int64()), "packed": pa.array([len(packer.compress(x)) for x in raws], pa.int64())})

    found = small_batches(docs).select(docs[text_col].alias("text")).mapInArrow(giving_back(sizes), "n long, packed long").distinct()
    step = F.least(F.floor(F.col("n") / F.col("packed") * STEPS), F.lit(MOST_STEPS)).cast("int").alias("step")
    rows = found.select(F.floor(F.log2("n") * CLASSES).cast("int").alias("of"), step).groupBy("of", "step").count().collect()
    counts: dict[int, dict[int, int]] = {}
    for of, at, n in rows:
        counts.setdefault(of, {})[at] = n
    return learned_limits(counts)


_OF_CHUNK = {size: limits(size) for size in CHUNKS}


def odd_chunks(raw: bytes, size: int, packer: zstandard.ZstdCompressor) -> list[bool]:
    """For each chunk of a text of more than ``size`` bytes, the tail included, whether it is odd."""
    low, high = _OF_CHUNK[size]
    starts = [*range(0, len(raw) - size, size), len(raw) - size]
    return [not low <= size / len(packer.compress(raw[i : i + size])) <= high for i in starts]


def bands(raw: bytes, packer: zstandard.ZstdCompressor, learned: dict[int, tuple[float, float]]) -> tuple[float | None, int, int, bool]:
    """Ratio, chunks, chunks outside their limits, and whether the text is inside all limits."""
    if len(raw) < LIMITS[0][0]:
        return None, 0, 0, True
    ratio = len(raw) / len(packer.compress(raw))
    (low, high), (least, most) = limits(len(raw)), learned.get(length_class(len(raw)), (0.0, np.inf))
    inside = max(low, least) <= ratio <= min(high, most)
    chunks, odd = 0, 0
    for size in CHUNKS:
        if len(raw) > size:
            found = odd_chunks(raw, size, packer)
            run = max((len([*group]) for is_odd, group in groupby(found) if is_odd), default=0)
            chunks, odd = chunks + len(found), odd + sum(found)
            inside = inside and sum(found) <= CHUNK_SHARE * len(found) and run * size < RUN
    if not chunks:  # the text itself is the one chunk
        chunks, odd = 1, int(not inside)
    return ratio, chunks, odd, inside


def judge(text: str | None, packer: zstandard.ZstdCompressor, learned: dict[int, tuple[float, float]]) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = hash_words(raw)
    repeats = repeat_words(words)
    failed = bool(words.size < 10 or 100 * repeats > 20 * words.size)
    ratio, chunks, odd, inside = bands(raw, packer, learned)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    return words.size, len(text.translate(_NO_SPACE)), symbols, dup_lines(text), repeats, failed, inside and not failed, ratio, chunks, odd


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its id, the base counts, both verdicts and the ratios."""
    kind = docs.schema[id_col].dataType.simpleString()
    ids = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    learned = survey(docs, text_col)

    def judged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for part in parts:
            rows = pd.DataFrame([judge(t, packer, learned) for t in part["text"]], columns=[*COLUMNS])
            yield pd.concat([part["id"].reset_index(drop=True), rows], axis=1)

    schema = ", ".join([f"id {kind}", *[f"{name} {of}" for name, of in COLUMNS.items()]])
    return ids.mapInPandas(giving_back(judged), schema).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    learned = survey(docs, text_col)

    def good(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for part in parts:
            for at in range(0, part.num_rows, 512):
                rows = part.slice(at, 512)
                yield rows.filter(pa.array([judge(t, packer, learned)[6] for t in rows.column(text_col).to_pylist()], pa.bool_()))

    return docs.mapInArrow(giving_back(good), docs.schema)
