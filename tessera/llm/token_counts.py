"""Token counts by heap-and-linked-list byte-pair merging, without a single token id leaving the loop.

A text is cut at the special strings of the vocabulary file (one token each), the rest is normalised
and split into pieces as the file says. A piece starts as one symbol for each byte, in a linked list;
a heap holds its adjacent pairs that have a merge, by rank and then by place. The least is popped
until the heap is empty; each pop that still stands joins two symbols and pushes the two pairs that
the new symbol forms. The count is the number of first symbols less the number of merges.

Null counts as empty and has no tokens. Texts are taken whole, one by one, so ties and repeated rows
give repeated results; an empty table gives an empty one; columns other than those named are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import byte_chars
from tessera.llm.work import small_batches

#: Counted pieces in each of two generations that a worker remembers, and their greatest length in characters.
CACHE, CACHED_CHARS = 1 << 17, 40
#: A place in a piece, beside a rank in one number of the heap.
PLACE_BITS = 32
#: Small letters that Python's tables may lack. The pairs that Unicode 16 added; and the
#: sigma, which Python writes otherwise at the end of a word.
SMALL = {0x03A3: 0x03C3, 0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
_SMALL = regex.compile("[" + "".join(map(chr, SMALL)) + "]")


class MergeCounter:
    """Counts tokens by a vocabulary file: lower-cased NFC text, pieces by a pattern, word ends marked."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps, splits = spec["normalizer"]["normalizers"], spec["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: not a vocabulary of lower-cased words")
        ids: dict[str, int] = model["vocab"]
        chars, end = byte_chars(), model["end_of_word_suffix"]
        self.inner = [ids[chars[b]] for b in range(256)]
        self.last = [ids[chars[b] + end] for b in range(256)]
        #: of a pair of symbols: its merge's rank and what it becomes
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        self.pieces = regex.compile(splits[0]["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count_piece(self, piece: str) -> int:
        raw = piece.encode()
        symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        n, merges = len(symbols), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [merges[pair][0] << PLACE_BITS | i for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in merges]
        heapq.heapify(heap)
        left = n
        while heap:
            top = heapq.heappop(heap)
            i = top & (1 << PLACE_BITS) - 1
            j = after[i]
            rank, joined = merges.get((symbols[i], symbols[j]), (-1, -1)) if j < n else (-1, -1)
            if rank != top >> PLACE_BITS:  # the symbols there have changed since
                continue
            symbols[i], symbols[j] = joined, -1
            after[i] = k = after[j]
            after[j] = n
            left -= 1
            if k < n:
                before[k] = i
                if found := merges.get((joined, symbols[k])):
                    heapq.heappush(heap, found[0] << PLACE_BITS | i)
            if (h := before[i]) >= 0 and (found := merges.get((symbols[h], joined))):
                heapq.heappush(heap, found[0] << PLACE_BITS | h)
        return left

    def count_span(self, span: str) -> int:
        """Of a text without special strings. White space only separates, so it needs no replacing;
        capitals change one by one."""
        span = unicodedata.normalize("NFC", span)
        if not span.isascii() and _SMALL.search(span):
            span = span.translate(SMALL)
        pieces = self.pieces.findall(span.lower())
        fresh = set(pieces).difference(self.known)
        if len(self.known) + len(fresh) > CACHE:  # what is still in use moves on from the generation before
            self.older, self.known, fresh = self.known, {}, set(pieces)
        known, older = self.known, self.older
        for piece in fresh:
            known[piece] = older[piece] if piece in older else self.count_piece(piece)
        out = sum(map(known.__getitem__, pieces))
        for piece in fresh:
            if len(piece) > CACHED_CHARS:
                del known[piece]
        return out

    def count(self, text: str) -> int:
        spans = self.cut.split(text) if self.cut else [text]
        return len(spans) - 1 + sum(map(self.count_span, spans))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One vocabulary for each worker process and file."""
    return MergeCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit); ``path`` is the vocabulary file, present on every executor.

    No row depends on another: one narrow pass, no shuffle, and a lost task repeats only its own rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for part in parts:
            n = [count(t.as_py() or "") for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("n_bytes"), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    n_bytes = F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long")
    rows = small_batches(docs).select(docs[id_col].alias("id"), n_bytes.alias("n_bytes"), docs[text_col].alias("text"))
    counted = rows.mapInArrow(batches, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
