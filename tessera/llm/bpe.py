"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A greedy walk takes the longest vocabulary entry at each place (found for all places at once by an
Aho-Corasick automaton) and keeps it if it may stand after the token before: two tokens are
compatible when merging their joint text would not cross the border between them. If no shorter
entry fits either, the walk steps back one token and marks the place as a dead end, so each place
is left at most once and the time is linear. What is kept is exactly what applying the merges in
order gives.

Null counts as empty and gives no ids. Lone surrogates can't occur in Spark strings. Rows are
encoded one by one, so ties and repeated rows give repeated results; an empty table gives an empty
one; columns other than those named are ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.work import giving_back, small_batches

#: Splits text before the merges. Fixed value: the pattern of the public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encoded pieces in each of two generations that a worker remembers, and their greatest length in characters.
CACHE, CACHED_CHARS = 1 << 17, 40
#: Compatible and other pairs that a worker remembers.
PAIRS = 1 << 19
#: Documents that a worker holds as lists of ids at a time.
SLICE = 128


def byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in the vocabulary file: visible Latin-1 characters stand
    for themselves, the others for code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BytePairs:
    """A vocabulary: automaton, splits and compatibility for encoding, offset table for decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        self.chars = byte_chars()
        self.table = self.chars
        #: merge order of a joined pair; of a token, -1 for single bytes
        self.joined = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(merges)}
        self.parts = {ids[a + b]: (ids[a], ids[b]) for a, b in reversed(merges)}
        self.rank = {ids[a + b]: rank for rank, (a, b) in reversed([*enumerate(merges)])}
        self.length_of = {i: len(t) for t, i in ids.items()}
        self.ids = ids
        self.automaton = ahocorasick.Automaton()
        for t, i in ids.items():
            self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        self.shorter = {i: next((ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ids), None) for t, i in ids.items()}
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.split = regex.compile(PATTERN)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.stand_in = {b: c for b, c in self.chars.items() if b < 128}
        back = {c: b for b, c in self.chars.items()}
        size = 1 + max([*ids.values(), *self.special.values()])
        raw = [b""] * size
        for t, i in ids.items():
            raw[i] = bytes(back[c] for c in t)
        for t, i in self.special.items():
            raw[i] = t.encode()
        self.start = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave a border between the two tokens where it is.

        Undo the merges at the border, the latest first: the border falls if a pair that meets at
        it on some level would have been joined before the merges that built its sides further.
        """
        key = left << 32 | right
        rank, parts, joined = self.rank, self.parts, self.joined
        a, b, bound, ok = left, right, 1 << 60, True
        while True:
            join = joined.get((a, b))
            if join is not None and join < bound:
                ok = False
                break
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:  # the left side's last merge is undone; joins from now on must come before it
                bound, a = ra, parts[a][1]
            else:  # of equal order the left one merges first, so a join of that order crosses
                bound, b = rb + 1, parts[b][0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = ok
        return ok

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece of the split text."""
        text = piece.translate(self.stand_in) if piece.isascii() else "".join(map(self.table.__getitem__, piece.encode("utf-8")))
        walk = [i for _, (_, i) in self.automaton.iter_long(text)]  # the longest match at each place in turn
        pairs, left = self.pairs, -1
        for right in walk:
            if left >= 0 and not (pairs[key] if (key := left << 32 | right) in pairs else self.fits(left, right)):
                return self.backtrack(text)
            left = right
        return tuple(walk)

    def backtrack(self, text: str) -> tuple[int, ...]:
        """The walk where a longest match has to give way."""
        n = len(text)
        longest = [0] * n
        size = [0] * n
        for end, (length, i) in self.automaton.iter(text):
            at = end + 1 - length
            if length > size[at]:
                size[at], longest[at] = length, i
        dead = bytearray(n + 1)
        pairs, fits, length_of, shorter = self.pairs, self.fits, self.length_of, self.shorter
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            tried: int | None = token
            left = out[-1] if out else -1
            while tried is not None:
                if not dead[at + length_of[tried]] and (left < 0 or (pairs[key] if (key := left << 32 | tried) in pairs else fits(left, tried))):
                    break
                tried = shorter[tried]
            if tried is None:
                dead[at] = 1
                token = out.pop()
                at -= length_of[token]
            else:
                out.append(tried)
                at += length_of[tried]
                token = longest[at] if at < n else 0
        return tuple(out)

    def encode_span(self, span: str) -> Iterator[int]:
        """Ids of a text without special strings; each distinct piece is encoded once."""
        pieces = self.split.findall(span)
        fresh = set(pieces).difference(self.known)
        if len(self.known) + len(fresh) > CACHE:  # what is still in use moves on from the generation before
            self.older, self.known, fresh = self.known, {}, set(pieces)
        known, older = self.known, self.older
        for piece in fresh:
            known[piece] = older[piece] if piece in older else self.encode_piece(piece)
        out = itertools.chain.from_iterable([*map(known.__getitem__, pieces)])
        for piece in fresh:
            if len(piece) > CACHED_CHARS:
                del known[piece]
        return out

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for k, span in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                out.append(self.special[span])
            else:
                out += self.encode_span(span)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Gather the bytes of all ids at once by their offsets."""
        ids = np.asarray(ids, np.int64)
        first, size = self.start[ids], self.start[ids + 1] - self.start[ids]
        ends = np.cumsum(size)
        if not ids.size or not ends[-1]:
            return ""
        place = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
        return self.bytes[place].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> BytePairs:
    """One vocabulary for each worker process and file."""
    return BytePairs(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode_too: bool = False) -> DataFrame:
    """Rows (id, ids[, decoded]); ``path`` is the vocabulary file, present on every executor.

    Ids and the text decoded from them come from one pass in one worker. A batch is taken in
    slices, so that a worker holds the lists of few documents at a time.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = pa.schema([("ids", pa.list_(pa.int32())), *([("decoded", pa.string())] if decode_too else [])])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = vocabulary(path)
        for part in parts:
            for at in range(0, part.num_rows, SLICE):
                rows = part.slice(at, SLICE)
                ids = [np.array(pairs.encode(t or ""), np.int32) for t in rows.column("text").to_pylist()]
                ends = np.concatenate(([0], np.cumsum([x.size for x in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                texts = [pa.array([pairs.decode(x) for x in ids], pa.string())] if decode_too else []
                yield pa.RecordBatch.from_arrays([rows.column("id"), lists, *texts], names=["id", *schema.names])

    out = f"id {kind}, ids array<int>" + ", decoded string" * decode_too
    return small_batches(docs).select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(giving_back(batches), out).withColumnRenamed("id", id_col)


def decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, decoded); bytes that are not UTF-8 become U+FFFD, null ids the empty text."""
    kind = coded.schema[id_col].dataType.simpleString()

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = vocabulary(path)
        for part in parts:
            yield part[["id"]].assign(decoded=["" if x is None else pairs.decode(x) for x in part["ids"]])

    return small_batches(coded).select(coded[id_col].alias("id"), coded[ids_col].alias("ids")).mapInPandas(batches, f"id {kind}, decoded string").withColumnRenamed("id", id_col)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids, decoded)."""
    return encode(docs, path, id_col, text_col, decode_too=True)
