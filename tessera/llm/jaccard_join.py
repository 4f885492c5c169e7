"""N-gram Jaccard join: which documents share nearly all their word shingles.

Links are found by a blocked product of the sparse document by n-gram incidence matrix A with its
transpose:

1. Column blocks tell which rows can link. Two sets of sizes a and b that link differ in at most
   d = (a + b)(1 - t)/(1 + t) n-grams, so of more than d column blocks, dealt by a hash of the
   n-gram, one at least is equal in both rows. The number of blocks follows from the size: sizes
   fall into classes whose ends are in the ratio t, and a row is blocked once for its own class and
   once for the next, which covers every pair whose sizes let it link. A pair whose equal blocks
   are all empty can't be found; a row with so many empty blocks that this could happen is blocked
   again by another hash, and at last by none; it is found by rows that need no other blocking in
   their last, which it has too. n-grams that stand in very many documents are left out of the first
   two blockings (the bound holds for what is left), so that a passage everybody quotes joins nobody;
   the second has blocks of hardly more than one n-gram. Only rows with fewer other n-grams than may
   differ are blocked with all.
   Block hashes go to the shuffle packed, eight bytes each with their row. Pairs of rows with an equal
   block are dropped where sketches of the rows (n-grams by bins, a byte for four to eight of them) differ
   by more than links do; else what chance joins would grow with the square of the corpus. Of a block in
   more than ``PAIRED`` rows not pairs but links from the first row are given, which stay.
2. Rows joined by such pairs, directly or through others, are a family: A is block-diagonal but
   for n-grams that can't make a link. Each family is a row block. One too large for a task is dealt
   into tiles of bounded size, and each pair of tiles is a block of the product. Families of many
   tiles are cut again by other blocks first, which takes apart what only chance had joined.
3. In each block overlap counts are accumulated over column blocks, rare n-grams first. Rows whose
   shared n-grams are fewer than their size asks for are taken out before, again and again, as that
   makes other n-grams unshared; pairs whose count and remaining n-grams stay below the bound of
   their sizes are discarded on the way.
4. A block gives only as many links as join the rows that it found linked, at most one a row. Neither
   pairs nor n-grams ever are rows of a table. The components of these links are the result.

Sets that are equal are one row of A. A-Z are lower-cased; words are runs of anything but ASCII white
space. A text with fewer words than a shingle has its whole sequence as the only one; without words or
text the set is empty and the document a component of its own, whose id is its own id, null for a null
id. Repeated rows have equal sets and so one component. Components with ids take the smallest id.
n-grams and sets are known by 64-bit hashes. Columns beyond those named are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components, roots
from tessera.llm.work import bounded, giving_back, hash_shingles, hash_words, mix64, rows_that_stay, small_batches, staged, superseded

_U = np.uint64
#: An n-gram is common from so many documents on; at most COMMON_MOST of them can be.
LEAST_COMMON, COMMON_MOST = 50, 1 << 20
#: n-grams counted together, and occurrences among them below which none is noted.
COUNTED, NOTED = 1 << 20, 3
#: Block hashes that are packed together, and n-grams whose hashes make up a bucket, about.
BLOCKS, BUCKET = 1 << 19, 1 << 19
#: Rows of one block hash that give all their pairs, at most.
PAIRED = 16
#: Blockings before a row is blocked as a whole: of which n-grams, and how many times the blocks.
VIEWS = (("rare", 1), ("rare", 16), ("all", 1), ("all", 1))
#: Rows and n-grams in a tile of a family, about.
TILE_ROWS, TILE_GRAMS = 1_024, 1 << 19
#: Families of more tiles are blocked again, by at most so many further cuts.
MANY_TILES, CUTS = 4, 4
#: Cells of a dense column block, and row pairs of a sparse one, that are multiplied at a time.
CELLS = 1 << 22
#: What a row pair of a sparse column costs, in cells of a dense one.
SPARSE = 256


@dataclass(frozen=True)
class Sizes:
    """Size classes for links of at least ``num`` / ``den``, and the blocks of each level."""

    num: int
    den: int
    top: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        low = 1
        while low < 1 << 40:
            high = low * self.den // self.num
            self.top.append(high)
            low = high + 1

    def level(self, n: int) -> int:
        return int(np.searchsorted(self.top, n))

    def blocks(self, level: int) -> tuple[int, int]:
        """Number of blocks, and how many of them must hold something in a row that is surely found."""
        most = 2 * self.top[level] * (self.den - self.num) // (self.den + self.num)
        if not most:
            return 1, 1
        least = 1 if level < 2 else self.top[level - 2] + 1
        return most + 2 + math.ceil(1.5 * (most + 1) * math.exp(-least / (most + 1))), most + 1

    def linked(self, a: int, b: int, both: int) -> bool:
        return self.den * both >= self.num * (a + b - both)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The sorted hashes of the distinct shingles of a text."""
    return np.unique(hash_shingles(hash_words((text or "").encode("utf-8", "surrogatepass").lower()), k))


def _block_hashes(grams: np.ndarray, level: int, count: int, view: int) -> np.ndarray:
    """Hashes of the non-empty blocks of a row."""
    salt = mix64(np.array([level * 4096 + view + 1], _U))[0]
    place = (mix64(grams ^ salt) % _U(count)).astype(np.int64)
    sums = np.zeros(count, _U)
    np.add.at(sums, place, mix64(grams + salt))
    full = np.flatnonzero(np.bincount(place, minlength=count))
    return mix64(sums[full] + mix64((full + 1).astype(_U) * salt))


def signatures(grams: np.ndarray, common: np.ndarray, sizes: Sizes, cut: int = 0) -> np.ndarray:
    """Block hashes under which a row can be found by any row that it links with.

    Each ``cut`` deals the n-grams to blocks in another way, and holds for all links by itself.
    """
    out = []
    rare = grams
    if common.size:
        at = np.minimum(np.searchsorted(common, grams), common.size - 1)
        rare = grams[common[at] != grams]
    own = sizes.level(grams.size)
    for level in (own, own + 1):
        count, need = sizes.blocks(level)
        for view, (of, finer) in enumerate(VIEWS):
            found = _block_hashes(rare if of == "rare" else grams, level, count * finer, cut * len(VIEWS) + view)
            out.append(found)
            if found.size >= need:
                break
        else:
            out.append(mix64(np.array([level + 1], _U)))
    return np.unique(np.concatenate(out))


def set_key(grams: np.ndarray) -> int:
    return int(mix64(np.array([np.add.reduce(mix64(grams + _U(11)))], _U) + _U(grams.size)).view(np.int64)[0])


def _slices(parts: Iterator[pd.DataFrame], k: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    for part in parts:
        for at in range(0, len(part), 256):
            rows = part.iloc[at : at + 256].reset_index(drop=True)
            yield rows, [shingle_set(t, k) for t in rows["text"]]


def _surveyed(texts: DataFrame, k: int) -> DataFrame:
    """Two kinds of rows: (id, n, key, sketch) for each text, key null for empty sets; and (gram, times).

    Every n-gram is counted; among each ``COUNTED`` those that occur fewer than ``NOTED`` times are
    dropped, so counts are lower bounds.
    """

    def survey(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def noted() -> pd.DataFrame:
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= NOTED
            return pd.DataFrame({"id": None, "n": None, "key": None, "sketch": None, "gram": grams[often].view(np.int64), "times": n[often]})

        for rows, sets in _slices(parts, k):
            keys = pd.array([set_key(x) if x.size else None for x in sets], dtype="Int64")
            yield pd.DataFrame({"id": rows["id"], "n": [x.size for x in sets], "key": keys, "sketch": [sketch(x) if x.size else None for x in sets], "gram": None, "times": None})
            held += sets
            size += sum(x.size for x in sets)
            if size >= COUNTED:
                yield noted()
                size, held = 0, []
        if held:
            yield noted()

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInPandas(giving_back(survey), f"id {kind}, n long, key long, sketch binary, gram long, times long")


def _common(surveyed: DataFrame) -> np.ndarray:
    """Sorted hashes of n-grams that stand in very many documents.

    The least count grows with the corpus so that the table is at most ``COMMON_MOST`` long. Which
    n-grams are in it never changes a result.
    """
    total = surveyed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(LEAST_COMMON, total // COMMON_MOST + 1)
    counts = surveyed.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("times").alias("n"))
    found = counts.where(F.col("n") >= least).select("gram").toPandas()["gram"]
    return np.sort(found.to_numpy(np.int64).view(_U))


def sketch(grams: np.ndarray) -> bytes:
    """How many n-grams fall into each of some n / 8 to n / 4 bins, a byte each."""
    bins = 1 << max(0, (grams.size // 4).bit_length() - 1)
    return np.minimum(np.bincount((grams & _U(bins - 1)).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def apart(x: bytes, y: bytes) -> int:
    """n-grams in which two sets differ at least, by their sketches; the finer one is folded."""
    a, b = (np.frombuffer(s, np.uint8).astype(np.int64) for s in (x, y))
    bins = min(a.size, b.size)
    a, b = (np.minimum(c.reshape(-1, bins).sum(0), 255) for c in (a, b))
    return int(np.abs(a - b).sum())


def _group_pairs(sig: np.ndarray, key: np.ndarray) -> pd.DataFrame:
    """Pairs (a, b, open) of the keys of each block hash; rows are sorted and distinct.

    Up to ``PAIRED`` keys give all their pairs, which are open: a pair may be dropped by itself. More
    give pairs of the first and each other one, which hold the group together and so are not.
    """
    new = np.append(True, sig[1:] != sig[:-1])
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, sig.size))
    few = size[group] <= PAIRED
    a, b = [key[begin[group[~few]]]], [key[~few]]
    n_closed = b[0].size
    for step in range(1, min(PAIRED, int(size.max(initial=0)))):
        low = np.flatnonzero(few[:-step] & (group[:-step] == group[step:]))
        a.append(key[low])
        b.append(key[low + step])
    a, b = np.concatenate(a), np.concatenate(b)
    out = pd.DataFrame({"a": a, "b": b, "open": np.arange(a.size) >= n_closed})
    return out[a != b].drop_duplicates()


def _packed(sigs: list[np.ndarray], keys: list[int], buckets: int) -> pd.DataFrame:
    """Rows (bucket, cells): the block hashes that fall into each bucket and the keys they are of, cut to
    four bytes each. What this confuses gives more pairs, never fewer, and their sketches tell them apart."""
    sig, key = np.concatenate(sigs), np.repeat(np.array(keys, np.int64).view(_U).astype(np.uint32), [x.size for x in sigs])
    bucket = ((sig >> _U(32)) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cells = np.column_stack([sig.astype(np.uint32), key])[order]
    found, first = np.unique(bucket[order], return_index=True)
    return pd.DataFrame({"bucket": found, "cells": [x.tobytes() for x in np.split(cells, first[1:])]})


def _neighbours(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of each bucket; rows come sorted by bucket, and a task holds one."""
    last, held = None, []

    def pairs() -> pd.DataFrame:
        cells = np.frombuffer(b"".join(held), np.uint32).astype(_U).reshape(-1, 2)
        both = np.unique(cells[:, 0] << _U(32) | cells[:, 1])
        return _group_pairs((both >> _U(32)).astype(np.int64), (both & _U((1 << 32) - 1)).astype(np.int64))

    for part in parts:
        for bucket, cells in zip(part["bucket"], part["cells"], strict=True):
            if bucket != last and held:
                yield pairs()
                held = []
            last = bucket
            held.append(cells)
    if held:
        yield pairs()


def _may_link(pairs: DataFrame, sketches: DataFrame, sizes: Sizes) -> DataFrame:
    """The links (a, b), staged, of ``pairs`` without open ones whose sketches differ by more than links do."""

    def near(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            most = (sizes.den - sizes.num) * (part["n_a"] + part["n_b"])
            least = np.array([open and apart(x, y) for open, x, y in zip(part["open"], part["x"], part["y"], strict=True)], np.int64)
            yield part.loc[((sizes.num + sizes.den) * least <= most).to_numpy(), ["a", "b"]]

    side = lambda x: sketches.select((F.col("key").bitwiseAND(F.lit((1 << 32) - 1))).alias(x), F.col("key").alias(f"key_{x}"), F.col("n").alias(f"n_{x}"), F.col("sketch").alias({"a": "x", "b": "y"}[x]))
    found = pairs.groupBy("a", "b").agg(F.every("open").alias("open"))
    both = found.join(side("a"), "a").join(side("b"), "b").drop("a", "b").withColumnsRenamed({"key_a": "a", "key_b": "b"})
    return staged(both.mapInPandas(giving_back(near), "a long, b long"), "near")


def _families(texts: DataFrame, sketches: DataFrame, k: int, sizes: Sizes, common: np.ndarray, cut: int) -> DataFrame:
    """Rows (key, comp): the families of sets in ``texts`` (text, family), within each family given.

    Sets that can link with no other are left out. A task gives the blocks of equal sets once, as far
    as it sees them together.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(common)
    total = sketches.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET)

    def cells(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        keys, sigs, size = [], [], 0
        for rows, sets in _slices(parts, k):
            for grams, family in zip(sets, rows["family"].to_numpy(np.int64).view(_U), strict=True):
                if grams.size and ((key := set_key(grams)), int(family)) not in seen:
                    seen.add((key, int(family)))
                    keys.append(key)
                    sigs.append(mix64(signatures(grams, shared.value, sizes, cut) ^ family))
                    size += sigs[-1].size
            if size >= BLOCKS:
                yield _packed(sigs, keys, buckets)
                keys, sigs, size = [], [], 0
        if keys:
            yield _packed(sigs, keys, buckets)

    dealt = texts.select("text", "family").mapInPandas(giving_back(cells), "bucket long, cells binary").repartition("bucket").sortWithinPartitions("bucket")
    pairs = dealt.mapInPandas(giving_back(_neighbours), "a long, b long, open boolean")
    links = _may_link(pairs, sketches, sizes)
    out = components(links)
    superseded(links)
    return out


def _tiled(members: DataFrame) -> DataFrame:
    """``members`` (key, comp, ...) with the number of tiles of their family, which is mostly 1."""
    tiles = F.ceil(F.greatest(F.count(F.lit(1)) / TILE_ROWS, F.sum("n") / TILE_GRAMS)).cast("int")
    large = staged(members.groupBy("comp").agg(tiles.alias("tiles")).where("tiles > 1"), "large")
    return members.join(bounded(large), "comp", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))


def _of_shared_ids(texts: DataFrame, surveyed: DataFrame, k: int) -> DataFrame | None:
    """Rows (id, mark, text), one for each set, of ids that are null or not a row's own; None without such."""
    doubts = staged(surveyed.groupBy(F.col("id").alias("shared")).count().where("shared IS NULL OR count > 1").select("shared"), "shared")
    if doubts.isEmpty():
        superseded(doubts)
        return None
    odd = texts.join(bounded(doubts), F.col("id").eqNullSafe(F.col("shared")), "left_semi")
    out = staged(odd.withColumn("mark", _mark(F.col("text"), k)).groupBy("id", "mark").agg(F.max("text").alias("text")), "marked")
    superseded(doubts)
    return out


def _with_texts(texts: DataFrame, marked: DataFrame | None, members: DataFrame) -> DataFrame:
    """``members`` with the text of the row that stands for each: known by its id, and by its key too
    where the id is null or not its own."""
    of_id = F.col("id").eqNullSafe(F.col("rep"))
    if marked is None:
        return texts.join(bounded(members), of_id)
    shared = marked.select(F.col("id").alias("shared")).distinct()
    both = F.col("rep").eqNullSafe(F.col("shared"))
    clear = texts.join(bounded(members.join(shared, both, "left_anti")), of_id)
    odd = marked.join(bounded(members.join(shared, both, "left_semi")), of_id & (F.col("mark") == F.col("key")))
    return clear.unionByName(odd.drop("mark"))


def overlaps(x: list[np.ndarray], y: list[np.ndarray], sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the linked pairs of rows of ``x`` and of ``y``; of x alone if ``y`` is ``x``."""
    same = x is y
    sides = [x] if same else [x, y]
    size = [np.array([s.size for s in side], np.int64) for side in sides]
    row = [np.repeat(np.arange(len(side)), n) for side, n in zip(sides, size, strict=True)]
    col = np.unique(np.concatenate([g for side in sides for g in side]), return_inverse=True)[1]
    col = np.split(col, [row[0].size])[: len(sides)]
    n_cols = 1 + max((int(c.max()) for c in col if c.size), default=-1)

    def shared() -> bool:
        """Take out columns that no pair shares and rows that share too little; whether any went."""
        counts = [np.bincount(c, minlength=n_cols) for c in col]
        both = counts[0] > 1 if same else (counts[0] > 0) & (counts[1] > 0)
        went = False
        for i in range(len(sides)):
            stay = both[col[i]]
            left = np.bincount(row[i][stay], minlength=size[i].size)
            stay &= (sizes.den * left >= sizes.num * size[i])[row[i]]
            went |= not stay.all()
            row[i], col[i] = row[i][stay], col[i][stay]
        return went

    while shared():
        pass
    none = np.empty(0, np.int64)
    if not row[0].size or not row[-1].size:
        return none, none
    rows, at = zip(*(np.unique(r, return_inverse=True) for r in row), strict=True)
    count = np.bincount(col[0], minlength=n_cols) * np.bincount(col[-1], minlength=n_cols)
    # columns numbered by how many pairs share them, fewest first
    number = np.empty(n_cols, np.int64)
    number[np.argsort(count, kind="stable")] = np.arange(n_cols)
    count = np.sort(count)
    number -= n_cols - np.count_nonzero(count)
    count = count[count > 0]
    width = rows[0].size, rows[-1].size
    order = [np.argsort(number[c], kind="stable") for c in col]
    at = [a[o] for a, o in zip(at, order, strict=True)]
    col = [number[c][o] for c, o in zip(col, order, strict=True)]
    n_sparse = int(np.searchsorted(count, width[0] * width[1] / SPARSE))
    step = max(1, CELLS // max(width))
    ends = [0, *(np.searchsorted(np.cumsum(count[:n_sparse]), np.arange(CELLS, count[:n_sparse].sum() + CELLS, CELLS), "right")).tolist()]
    ends = sorted({*ends, n_sparse, *range(n_sparse, count.size, step), count.size})

    a, b = size[0][rows[0]], size[-1][rows[-1]]
    need = -(-sizes.num * (a[:, None] + b[None]) // (sizes.num + sizes.den)).astype(np.int32)
    total = np.zeros(width, np.int32)
    rest = [np.bincount(x, minlength=w) for x, w in zip((at[0], at[-1]), width, strict=True)]
    for low, high in zip(ends, ends[1:], strict=False):
        part = [slice(*np.searchsorted(c, [low, high])) for c in (col[0], col[-1])]
        rows_at = [at[0][part[0]], at[-1][part[1]]]
        cols_at = [col[0][part[0]], col[-1][part[1]]]
        if high <= n_sparse:
            begin = np.searchsorted(cols_at[1], cols_at[0])
            many = np.searchsorted(cols_at[1], cols_at[0], "right") - begin
            slot = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            total += np.bincount(np.repeat(rows_at[0], many) * width[1] + rows_at[1][slot], minlength=total.size).reshape(width).astype(np.int32)
        else:
            dense = [np.zeros((w, high - low), np.float32) for w in width[: len(sides)]]
            for matrix, r, c in zip(dense, rows_at, cols_at, strict=False):
                matrix[r, c - low] = 1
            total += (dense[0] @ dense[-1].T).astype(np.int32)
        for i in (0, 1):
            rest[i] = rest[i] - np.bincount(rows_at[i], minlength=width[i])
        if high < count.size and not (total + np.minimum(rest[0][:, None], rest[1][None]) >= need).any():
            return none, none
    hit = total >= need
    if same:
        hit = np.triu(hit, 1)
    i, j = np.nonzero(hit)
    return rows[0][i], rows[-1][j]


def _product(parts: Iterator[pd.DataFrame], k: int, sizes: Sizes) -> Iterator[pd.DataFrame]:
    """The links (a, b) that join what is linked in each block; rows come sorted by block.

    A task holds one block, which is one tile or two.
    """
    block, keys, sets, tiles = None, [], [], []

    def forest() -> pd.DataFrame:
        names = np.array(keys, np.int64)
        tile = np.array(tiles, np.int64)
        low, high = np.flatnonzero(tile == block[1]), np.flatnonzero(tile == block[2])
        x = [sets[i] for i in low]
        a, b = overlaps(x, x if block[1] == block[2] else [sets[i] for i in high], sizes) if low.size and high.size else (low[:0], high[:0])
        root = roots(low[a], high[b], names.size)
        own = np.flatnonzero(root != np.arange(names.size))
        return pd.DataFrame({"a": names[root[own]], "b": names[own]})

    for part in parts:
        for comp, i, j, tile, key, text in zip(*(part[c] for c in ("comp", "i", "j", "tile", "key", "text")), strict=True):
            if (comp, i, j) != block:
                if keys:
                    yield forest()
                block, keys, sets, tiles = (comp, i, j), [], [], []
            if keys and keys[-1] == key:
                continue
            grams = shingle_set(text, k)
            if set_key(grams) == key:
                keys.append(key)
                sets.append(grams)
                tiles.append(tile)
    if keys:
        yield forest()


def judged(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n, key, comp, component_id) for the rows of ``docs``, staged.

    ``key`` tells sets apart and ``comp`` components; both are null for an empty set.
    """
    sizes = Sizes(num, den)
    texts = small_batches(docs).select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    surveyed = staged(_surveyed(texts, k), "surveyed")
    common = _common(surveyed)
    rows = surveyed.where("n IS NOT NULL").select("id", "n", "key")
    marked = _of_shared_ids(texts, rows, k)
    reps = staged(rows.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"), F.min("n").alias("n")), "reps")
    sketches = staged(surveyed.where("key IS NOT NULL").select("key", "n", "sketch").dropDuplicates(["key"]), "sketches")

    found = _families(texts.withColumn("family", F.lit(0).cast("long")), sketches, k, sizes, common, 0)
    members = staged(_tiled(found.join(reps, "key")), "members")
    for cut in range(1, CUTS):
        large = members.where(F.col("tiles") > MANY_TILES)
        if large.isEmpty():
            break
        again = _with_texts(texts, marked, large.select("rep", "key", F.col("comp").alias("family")).distinct())
        found = _families(again, sketches, k, sizes, common, cut)
        parted = large.select("key", "rep", "n").join(found, "key")
        rest = members.where(F.col("tiles") <= MANY_TILES)
        before, members = members, staged(_tiled(parted.select("comp", "key", "rep", "n")).unionByName(rest), "members")
        superseded(before)

    tile = F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(F.least("tile", j).alias("i"), F.greatest("tile", j).alias("j")))
    blocks = members.withColumn("tile", tile).select("comp", "key", "rep", "tile", F.explode(pairs).alias("block")).select("*", "block.i", "block.j")
    dealt = _with_texts(texts, marked, blocks).select("comp", "i", "j", "tile", "key", "text").repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "key")
    links = staged(dealt.mapInPandas(giving_back(lambda parts: _product(parts, k, sizes)), "a long, b long"), "links")
    labels = components(links)
    least = labels.join(reps, "key").groupBy("comp").agg(F.min("rep").alias("least"))
    named = reps.join(labels.join(staged(least, "least"), "comp"), "key", "left")
    named = staged(named.select("key", F.coalesce("comp", "key").alias("comp"), F.when(F.col("comp").isNull(), F.col("rep")).otherwise(F.col("least")).alias("component_id")), "named")
    some = rows.where("key IS NOT NULL").join(named, "key").select("id", "n", "key", "comp", "component_id")
    none = rows.where("key IS NULL").select("id", "n", "key", F.lit(None).cast("long").alias("comp"), F.col("id").alias("component_id"))
    out = staged(some.unionByName(none), "judged")
    superseded(surveyed, reps, sketches, members, links, named, *([] if marked is None else [marked]))
    return out


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_shingles, component_id) for the rows of ``docs``.

    Two documents link when den * intersection >= num * union of their sets of ``k``-word shingles.
    """
    return judged(docs, k, num, den, id_col, text_col).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _mark(text: Column, k: int) -> Column:
    """The key of a text's set, 0 for an empty one."""

    @F.pandas_udf("long")
    def mark(texts: pd.Series) -> pd.Series:
        sets = (shingle_set(t, k) for t in texts)
        return pd.Series([set_key(x) if x.size else 0 for x in sets], dtype="int64")

    return mark(text)


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that with the smallest id.

    A null id comes after all others. Documents without words stay, but of rows that repeat an id
    (or have none) and have equal sets, empty ones included, one stays.
    """
    rows = judged(docs, k, num, den, id_col, text_col)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key"))
    best = staged(rows.where("key IS NOT NULL").groupBy("comp").agg(first.alias("best")), "best")
    mine = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("key") == F.col("best.key"))
    some = rows.where("key IS NOT NULL").join(best, "comp").select("id", F.col("key").alias("mark"), mine.alias("stays"))
    none = rows.where("key IS NULL").select("id", F.lit(0).cast("long").alias("mark"), F.lit(True).alias("stays"))
    stay = staged(some.unionByName(none), "stay")
    superseded(rows, best)
    return rows_that_stay(docs, stay, id_col, _mark(docs[text_col], k))
