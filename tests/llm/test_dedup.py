"""Exact dedup, the Jaccard join and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, jaccard_join, repeats, work
from tessera.llm.components import components
from tessera.llm.work import new_folder

DOCS = "doc_id long, text string, key long, n long, digest string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "z") for i, t in rows], DOCS)


def test_exact_dedup(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\tb "), (5, None), (6, ""), (7, " "), (8, "c"), (8, "c"), (None, "d"), (9, "d")]
    got = exact_dedup.exact_dedup(table(spark, rows)).collect()
    assert len(got) == len(rows)
    kept = sorted((r["doc_id"] for r in got if r["kept"]), key=str)
    assert kept == sorted([3, 7, 8, 9], key=str)
    assert {r["doc_id"]: r["group_size"] for r in got} == {1: 4, 2: 4, 3: 4, 4: 4, 5: 3, 6: 3, 7: 3, 8: 2, None: 2, 9: 2}
    stay = exact_dedup.keep_first(table(spark, rows))
    assert stay.columns == ["doc_id", "text", "key", "n", "digest"]
    assert sorted(r["doc_id"] for r in stay.collect()) == [3, 7, 8, 9]


@pytest.mark.parametrize("hot", [1, 1 << 20])
def test_exact_dedup_in_batches(spark, monkeypatch, hot):
    """Batches by length give what one batch gives, and later ones meet an index with rows."""
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", hot)
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 60), rnd.choice([None, "", " ", "a b", "ab", " a  b", "a" + " " * 30 + "b", "x y z" * 5, "xyz" * 5])) for _ in range(150)] + [(None, "ab")]
    met = []
    unseen = exact_dedup.DigestIndex.unseen
    monkeypatch.setattr(exact_dedup.DigestIndex, "unseen", lambda self, found: met.append((self.read().count(), found.count())) or unseen(self, found))
    key = lambda r: str(tuple(r))
    whole = exact_dedup.exact_dedup(table(spark, rows)).collect()
    del met[:]
    assert sorted(exact_dedup.exact_dedup_in_batches(table(spark, rows), (20, 3)).collect(), key=key) == sorted(whole, key=key)
    assert len(met) == 3 and met[0][0] == 0 and met[2][0] > 0
    assert exact_dedup.exact_dedup_in_batches(table(spark, [])).count() == 0


def test_index_persists(spark):
    path = new_folder(spark, "index")
    first = exact_dedup.DigestIndex(spark, path, 8)
    assert exact_dedup.exact_dedup(table(spark, [(1, "a"), (2, "b"), (3, "b")]), first).where("kept").count() == 2
    again = exact_dedup.DigestIndex(spark, path, 8)
    got = {r["doc_id"]: (r["kept"], r["keep_id"]) for r in exact_dedup.exact_dedup(table(spark, [(10, "b"), (11, "c"), (12, "c")]), again).collect()}
    assert got == {10: (False, 2), 11: (True, 11), 12: (False, 11)}
    assert again.read().count() == 3
    assert exact_dedup.exact_dedup(table(spark, []), again).count() == 0


def test_index_batches(spark):
    """A batch run again gives the same rows; another number of buckets is refused, none is fine."""
    path = new_folder(spark, "index")
    index = exact_dedup.DigestIndex(spark, path, 8)
    run = lambda rows, name, at=index: sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup.exact_dedup(table(spark, rows), at, batch=name).collect())
    first = run([(1, "a"), (2, "b"), (3, "b")], "one")
    assert first == [(1, 1, True), (2, 2, True), (3, 2, False)]
    assert run([(1, "a"), (2, "b"), (3, "b")], "one") == first and index.read().count() == 2
    # the first half of a batch had been appended when it failed
    index.append(exact_dedup.groups(exact_dedup.digests(table(spark, [(20, "x")])).withColumn("row", F.lit(0))), "two")
    second = [(20, 20, True), (21, 21, True), (22, 1, False)]
    assert run([(20, "x"), (21, "y"), (22, "a")], "two") == second
    reopened = exact_dedup.DigestIndex(spark, path)
    assert reopened.buckets == 8 and run([(20, "x"), (21, "y"), (22, "a")], "two", reopened) == second
    texts = [(100 + i, f"t{i}") for i in range(200)]
    assert all(x[2] for x in run(texts, "three", reopened)) and not any(x[2] for x in run(texts, "four", exact_dedup.DigestIndex(spark, path)))
    for wrong in ({"buckets": 16}, {"id_type": "string"}):
        with pytest.raises(ValueError):
            exact_dedup.DigestIndex(spark, path, **wrong)


def test_hot_digest(spark):
    rows = [(i, "same") for i in range(3000)] + [(5000 + i, f"t{i}") for i in range(3000)]
    got = exact_dedup.exact_dedup(table(spark, rows))
    assert got.where("kept").count() == 3001 and got.count() == 6000


def brute_components(docs, k, num, den):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i in sorted(sets):
        both = Counter(j for g in sets[i] for j in where.get(g, ()))
        for j, b in both.items():
            if den * b >= num * (len(sets[i]) + len(sets[j]) - b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
        for g in sets[i]:
            where.setdefault(g, []).append(i)
    return {i: (len(sets[i]), top(i)) for i in sets}


def near_docs():
    rnd = random.Random(5)
    vocabulary = [f"W{i}" for i in range(300)]
    docs = []
    for _ in range(30):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 9, 12, 20, 40, 100, 400]))]
        for _ in range(rnd.choice([1, 2, 8, 20])):
            rate = rnd.choice([0, 0.005, 0.01, 0.03, 0.05])
            docs.append(" ".join(w if rnd.random() > rate else rnd.choice(vocabulary) for w in base))
    line = " ".join(vocabulary[:20])
    docs += [line + " " + " ".join(rnd.choice(vocabulary) for _ in range(30)) for _ in range(80)]
    docs += [" ".join(rnd.choice(vocabulary[:6]) for _ in range(rnd.randint(0, 8))) for _ in range(100)]
    return list(enumerate(docs)) + [(9001, None), (9002, ""), (9003, " \n"), (9004, "One"), (9005, "one")]


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_jaccard_components(spark, k, num, den):
    docs = near_docs()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(table(spark, docs), k, num, den).collect()}
    assert got == brute_components(docs, k, num, den)


def test_jaccard_common_shingles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAST_COMMON", 3)
    monkeypatch.setattr(jaccard_join, "NOTED", 2)
    monkeypatch.setattr(work, "BROADCAST_IDS", 0)
    docs = near_docs()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(table(spark, docs), 3, 90, 100).collect()}
    assert got == brute_components(docs, 3, 90, 100)


@pytest.mark.parametrize("shared", [None, 5])
@pytest.mark.parametrize("rows,many", [(1 << 20, 100), (2, 2)])
def test_jaccard_shared_ids(spark, monkeypatch, shared, rows, many):
    """Texts of many rows without an id of their own are known by their sets: as many as sets, not as many as pairs."""
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", rows)
    monkeypatch.setattr(jaccard_join, "MANY_TILES", many)
    docs, moved = near_docs(), []
    dealt = jaccard_join._with_texts
    monkeypatch.setattr(jaccard_join, "_with_texts", lambda texts, marked, members: moved.append((out := dealt(texts, marked, members)).count() - members.count()) or out)
    same = [(shared if i % 3 else i + 10_000, t) for i, t in docs]
    got = jaccard_join.judged(table(spark, same), 5, 80, 100, "doc_id", "text").where("key IS NOT NULL").select("key", "comp", "n").distinct()
    want = jaccard_join.judged(table(spark, docs), 5, 80, 100, "doc_id", "text").where("key IS NOT NULL").select("key", "comp", "n").distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert moved and not any(moved)


@pytest.mark.parametrize("rows,grams,many", [(3, 1 << 20, 1), (1 << 20, 300, 100), (2, 50, 2)])
def test_jaccard_tiles(spark, monkeypatch, rows, grams, many):
    """Families of many small tiles, cut again by other blocks, give the same links."""
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", rows)
    monkeypatch.setattr(jaccard_join, "TILE_GRAMS", grams)
    monkeypatch.setattr(jaccard_join, "MANY_TILES", many)
    docs = near_docs()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(table(spark, docs), 3, 90, 100).collect()}
    assert got == brute_components(docs, 3, 90, 100)


def test_jaccard_families_of_chance(spark, monkeypatch):
    """Texts that share a passage, and with it whole blocks by chance, are no family."""
    rnd = random.Random(8)
    words = lambda n: " ".join(f"w{rnd.randrange(1 << 30)}" for _ in range(n))
    passages = [words(20) for _ in range(8)]
    docs = [(i, f"{words(60)} {passages[i % 8]} {words(60)}") for i in range(320)]
    docs += [(1000 + i, docs[i][1] + " end") for i in range(5)]
    held = []
    tiled = jaccard_join._tiled
    monkeypatch.setattr(jaccard_join, "_tiled", lambda members: held.append(members.count()) or tiled(members))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(table(spark, docs)).collect()}
    assert got == {i: i - 1000 * (i >= 1000) for i, _ in docs}
    assert held == [10]


@pytest.mark.parametrize("paired", [2, 16])
def test_jaccard_large_groups(spark, monkeypatch, paired):
    """Blocks that more rows have than give all their pairs lose no link."""
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    monkeypatch.setattr(jaccard_join, "BLOCKS", 1 << 10)
    docs = near_docs()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(table(spark, docs), 5, 80, 100).collect()}
    assert got == brute_components(docs, 5, 80, 100)


def test_sketches_never_differ_by_more_than_sets():
    rng = np.random.default_rng(1)
    some = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64))
    for n in [*range(1, 40), *range(50, 900, 17)]:
        x = some(n)
        y = np.unique(np.concatenate([x[rng.random(x.size) > 0.3 * rng.random()], some(n // 4 + 1)]))
        assert jaccard_join.apart(jaccard_join.sketch(x), jaccard_join.sketch(y)) <= np.setxor1d(x, y).size
        if n > 100:
            assert 180 * jaccard_join.apart(jaccard_join.sketch(x), jaccard_join.sketch(some(n))) > 20 * 2 * n
    many = np.arange(1, 2000, dtype=np.uint64) << np.uint64(32)  # all in one bin, which holds at most 255
    assert jaccard_join.apart(jaccard_join.sketch(many), jaccard_join.sketch(many[:1500])) <= 499


@pytest.mark.parametrize("sparse,cells", [(256, 1 << 22), (1, 1 << 22), (1 << 30, 1 << 22), (4, 200)])
def test_overlaps(monkeypatch, sparse, cells):
    """Sparse and dense column blocks, of any width, count the same."""
    monkeypatch.setattr(jaccard_join, "SPARSE", sparse)
    monkeypatch.setattr(jaccard_join, "CELLS", cells)
    sets = [x for _, t in near_docs() if (x := jaccard_join.shingle_set(t, 3)).size]
    sizes = jaccard_join.Sizes(90, 100)
    both = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if i != j and sizes.linked(x.size, y.size, np.intersect1d(x, y).size)}
    a, b = jaccard_join.overlaps(sets, sets, sizes)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(i, j) for i, j in both if i < j}
    half = len(sets) // 2
    a, b = jaccard_join.overlaps(sets[:half], sets[half:], sizes)
    assert set(zip(a.tolist(), (b + half).tolist(), strict=True)) == {(i, j) for i, j in both if i < half <= j}


def test_components(spark):
    rnd = random.Random(3)
    names = rnd.sample(range(-(1 << 60), 1 << 60), 400)
    links = list(zip(names[:200], names[1:200], strict=False)) + [(names[200], x) for x in names[201:300]] + [(x, y) for x, y in zip(names[300::2], names[301::2], strict=True)]
    got = {r["key"]: r["comp"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert len(got) == 400 and len({got[x] for x in names[:200]}) == len({got[x] for x in names[200:300]}) == 1
    assert len(set(got.values())) == 52
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_edges(spark):
    assert jaccard_join.jaccard_components(table(spark, [])).count() == 0
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (7, None)]
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(table(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (7, 7)], key=str)
    rows = [(4, "T t t t t t"), (4, "T t t t t t"), (5, "T t t t t t"), (None, "U u u u u u u"), (None, "T t t t t t"), (6, ""), (7, None), (8, "v"), (8, "w w w")]
    kept = jaccard_join.keep_one(table(spark, rows))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(4, "T t t t t t"), (None, "U u u u u u u"), (6, ""), (7, None), (8, "v"), (8, "w w w")], key=str)
    kept = jaccard_join.keep_one(table(spark, [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y z")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3] and kept.columns[1] == "text"


def brute_repeats(docs, length):
    raws = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[s : s + length] for _, b in raws for s in range(len(b) - length + 1))
    out = []
    for i, b in raws:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1]))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeat_docs():
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcdé \nxyz") for _ in range(n))
    base = [word(700) for _ in range(4)]
    docs = []
    for i in range(60):
        b, kind = rnd.choice(base), rnd.randint(0, 4)
        a = rnd.randint(0, 500)
        cut = b[a : a + rnd.randint(140, 300)]
        docs.append((i, [word(rnd.randint(0, 400)), word(90) + cut + word(90), b[:a] + "Q" + b[a + 1 :], b, word(50) + "ab" * rnd.randint(80, 150) + "z" * rnd.randint(100, 250)][kind]))
    return docs + [(900, None), (901, ""), (902, "q" * 149), (903, "r" * 150), (904, "s" * 151), (906, docs[0][1]), (906, docs[0][1]), (None, "t" * 160), (907, "uv" * 3000)]


@pytest.mark.parametrize("hot,ids", [(repeats.HOT, 1_000_000), (600, 0)])
def test_repeats(spark, monkeypatch, hot, ids):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "BROADCAST_IDS", ids)
    docs = repeat_docs()
    got = sorted((tuple(r) for r in repeats.remove_repeats(table(spark, docs), 150).collect()), key=str)
    assert got == brute_repeats(docs, 150)


def test_repeats_edges(spark):
    assert repeats.remove_repeats(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(table(spark, []), 101)


def test_repeats_cost(monkeypatch):
    """Near copies of one text: an interval over many rows costs no more than the runs of symbols that it meets."""
    rnd = np.random.default_rng(2)
    base, parts = rnd.integers(97, 123, 1000, np.uint8), []
    for _ in range(60):
        parts.append(base.copy())
        parts[-1][rnd.integers(1000)] = 33
    seen = Counter(p[i : i + 400].tobytes() for p in parts for i in range(601))
    assert np.sort(repeats.repeated_starts(parts, 400)).tolist() == [k * 1001 + i for k, p in enumerate(parts) for i in range(601) if seen[p[i : i + 400].tobytes()] > 1]
    text = np.concatenate([np.append(p.astype(np.int64) + 1, 0) for p in parts])
    order, spread = repeats.suffix_order(text, 400), []

    class Counted:
        def __getattr__(self, name):
            if name == "repeat":
                return lambda *given: spread.append(np.repeat(*given)) or spread[-1]
            return getattr(np, name)

    monkeypatch.setattr(repeats, "np", Counted())
    repeats.short_prefixes(text, order, 400)
    assert sum(x.size for x in spread) < text.size / 4


def test_segments_of_many_texts(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    rnd = np.random.default_rng(4)
    base = rnd.integers(97, 101, 900, np.uint8)
    texts = [base[a : a + n] for a, n in zip(rnd.integers(0, 600, 30).tolist(), rnd.integers(0, 400, 30).tolist(), strict=True)] + [np.tile(base, 3), base[:149], base[:150]]
    bounds = np.append(0, np.cumsum([t.size for t in texts]))
    of, hashes, places, first, last = repeats.segments(np.concatenate(texts), bounds, 150)
    starts = [(k, s) for k, a, z in zip(of.tolist(), first.tolist(), last.tolist(), strict=True) for s in range(a, z + 1)]
    assert starts == [(k, s) for k, t in enumerate(texts) for s in range(t.size - 149)]
    anchors = {}  # equal strings have one anchor, at one place
    for k, h, p, a, z in zip(of.tolist(), hashes.tolist(), places.tolist(), first.tolist(), last.tolist(), strict=True):
        for s in range(a, z + 1):
            anchors.setdefault(texts[k][s : s + 150].tobytes(), set()).add((h, p - s))
    assert all(len(x) == 1 for x in anchors.values())
    assert repeats.segments(np.empty(0, np.uint8), np.zeros(3, np.int64), 150)[0].size == 0
