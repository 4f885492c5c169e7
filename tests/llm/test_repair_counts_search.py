"""Conversation repair, token counts and ranked search, against plain computations."""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import conversation_repair, queries, ranked_search, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
BLANK = " \t\n\x0b\x0c\r"
THEN = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain_repair(rows, insert=5):
    """(cost, audit, lines) of (role, text, fault) rows, from the end, over tuples."""
    role = {"u": "user", "a": "assistant"}
    best = {"": (0, "", []), "a": (0, "", [])}

    def with_inserts(best):
        for _ in range(2):
            new = dict(best)
            for state, goal in THEN.items():
                if goal in best:
                    cost, audit, lines = best[goal]
                    new[state] = min(new.get(state, (math.inf,)), (cost + insert, "I" + audit, [role[goal] + ":", *lines]))
            best = new
        return best

    best = with_inserts(best)
    for name, text, fault in reversed(rows):
        new = {}
        for state, goal in THEN.items():
            ways = []
            if state in best:
                ways.append((best[state][0] + 2, "D" + best[state][1], best[state][2]))
            extra = 5 if fault == "truncated" else 0
            if fault in (None, "truncated"):
                if goal in best:
                    c, audit, lines = best[goal]
                    ways.append((c + 1 + extra, "R" + audit, [f"{role[goal]}:{text}", *lines]))
                    if name[:1] == goal:
                        ways.append((c + extra, "K" + audit, [f"{name}:{text}", *lines]))
                if name[:1] == "s" and state == "" and "s" in best:
                    c, audit, lines = best["s"]
                    ways.append((c + extra, "K" + audit, [f"{name}:{text}", *lines]))
            if ways:
                new[state] = min(ways)
        best = with_inserts(new)
    return best[""]


def plain_conversations(turns):
    """The contract's rows from (conv_id, turn, role, text), by conversation."""
    out = {}
    for conv in {t[0] for t in turns}:
        rows = []
        for c, turn, role, text in turns:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            rows += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
        order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest())
        rows.sort(key=order)
        seen, judged = set(), []
        for turn, role, text in rows:
            said = text.rstrip(BLANK)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else None if said[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, lines = plain_repair(judged)
        turns_left = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        out[conv] = {
            "gaps": max(turns_left) - min(turns_left) + 1 - len(set(turns_left)) if turns_left else 0,
            **{k: sum(j[2] == k for j in judged) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        }
    return out


def odd_turns():
    rnd = random.Random(3)
    texts = ["Yes.", "No!", "cut off", "", "  \n", None, "Why?  ", "One. Two", "x. "]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    turns = [(c, t, rnd.choice(roles[:3] * 4 + roles), rnd.choice(texts)) for c in range(120) for t in range(rnd.randint(1, 9))]
    turns += [(7, 3, "user", "Yes."), (7, 3, "user", "Yes."), (None, 0, "user", "Hm."), (None, None, "assistant", "Ha."), (500, None, None, None), (500, 9, "system", "S.")]
    turns += [(900, t, ["user", "assistant"][(t + t // 97) % 2], f"{t % 700}{'.' if t % 11 else ''}") for t in range(1800)]
    dropped = next(i for i in range(1000, 9000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return turns + [(dropped, 0, "user", "Gone.")], dropped


def conversations(spark, turns, tmp_path):
    extra = [(*t, 1, "x", 2) for t in turns]
    spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, row int, key string, cost int").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return queries.op11_conversation_repair(spark, str(tmp_path))


def test_repair(spark, tmp_path):
    turns, dropped = odd_turns()
    want = plain_conversations(turns)
    got = conversations(spark, turns, tmp_path).collect()
    assert len(got) == len(want)
    for r in got:
        assert {k: r[k] for k in want[r["conv_id"]]} == want[r["conv_id"]]
    by = {r["conv_id"]: r for r in got}
    assert by[dropped]["audit"] == "" and by[dropped]["cost"] == 0 and by[dropped]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert len(by[900]["audit"]) > 1 << conversation_repair.BLOCK_BITS  # several blocks


def test_repair_of_nothing(spark, tmp_path):
    assert conversations(spark, [], tmp_path).count() == 0


@pytest.mark.parametrize("insert", [1, 2, 3])
def test_audits_with_cheap_insertions(insert):
    """Where insertions pay, ways of equal cost differ in length; blocks of any size give the same."""
    rnd = random.Random(insert)
    costs = conversation_repair.Costs(insert=insert)
    codes = {None: "0", "blank": "1", "duplicate": "2", "truncated": "3"}
    for _ in range(300):
        rows = [(rnd.choice(["user", "assistant", "system", "tool"]), "t", rnd.choice([None, None, None, "blank", "truncated"])) for _ in range(rnd.randint(1, 12))]
        initials, faults = "".join(r[0][0] for r in rows), "".join(codes[r[2]] for r in rows)
        want = plain_repair(rows, insert)
        size = rnd.randint(1, 12)
        parts = [initials[i : i + size] for i in range(0, len(rows), size)]
        entries = [conversation_repair.block_entries(p, faults[i * size : i * size + len(p)], costs) for i, p in enumerate(parts)]
        cost, audit = conversation_repair.audit(entries, costs)
        assert (cost, audit) == want[:2]
        left = []
        for i, (state, letters) in enumerate(conversation_repair.pieces(audit, parts)):
            left += [(row, place, f"{role or rows[row][0]}:{'t' if own else ''}") for row, place, role, own in conversation_repair.edits(letters, parts[i], i * size, state)]
        assert [x[2] for x in left] == want[2] and left == sorted(left, key=lambda x: x[:2])


DOCS = "doc_id long, text string, id string, term int, n_tokens int, salt int"


def docs_table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], DOCS)


def odd_texts():
    rnd = random.Random(5)
    parts = ["a", "Über", "'s", "'LL", " ", "\n", "<|endoftext|>", "<|startoftext|>", "<|END", "é", "é", "ΑΣ", "Σ", "İ", "1", "23", "...", " ", "\x85", "\x1c", "中", "😀", "endoftext|>", "hello", "ﬁ", "\x00"]
    return [None, "", " \n", "a" * 30000, "<|endoftext|>" * 3, *("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(400))]


def test_token_counts(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = odd_texts()
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 2
    got = token_counts.token_counts(docs_table(spark, rows), WORDS, limit=20).collect()
    want = [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 20) for i, t in rows]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_counts.token_counts(docs_table(spark, []), WORDS).count() == 0


def test_token_counts_of_the_table(spark, sf_dir):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in queries.op12_token_counts(spark, sf_dir).collect()}
    assert got == {i: (len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in texts.items()}


def plain_search(docs, items, k):
    find = functools.partial(re.findall, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    found = [(i, [t.translate(lower) for t in find(text or "")]) for i, text in docs]
    n_docs, n_terms = sum(bool(ts) for _, ts in found), sum(len(ts) for _, ts in found)
    out = []
    for item, text in items:
        scores = [[i, 0] for i, _ in docs]
        for term in {t.translate(lower) for t in find(text or "")}:
            tfs = [ts.count(term) for _, ts in found]
            if df := sum(tf > 0 for tf in tfs):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                for s, (_, ts), tf in zip(scores, found, tfs, strict=True):
                    m = 50 + 50 * len(ts) * n_docs // n_terms
                    s[1] += w * (1_000_000_000 * tf // (1000 * tf + 20 * m))
        best = sorted((s for s in scores if s[1] > 0), key=lambda s: (-s[1], s[0] is not None, s[0]))[:k]
        out += [(item, rank, i, s) for rank, (i, s) in enumerate(best, 1)]
    return sorted(out, key=str)


def search_case(rnd, n):
    words = [*"abcdefghij", "Über", "ÜBER", "x1", "Zoo", "zoo", "q-r", "né", "\x00", "Σ", "ς"]
    docs = [(i % 170 if i % 40 else None, None if i % 61 == 0 else "" if i % 67 == 0 else rnd.choice([" ", "-", "_"]).join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 9, 200])))) for i in range(n)]
    docs += [(300 + i % 3, "a zoo of ties") for i in range(90)]
    items = [(i % 9 if i % 7 else None, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 25)))) for i in range(12)] + [(20, None), (21, "--"), (22, "nowhere"), (0, "a zoo of ties")]
    return docs, items


@pytest.mark.parametrize("first, items_in_block", [(1, 4096), (60, 3), (1 << 14, 4096)])
def test_ranked_search(spark, monkeypatch, first, items_in_block):
    monkeypatch.setattr(ranked_search, "FIRST", first)
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", items_in_block)
    docs, items = search_case(random.Random(first), 300)
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(1))
    for k in (1, 7, 500):
        got = ranked_search.ranked_search(docs_table(spark, docs), table, k=k).collect()
        assert sorted(map(tuple, got), key=str) == plain_search(docs, items, k)


def test_ranked_search_of_nothing(spark):
    docs, items = docs_table(spark, [(1, "a b")]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    none = [(docs.limit(0), items), (docs, items.limit(0)), (docs_table(spark, [(1, None), (2, "--")]), items)]
    assert [ranked_search.ranked_search(d, i).collect() for d, i in none] == [[], [], []]
    assert ranked_search.ranked_search(docs, items).schema == ranked_search.ranked_search(docs.limit(0), items).schema
