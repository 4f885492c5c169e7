"""The PII and secret scans against regular expressions of Python, and what they learn."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest

from tessera.llm import pii, secret_scan

DOCS = "doc_id long, text string, kind string, start string"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]
SECRETS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 12),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 16),
]
PIECES = ["a", "b", "@", ".", "1", "2", "23", "255", " ", "-", "+1 ", "(55)", "ab.c", "a@b.co", "\x01", "4111 1111 1111 1111", "4111-1111-1111-1111", "10.0.0.1", "token", "=", '"', "secret: ", "AKIA", "ABCD1234", "abcdef0123456789", "é", "😀", "_", "API_KEY", "xY9zQ1kL0pWm", "\n", "ſ"]


def expected(text, kinds):
    return sorted((m.start(), o, k, m.end()) for o, (k, p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m))


@pytest.mark.parametrize("scan,kinds", [(pii.find_pii, PII), (secret_scan.secret_scan, SECRETS)])
def test_base_spans(spark, scan, kinds):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 50))) for _ in range(400)]
    texts += [None, "", "a@b.cd " * 3000, "1 " * 20000, "a@" + "b." * 20000, "f" * 50000, "token=secret:abcdefghijklmnop"]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "10.0.0.1", None, None), (0, texts[0], "x", "y")]
    got = scan(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in got}
    for i, t, *_ in rows:
        assert by_id[i] == [(a, o, k, b) for a, o, k, b in expected(t, kinds)], (i, t)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert pii.find_pii(none).count() == 0 and secret_scan.secret_scan(none).count() == 0


def test_contexts_find_identifiers_that_no_pattern_matches(spark):
    rows = [(i, f"please write to person{i}@mail.example.com whenever", "", "") for i in range(60)]
    rows += [(100 + i, f"please write to user{i}#corp7 whenever", "", "") for i in range(3)]
    rows += [(200 + i, f"chapter {i} of volume{i} begins", "", "") for i in range(60)]
    got = {r["doc_id"]: [s["kind"] for s in r["added"]] for r in pii.find_pii(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[100 + i] == ["learned"] for i in range(3))
    assert not any(v for k, v in got.items() if k < 100 or k >= 200)


def test_long_words_are_told_apart_by_all_their_characters(spark):
    long = "a-name-of-which-the-first-forty-eight-characters-are-the-same-"
    rows = [(i, f"please write to {long}{i}@mail.example.com {' ' * 80}whenever", "", "") for i in range(60)]
    rows += [(100 + i, f"please write to user{i}#corp7 whenever", "", "") for i in range(3)]
    rows += [(200 + i, f"say {long}x or {long}{i} to {'.' * 50_000}", "", "") for i in range(3)]
    got = {r["doc_id"]: [s["kind"] for s in r["added"]] for r in pii.find_pii(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[100 + i] == ["learned"] for i in range(3))
    assert not any(v for k, v in got.items() if k < 100 or k >= 200)


def test_markov_models_tell_random_strings_from_identifiers(spark):
    rnd = random.Random(9)
    rand = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    parts = ["user", "account", "value", "process", "handler", "request", "stream", "reader", "config", "manager"]
    word = lambda n: "".join(rnd.choice(parts) for _ in range(n))
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = [(i, f'api_key = "{rand(32)}" {word(4)} {word(5)} {word(6)} {"_".join(rnd.choice(parts) for _ in range(4))}', "", "") for i in range(300)]
    rows += [(1000 + i, f"bearer {rand(32)} end", "", "") for i in range(100)]
    rows += [(2000 + i, f"call {'_'.join(rnd.choice(parts) for _ in range(5))} end", "", "") for i in range(100)]
    rows += [(3000 + i, f"key {letters(32)} end", "", "") for i in range(100)]
    rows += [(4000 + i, f"see {rnd.choice(parts)}/{rnd.choice(parts)}-{rnd.randint(2015, 2025)}-{rnd.randint(10, 12)}-{rnd.randint(10, 28)} end", "", "") for i in range(100)]
    got = {r["doc_id"]: bool(r["added"]) for r in secret_scan.secret_scan(spark.createDataFrame(rows, DOCS)).collect()}
    caught = [sum(got[1000 * k + i] for i in range(100)) for k in (1, 2, 3, 4)]
    assert caught[0] >= 90 and caught[1] <= 2 and caught[2] >= 60 and caught[3] <= 5, caught
    assert not any(got[i] for i in range(300))


def test_markov_models_without_samples_in_the_table(spark):
    rows = [(1, "bearer q8Zt0LxV3nB7yKd2WmR5cHf9 end", "", ""), (2, "the internationalization_of_documents end", "", ""), (3, "short", "", "")]
    got = {r["doc_id"]: [s["kind"] for s in r["added"]] for r in secret_scan.secret_scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: ["random"], 2: [], 3: []}


def test_held_out_secrets_and_words_of_the_table(spark, sf_dir):
    """Every fifth secret that a fixed pattern finds stands bare, in capitals if it is hexadecimal, so
    that only the models can find it; and every word of the table stands in capitals."""
    docs = spark.read.parquet(f"{Path(sf_dir).parent}/sf0.01/documents.parquet").select("doc_id", "text").where("text is not null")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    secrets = {m[m.lastindex or 0] for t in texts.values() for _, p, ok in SECRETS for m in re.finditer(p, t) if ok(m)}
    bare = sorted(x for x in secrets if 16 <= len(x) and "." not in x and not x.isdigit())[::5]
    bare = [x.upper() if re.fullmatch("[0-9a-f]+", x) else x for x in bare]
    words = sorted({w.upper() for t in texts.values() for w in re.findall("[A-Za-z]{16,}", t)} - {x.upper() for x in secrets})
    rows = [(i, t, "", "") for i, t in texts.items()]
    rows += [(10**6 + i, f"the value {x} is", "", "") for i, x in enumerate(bare)] + [(10**7 + i, f"the value {x} is", "", "") for i, x in enumerate(words)]
    got = {r["doc_id"]: bool(r["added"]) for r in secret_scan.secret_scan(spark.createDataFrame(rows, DOCS)).collect()}
    caught = sum(got[10**6 + i] for i in range(len(bare)))
    wrong = sum(got[10**7 + i] for i in range(len(words))) + sum(got[i] for i in texts)
    assert bare and caught >= 0.9 * len(bare), (caught, len(bare), bare[:5])
    assert words and not wrong, (wrong, len(words))
