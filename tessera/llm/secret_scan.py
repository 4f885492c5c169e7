"""Secret scan: fixed patterns, and character Markov models of random strings and identifiers.

First-order models are compared over every long token that no pattern's match overlaps. There are
two pairs of them, by the shape of a token: of letters of one case (a capital may begin it), which are
compared as small letters, and of all other characters. Random strings are learned from what the
fixed patterns matched and from labelled samples drawn from the shape's characters; ordinary ones from
labelled samples and, for the first shape, from the shorter words of the corpus (those of at most about
``WORD_TEXTS`` texts, picked by hash, a bounded sample), for the second from long tokens without a
digit. So a long word in capitals, or the part of one that an umlaut cuts off, is as ordinary as words are.

Counts are mixed with lower orders by fixed weights, whatever their number. A token whose
log-likelihood ratio, in all and for each character, passes the limits is reported as ``random``.
The limit for each character follows from ordinary strings of its shape held out of the training,
every fourth by hash: it lies ``SPREADS`` of their spreads, from the median to the upper quartile,
above their median, which a few per cent of secrets among them do not move.

Null counts as empty and has no spans. Rows are scanned one by one: a null id is kept and repeated
rows give repeated results. An empty table gives an empty result, and columns beyond those named
are ignored. DataFrame functions throughout; only the bigram tables (a few thousand numbers,
whatever the input) come to the driver.
"""

from __future__ import annotations

import base64
import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.spans import labelled, with_spans, without_overlaps
from tessera.llm.work import staged

KINDS = ("assign", "access", "hex", "random")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9+/_.=-]++"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Log-likelihood ratio that a token must reach, in all and for each character; the latter by shape, letters of one case or not.
LEAST_TOTAL, LEAST_MEAN = 12.0, {True: 0.3, False: 0.5}
#: Weights of pairs, of single characters and of an even draw in the models.
RANDOM_MIX, ORDINARY_MIX = (0.35, 0.15, 0.5), (0.6, 0.25, 0.15)
#: Held-out tokens: one in so many; and spreads from their median to the limit.
HELD_OUT, SPREADS = 4, 6.0
#: Texts whose words are learned as ordinary, about so many at most. Longer words than these are judged, so not learned.
WORD_TEXTS = 4_000
WORDS = "(?<![A-Za-z])[A-Za-z]{4,15}(?![A-Za-z])"
#: A token of letters of one case; other tokens are of the other shape.
ONE_CASE = "^(?:[A-Z]?[a-z]+|[A-Z]+)$"
#: Labelled samples of ordinary tokens; those of random ones are digests in base 64 and base 16.
ORDINARY = """user_account_settings getRequestHeader application/json src/main/resources/config release-notes-2024-01-15
getElementsByTagName max_connection_retries docs/user-guide/installation 2023-11-05-weekly-summary session_timeout_seconds
HttpServletRequest images/background/header_large customer_order_history createUserProfile integration-test-report
en_US/LC_MESSAGES/messages data/processed/2022/03/sales_by_region DEFAULT_BUFFER_SIZE parseConfigurationFile v2-api-migration-plan
organization_membership static/scripts/vendor/library convertToAbsolutePath MAXIMUM_RETRY_COUNT quarterly-report-2021-q3 index_of_last_element
internationalization misunderstandings responsibilities content-security-policy deployment-2020-12-31-final var/log/application/error
page=1/sort=descending/limit=100 calculate_average_score BackgroundTaskScheduler chapter-12-section-04 validateInputParameters
telecommunications user-interface-guidelines temperature_sensor_data_2019 https/www/example/articles/how-to-write-tests""".split()
RANDOM_LETTERS = ["".join(chr(97 + b % 26) for b in hashlib.sha512(bytes([i])).digest() if b < 234) for i in range(256)]
RANDOM = [base64.b64encode(hashlib.sha256(bytes([i])).digest()).decode().rstrip("=") if i % 4 else hashlib.sha256(bytes([i])).hexdigest() for i in range(64)]


def with_bases(docs: DataFrame, text: Column) -> DataFrame:
    """Add ``assign``, ``access``, ``hex`` (spans that pass) and ``tokens``."""
    low = F.lower(text)
    keyed = F.lit(False)
    for word in KEYWORDS:
        keyed = keyed | F.contains(low, F.lit(word))
    df = with_spans(docs, "assign", text, ASSIGN, keyed)
    value = lambda s: F.regexp_extract(s["value"], r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$", 1)
    df = df.withColumn("assign", F.filter("assign", lambda s: F.length(value(s)) >= 12))
    df = with_spans(df, "access", text, ACCESS, F.contains(text, F.lit("AKIA")))
    df = with_spans(df, "hex", text, HEX, F.rlike(text, F.lit("[0-9a-f]{16}")))
    return with_spans(df, "tokens", text, TOKEN, F.lit(True))


def codes(token: Column) -> Column:
    """Places of a token's characters in the alphabet, from 1; 0 for others."""
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def bigrams(cs: Column) -> Column:
    """Each character's cell in the table, given the one before it."""
    return F.zip_with(F.slice(cs, 1, F.size(cs) - 1), F.slice(cs, 2, F.size(cs)), lambda a, b: a * (len(ALPHABET) + 1) + b)


def train(samples: DataFrame) -> dict[bool, tuple[list[float], list[float]]]:
    """For each shape (True for letters of one case) the log-probabilities of the next character by
    bigram, of random and of ordinary strings, from rows (value, is_random)."""
    n = len(ALPHABET) + 1
    spark = samples.sparkSession
    own = spark.createDataFrame([(x, False) for x in ORDINARY] + [(x, True) for x in RANDOM + RANDOM_LETTERS], "value string, is_random boolean")
    shaped = samples.select("value", "is_random").unionByName(own).select(one_case(F.col("value")).alias("one_case"), folded(F.col("value")).alias("value"), "is_random")
    parts = own.where("NOT is_random").select(F.lit(True).alias("one_case"), F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{2,}"), F.lit(0))).alias("value"), "is_random")
    cells = shaped.unionByName(parts).select("one_case", "is_random", F.explode(bigrams(codes(F.col("value")))).alias("cell")).groupBy("one_case", "is_random", "cell").count()
    counts = {(shape, kind): [0.0] * (n * n) for shape in (True, False) for kind in (True, False)}
    for r in cells.collect():  # bounded by the alphabet: 4 * n * n rows
        counts[r["one_case"], r["is_random"]][r["cell"]] = float(r["count"])

    def logs(c: list[float], mix: tuple[float, float, float], size: int) -> list[float]:
        single = [sum(c[b::n]) / sum(c) for b in range(n)]
        out = []
        for a in range(n):
            row = c[a * n : a * n + n]
            total = sum(row)
            out += [math.log(mix[0] * (x / total if total else p) + mix[1] * p + mix[2] / size) for x, p in zip(row, single, strict=True)]
        return out

    return {shape: (logs(counts[shape, True], RANDOM_MIX, size), logs(counts[shape, False], ORDINARY_MIX, size)) for shape, size in ((True, 26), (False, n))}


def one_case(token: Column) -> Column:
    return F.rlike(token, F.lit(ONE_CASE))


def folded(token: Column) -> Column:
    return F.when(one_case(token), F.lower(token)).otherwise(token)


def ratio(token: Column, tables: dict[bool, tuple[list[float], list[float]]]) -> Column:
    """The log-likelihood ratio of a token, random to ordinary, by the models of its shape.

    One walk over its bigrams: a cell's two logarithms are subtracted beforehand."""

    def summed(shape: bool) -> Column:
        steps = [a - b for a, b in zip(*tables[shape], strict=True)]
        weights = F.split(F.lit(",".join(map(repr, steps))), ",").cast("array<double>")
        return F.aggregate(bigrams(codes(folded(token))), F.lit(0.0), lambda a, cell: a + F.get(weights, cell))

    return F.when(one_case(token), summed(True)).otherwise(summed(False))


def words(docs: DataFrame, text_col: str, n: int) -> DataFrame:
    """Rows (value): the words of about ``WORD_TEXTS`` of ``n`` texts, those whose hashes are lowest."""
    most = math.ceil(min(1.0, WORD_TEXTS / max(1, n)) * (1 << 40))
    some = docs.where(F.pmod(F.xxhash64(docs[text_col]), F.lit(1 << 40)) < most)
    return some.select(F.explode(F.regexp_extract_all(docs[text_col], F.lit(WORDS), F.lit(0))).alias("value")).where(one_case(F.col("value"))).select(F.lower("value").alias("value"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, added): spans of the patterns, and those that the models add."""
    df = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    df = with_bases(df, F.col("text"))
    kinds = [labelled(F.col(k), k, i) for i, k in enumerate(KINDS[:3])]
    df = df.withColumn("base", F.array_sort(F.concat(*kinds)))
    known = F.concat(*[F.transform(k, lambda s: s["value"]) for k in ("access", "hex")], F.transform("assign", lambda s: F.regexp_extract(s["value"], r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$", 1)))
    df = without_overlaps(df.withColumn("known", known), "tokens", "base")
    rows = staged(df.select("id", "base", "known", "tokens"), "secrets")

    held_out = lambda value: F.pmod(F.xxhash64(value), F.lit(HELD_OUT)) == 0
    longs = rows.select(F.explode("tokens").alias("t")).select(F.col("t.value").alias("value")).where(~F.rlike("value", F.lit("[0-9]")))
    learned = longs.where(~one_case(F.col("value")) & ~held_out("value")).unionByName(words(docs, text_col, rows.count())).withColumn("is_random", F.lit(False))
    randoms = rows.select(F.explode("known").alias("value")).withColumn("is_random", F.lit(True))
    tables = train(learned.unionByName(randoms))
    mean = ratio(F.col("value"), tables) / F.length("value")
    spread = F.percentile_approx(mean, F.array(F.lit(0.5), F.lit(0.75)), F.lit(10_000)).alias("q")
    quartiles = {r["shape"]: r["q"] for r in longs.where(held_out("value")).distinct().groupBy(one_case(F.col("value")).alias("shape")).agg(spread).collect()}
    least = {shape: max(LEAST_MEAN[shape], q[0] + SPREADS * (q[1] - q[0]) / 0.6745) for shape in (True, False) for q in [quartiles.get(shape, (0.0, 0.0))]}
    scored = F.transform("tokens", lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"), ratio(t["value"], tables).alias("llr"), F.when(one_case(t["value"]), least[True]).otherwise(least[False]).alias("least")))
    picked = F.filter(scored, lambda t: (t["llr"] >= LEAST_TOTAL) & (t["llr"] > t["least"] * (t["stop"] - t["start"])))
    return rows.select(F.col("id").alias(id_col), "base", labelled(picked, "random", 3).alias("added"))
