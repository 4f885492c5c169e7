"""Personal data: fixed patterns, and identifiers that share their contexts.

Bootstrapped extraction. Seeds are what the fixed patterns match. Each seed, and each other token
with a digit or an ``@``, is an instance, and the word before it, the word after it and both together
are lexical patterns. Over the graph of patterns and instances two scores take turns, by kind: a pattern's is
the share of its occurrences at instances of the kind, discounted for few occurrences; an
instance's is the noisy-or of its patterns. Instances that score high enough act as seeds in the
next round, until a round finds no new ones. Identifiers of letters alone are no instances. Tokens that good patterns surround and that no match overlaps are reported under the
kind ``learned``.

Null counts as empty and has no spans. Rows are scanned one by one: a null id is kept and repeated
rows give repeated results; they count as occurrences. An empty table gives an empty result, and
columns beyond those named are ignored. DataFrame functions throughout; nothing comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.spans import labelled, with_spans, without_overlaps
from tessera.llm.work import staged

KINDS = ("email", "ip", "card", "phone", "learned")
#: Stands for a separator inside an address or number, so that repetition is over one class of
#: characters; a control character that texts hold themselves is set aside first.
MARK = "\u0001"
EMAIL = rf"(?:\G|(?<![A-Za-z0-9._%+{MARK}-]))[A-Za-z0-9._%+{MARK}-]++@[A-Za-z0-9-]++{MARK}[A-Za-z0-9{MARK}-]++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:[.][0-9]++){3}"
CARD = rf"(?:\G|(?<![0-9{MARK}]))[0-9][0-9{MARK}]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![^\x20\x09-\x0D])[^0-9@\x20\x09-\x0D]*+[0-9@][^\x20\x09-\x0D]*+"

#: Occurrences that a pattern's score is discounted by; scores that let an instance act as a seed,
#: a pattern report an occurrence, and an instance be reported.
DISCOUNT, SEED_SCORE, PATTERN_SCORE, REPORT_SCORE = 4.0, 0.8, 0.6, 0.8
#: Distinct seeds of the kind that a pattern must have had.
LEAST_SEEDS = 5
#: Characters of the longest word that stands for itself; longer ones are known by a hash of all of it.
WORD_CHARS = 48


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    flipped = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(flipped, lambda c, i: (c.cast("int") * (1 + i % 2)).cast("int"))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def with_bases(docs: DataFrame, text: str) -> DataFrame:
    """Add the spans of each base kind that pass, and ``tokens`` with their surroundings."""
    t = F.translate(text, MARK, "\n")
    digit = F.rlike(text, F.lit("[0-9]"))
    at = F.contains(F.col(text), F.lit("@"))
    df = docs.withColumn("_digit", digit).withColumn("_at", at)
    df = df.withColumn("_mail", F.when(F.col("_at"), F.regexp_replace(t, r"(?<=[A-Za-z0-9-])[.](?=[A-Za-z0-9-])", MARK)))
    df = df.withColumn("_nums", F.when(F.col("_digit"), F.regexp_replace(t, r"(?<=[0-9])[\x20-](?=[0-9])", MARK)))
    df = with_spans(df, "email", F.col("_mail"), EMAIL, F.col("_at"), True)
    df = with_spans(df, "ip", F.col(text), IP, F.rlike(text, F.lit("[0-9][.][0-9]")), True)
    df = with_spans(df, "card", F.col("_nums"), CARD, F.col("_digit"), True)
    df = with_spans(df, "phone", F.col(text), PHONE, F.contains(F.col(text), F.lit("+")), True)
    df = with_spans(df, "tokens", F.col(text), TOKEN, F.col("_digit") | F.col("_at"), True)
    only = lambda s: F.regexp_replace(s["value"], "[^0-9]", "")
    small = lambda s: F.forall(F.split(s["value"], "[.]"), lambda x: x.cast("double") <= 255)
    df = df.withColumn("ip", F.filter("ip", small))
    df = df.withColumn("card", F.filter("card", lambda s: F.when(F.length(only(s)).between(12, 19), luhn(only(s))).otherwise(F.lit(False))))
    return df.withColumn("phone", F.filter("phone", lambda s: F.length(only(s)).between(9, 15))).drop("_digit", "_at", "_mail", "_nums")


def key(word: Column) -> Column:
    """What identifies a word, in lower case."""
    low = F.lower(word)
    return F.when(F.length(low) <= WORD_CHARS, low).otherwise(F.concat(F.lit("# "), F.sha2(low, 256)))


def contexts(before: Column, after: Column) -> Column:
    """The lexical patterns around an instance: the word before it, the word after it, and both."""
    tidy = lambda w: key(F.regexp_replace(w, r"(?<![^\p{L}\p{N}])[^\p{L}\p{N}]++\z|^[^\p{L}\p{N}]++", ""))
    both = F.when((tidy(before) != "") & (tidy(after) != ""), F.concat(F.lit("both "), tidy(before), F.lit(" "), tidy(after))).otherwise("")
    return F.filter(F.array(F.concat(F.lit("before "), tidy(before)), F.concat(F.lit("after "), tidy(after)), both), lambda p: ~p.isin("before ", "after ", ""))


def score(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (pattern, kind, score, seeds) and (instance, kind, score) after all rounds.

    ``edges``: rows (pattern, instance, kind or null, n) with n occurrences.
    """
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = edges.where("kind IS NOT NULL").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    plain = edges.where("kind IS NULL").select("pattern", "instance", "n")
    every = edges.groupBy("pattern", "instance").agg(F.sum("n").alias("n"))
    known = staged(seeds, "seeds")
    while True:
        hits = every.join(known, "instance").groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("hits"), F.count(F.lit(1)).alias("seeds"))
        patterns = hits.join(totals, "pattern").select("pattern", "kind", (F.col("hits") / (F.col("total") + DISCOUNT)).alias("score"), "seeds")
        patterns = staged(patterns.where(F.col("seeds") >= LEAST_SEEDS), "patterns")
        doubt = F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.99))))
        scored = plain.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        fresh = staged(scored.where(F.col("score") >= SEED_SCORE).join(known.select("instance").distinct(), "instance", "left_anti"), "fresh")
        if fresh.isEmpty():
            return patterns, known
        known = staged(known.unionByName(fresh), "known")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, added): spans of the patterns, and those learned from contexts."""
    df = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    df = with_bases(df, "text")
    df = df.withColumn("base", F.array_sort(F.concat(*[labelled(F.col(k), k, i) for i, k in enumerate(KINDS[:4])])))
    df = without_overlaps(df, "tokens", "base")
    seen = lambda s, kind: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), key(s["value"]).alias("instance"), kind.cast("string").alias("kind"), contexts(s["before"], s["after"]).alias("patterns"))
    of_kind = lambda spans, kind: F.transform(spans, lambda s: seen(s, F.lit(kind)))
    places = F.concat(*[of_kind(F.col(k), k) for k in KINDS[:4]], of_kind(F.col("tokens"), None))
    rows = staged(df.select("id", F.monotonically_increasing_id().alias("row"), "base", places.alias("places")), "pii")

    spread = rows.select("row", F.explode("places").alias("p")).select("row", "p.*")
    edges = spread.select(F.explode("patterns").alias("pattern"), "instance", "kind").groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).alias("n"))
    patterns, known = score(staged(edges, "edges"))
    good = patterns.where(F.col("score") >= PATTERN_SCORE).select("pattern", "kind")
    likely = known.where(F.col("score") >= REPORT_SCORE).select("instance", "kind")
    plain = spread.where("kind IS NULL").select("row", "start", "stop", "instance", F.explode("patterns").alias("pattern"))
    hits = plain.join(good, "pattern").join(likely, ["instance", "kind"]).select("row", "start", "stop").distinct()
    by = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", F.lit(4).alias("order"), F.lit(KINDS[4]).alias("kind"), "stop"))).alias("found"))
    none = F.array().cast("array<struct<start:int,order:int,kind:string,stop:int>>")
    return rows.select("id", "row", "base").join(by, "row", "left").select(F.col("id").alias(id_col), "base", F.coalesce("found", none).alias("added"))
