"""The registered queries of this subpackage, and their SQL where DuckDB can state it.

Each query applies its operator with production parameters to the whole table and derives the
digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, chat_format, conversation_repair, exact_dedup, jaccard_join, mixing, pii, quality_rules, ranked_search, repeats, secret_scan, site_quality, token_counts
from tessera.llm.spans import joined


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def n_spans() -> Column:
    """All spans of a row, those that the method adds included."""
    return F.size(F.concat("base", "added")).cast("long").alias("n_spans")


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    made = chat_format.chat_examples(turns.unionByName(extra))
    read = chat_format.parsed(F.col("formatted"))
    reply = chat_format.unescaped(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    lines = F.when(F.col("closes"), F.transform(read, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    rows = made.select("conv_id", "n_context", lines.alias("lines"), reply.alias("reply"), F.length("formatted").alias("long"))
    replies = F.transform(F.array_sort(F.collect_list(F.struct("n_context", "reply"))), lambda x: x["reply"])
    by = rows.groupBy("conv_id").agg(F.max("lines").alias("lines"), F.array_join(replies, "").alias("loss"), F.sum("long").cast("long").alias("formatted_chars"))
    return by.select(
        "conv_id", F.size("lines").cast("long").alias("n_turns"), sha(F.array_join("lines", "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"), "formatted_chars",
    )


OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    6 + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), chr(10), '\n')) + 1 + length(replace(replace(text, '\', '\b'), '<', '\l')) + 8 AS long
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), run AS (
  SELECT *, sum(long) OVER (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY k)) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR k = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM run GROUP BY conv_id
"""


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = site_quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", F.round("evidence", 9).alias("evidence"), F.round("host_rate", 9).alias("host_rate"), F.round("path_rate", 9).alias("path_rate"), F.round("quality", 9).alias("quality"), "kept")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup_in_batches(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP5_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM rows WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    made = bpe.bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), sha(F.col("decoded")).alias("decoded_sha256")
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [count_of(k) for k in pii.KINDS[:4]]
    return found.select("doc_id", *counts, sha(joined(F.col("base"))).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"), n_spans())


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(table(spark, sf_dir, "documents"))
    counts = [count_of(k) for k in secret_scan.KINDS[:3]]
    return found.select("doc_id", *counts, sha(joined(F.col("base"))).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"), n_spans())


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    audits, repaired = conversation_repair.repair(conversation_repair.damaged(turns))
    hashes = conversation_repair.digests(repaired).select(F.col("id").alias("of"), F.col("sha256").alias("repaired_sha256"))
    rows = turns.select("conv_id").distinct().join(audits, F.col("conv_id").eqNullSafe(F.col("id")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", sha(F.lit(""))).alias("repaired_sha256"))


def _op11_sql() -> str:
    """A table of each conversation's suffixes, from its last row to its first: for each state of the
    roles the least ``cost:audit`` as text, and the repaired lines that go with it."""
    zero = lambda c: f"lpad(CAST({c} AS VARCHAR), 9, '0')"
    # state -> state after a row of user or assistant
    then = {"n": "u", "s": "u", "u": "a", "a": "u"}
    role = {"u": "user", "a": "assistant"}

    def edit(letter: str, cost: str, line: str, tail: str, when: str = "true") -> str:
        made = f"{{'v': {zero(f'CAST({tail}.v[1:9] AS BIGINT) + {cost}')} || ':{letter}' || {tail}.v[11:], 't': {line} || {tail}.t}}"
        return f"CASE WHEN {when} THEN {made} END"

    def inserted(name: str, of: str) -> str:
        one = then[name]
        two = then[one]
        empty = lambda s: f"'{role[s]}:' || chr(10)"
        first = edit("I", "5", empty(one), f"{of}{one}")
        second = edit("I", "5", empty(one), f"({edit('I', '5', empty(two), f'{of}{two}')})")
        return f"list_min([{of}{name}, {first}, {second}])"

    def row(name: str) -> str:
        goal = then[name]
        may, extra = "fault IN (0, 3)", "(CASE WHEN fault = 3 THEN 5 ELSE 0 END)"
        own = "role || ':' || text || chr(10)"
        ways = [
            edit("D", "2", "''", f"f{name}"),
            edit("R", f"1 + {extra}", f"'{role[goal]}:' || text || chr(10)", f"f{goal}", may),
            edit("K", extra, own, f"f{goal}", f"{may} AND left(role, 1) = '{goal}'"),
        ]
        if name == "n":
            ways.append(edit("K", extra, own, "fs", f"{may} AND left(role, 1) = 's'"))
        return f"list_min([{', '.join(ways)}]) AS g{name}"

    start = lambda v: f"{{'v': '{v}', 't': ''}}"
    none = start("900000000:")
    ends = f"{{'gn': {start('000000000:')}, 'gs': {none}, 'gu': {none}, 'ga': {start('000000000:')}}}"
    ended = ", ".join(f"{inserted(s, 'z.g')} AS f{s}" for s in then)
    return rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS chars FROM conversations
), coded AS (
  SELECT * EXCLUDE chars, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(chars, lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [CAST(0 AS BIGINT) for _ in range(8)]), lambda x, _: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))), CAST(4294967295 AS BIGINT)) % 20 AS code FROM raw
), damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE code <> 0
), ordered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS i FROM damaged
), judged AS MATERIALIZED (
  SELECT *, CASE WHEN seen = '' THEN 1 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 2 WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    CASE WHEN i > 1 AND lag(left(role, 1)) OVER w || left(role, 1) NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS odd, count(*) OVER (PARTITION BY c) AS n
  FROM ordered WINDOW w AS (PARTITION BY c ORDER BY i)
), suffix AS (
  SELECT c, n AS i, {ended} FROM (SELECT c, n, {ends} AS z FROM judged WHERE i = n) AS base
  UNION ALL
  SELECT c, i, {", ".join(f"{inserted(s, 'z.g')} AS f{s}" for s in then)} FROM (
    SELECT c, i - 1 AS i, {{'gn': gn, 'gs': gs, 'gu': gu, 'ga': ga}} AS z FROM (
      SELECT suffix.c, suffix.i, {", ".join(row(s) for s in then)} FROM suffix JOIN judged ON judged.c = suffix.c AND judged.i = suffix.i
    ) AS stepped
  ) AS moved
), solved AS (
  SELECT c, fn.v AS v, fn.t AS t FROM suffix WHERE i = 0
), counts AS (
  SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank,
    count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated, CAST(sum(odd) AS BIGINT) AS illegal FROM judged GROUP BY c
)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(v[1:9], '0') AS BIGINT) AS cost, coalesce(v[11:], '') AS audit,
  sha256(CASE WHEN coalesce(t, '') = '' THEN '' ELSE left(t, length(t) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids LEFT JOIN counts ON ids.conv_id IS NOT DISTINCT FROM counts.conv_id LEFT JOIN solved USING (c)
"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), items AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark
), asked AS (
  SELECT DISTINCT q, unnest(terms) AS term FROM items
), whole AS (
  SELECT count(*) AS nn, CAST(sum(len(terms)) AS BIGINT) AS ll FROM docs WHERE len(terms) > 0
), tf AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY d, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term
), scored AS (
  SELECT q, d, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(docs.terms) * nn) // ll)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN docs USING (d), whole GROUP BY q, d
), ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored JOIN docs USING (d) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (q) WHERE rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_chat_formatting, op3_ngram_jaccard, op4_quality_classifier, op5_exact_dedup, op6_bpe, op7_mixing, op8_suffix_array, op9_secret_scan, op10_quality_rules, op11_conversation_repair, op12_token_counts, op13_ranked_search)}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_formatting": OP2_SQL, "op5_exact_dedup": OP5_SQL, "op11_conversation_repair": _op11_sql(), "op13_ranked_search": OP13_SQL}
