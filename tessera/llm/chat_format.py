"""Chat formatting by prefix-target expansion.

Each assistant turn becomes an example of its own: all preceding turns as context and only that
reply trainable. Turns after the last reply come as one closing example without a target, so that
the output holds the whole conversation. The template is

    <turn>ROLE\\nTEXT</turn>\\n

in which ``\\`` and ``<`` of role and text are written ``\\b`` and ``\\l``, and a role's line ends ``\\n``: no text can then hold a
control string, and the writing is reversible. A null role or text counts as empty; turns with the
same number are ordered by role, then text; a null conversation is a conversation of its own;
repeated rows stay repeated turns; further columns are ignored; no rows give no rows.

All of it is DataFrame functions. A conversation's turns meet in one row, as does each example,
which holds them anyway; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def escaped_role(role: Column) -> Column:
    """A role stands on one line, so its line ends are escaped too."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def chat_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target_role: str = "assistant") -> DataFrame:
    """Rows (conv, target_turn, n_context, formatted, loss_start, loss_end, closes).

    ``loss_start`` and ``loss_end`` are code points of ``formatted``, end exclusive, equal where
    nothing is trainable. ``closes`` marks the example with all turns of the conversation.
    """
    body = F.concat(F.lit(OPEN), escaped_role(F.coalesce(turns[role], F.lit(""))), F.lit("\n"))
    reply = escaped(F.coalesce(turns[text], F.lit("")))
    one = turns.select(
        turns[conv].alias("conv"),
        F.struct(
            turns[turn].alias("turn"), F.coalesce(turns[role], F.lit("")).alias("role"), F.coalesce(turns[text], F.lit("")).alias("key"),
            F.concat(body, reply, F.lit(CLOSE)).alias("block"), F.length(body).alias("head"), F.length(reply).alias("long"),
        ).alias("t"),
    )
    whole = one.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    last = F.size("ts") - 1
    spread = whole.select("conv", "ts", F.posexplode("ts").alias("at", "t")).where((F.col("t.role") == target_role) | (F.col("at") == last))
    before = F.array_join(F.transform(F.slice("ts", F.lit(1), F.col("at")), lambda x: x["block"]), "")
    made = spread.select("conv", F.col("t.turn").alias("target_turn"), F.col("at"), (F.col("t.role") == target_role).alias("trains"), before.alias("before"), "t", (F.col("at") == last).alias("closes"))
    start = F.length("before") + F.col("t.head")
    return made.select(
        F.col("conv").alias(conv), "target_turn", F.col("at").cast("long").alias("n_context"), F.concat("before", "t.block").alias("formatted"),
        F.when(F.col("trains"), start).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("trains"), start + F.col("t.long")).otherwise(0).cast("long").alias("loss_end"), "closes",
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda x: x != "")
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescaped(F.replace(F.substring(F.substring_index(b, "\n", 1), len(OPEN) + 1, 1 << 30), F.lit("\\n"), F.lit("\n"))).alias("role"),
            unescaped(F.substring(b, F.locate("\n", b) + 1, F.length(b))).alias("text"),
        ),
    )
