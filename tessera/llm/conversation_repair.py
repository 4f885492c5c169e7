"""Repair of the structure of conversations: the cheapest edits that give ``(s?(ua)+)?`` as role initials.

A row is kept, given the other of the roles user and assistant, or deleted; rows with empty text are
inserted. Edits have costs, and of equally cheap edits those whose initials (D, I, K, R) come first in
ASCII win. One integer says both: its high digits are the cost, below stands a fixed width of base-8
digits, the first edit's letter highest, and zeros where there are no more edits. The way through the
graph (row, role expected next, edits so far) with the least sum is found by an ordinary minimum of
integers at each node.

Rows are sorted over the whole table by ranges, so a conversation may span any number of tasks, and
cut into blocks of at most ``BLOCK`` rows. A block's least sums between each two states of the
automaton come from its own rows alone; a conversation's blocks are then the edges of the same graph,
which hold a letter for a row. Texts are read by nothing in between: edits go back to their rows by
row number. Only a conversation's audit, which is one value of the result, is put together in one place.

Rows come in the order of their turns, null first, then of role and of the SHA-256 of role and text,
so repeated rows are neighbours. Null roles and texts are one space, and so are null ids and turns in
the damaged key; a null id is an id. Empty tables give empty ones; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.work import SPACE, staged

#: Bits of a row number below those that number blocks: a block has at most 512 rows.
BLOCK_BITS = 9
#: Letters of edits, as digits from 1.
LETTERS = "DIKR"
_DELETE, _INSERT, _KEEP, _RENAME = range(1, 5)
#: States of the automaton (nothing yet, after system, user, assistant) and where a user or assistant row leads.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_NONE: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_INITIAL = {_USER: "u", _ASSISTANT: "a"}
#: Adjacent initials that may be.
LEGAL = ("su", "ua", "au")
FAULTS = ("blank", "duplicate", "truncated")

Entry = tuple[int, int, int, str]  # state before, state after, cost, letters


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rename: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if self.insert < 1 or min(self.keep, self.rename, self.delete, self.truncated) < 0:
            raise ValueError("inserting has to cost something, and nothing less than 0")


def damaged(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (id, turn, role, text), damaged by the CRC-32 of ``id:turn`` modulo 20: 0 drops a row,
    1 empties its text, 2 takes its sentence ends, 3 doubles it, 4 makes its role user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(turns[id_col].cast("string"), space), F.lit(":"), F.coalesce(turns[turn_col].cast("string"), space))
    rows = turns.select(
        turns[id_col].alias("id"), turns[turn_col].alias("turn"), F.coalesce(turns[role_col], space).alias("role"), F.coalesce(turns[text_col], space).alias("text"), (F.crc32(key) % 20).alias("code")
    ).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    doubled = rows.select("id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return doubled.drop("copy")


def numbered(turns: DataFrame) -> DataFrame:
    """Rows (id, turn, role, text, key, row), staged in order: ``row`` grows along each conversation
    and has no holes within a block."""
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    order = ["id", "turn", "role", "key"]
    rows = turns.withColumn("key", key)
    return staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id()), "turns")


def fault(first: Column) -> Column:
    """A row's first fault as its place in ``FAULTS`` from 1, else 0; ``first`` says that none before is equal."""
    seen = F.rtrim("text", F.lit(SPACE))
    return F.when(seen == "", 1).when(~first, 2).when(~F.right(seen, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)


def blocks(rows: DataFrame) -> DataFrame:
    """Rows (id, start, initials, faults) for each conversation and block: a character for each row.

    First rows among equal ones are known by row number, so a much repeated row is summed, not gathered.
    """
    firsts = rows.groupBy("id", "key").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    marks = rows.select("id", "row", F.rpad(F.substring("role", 1, 1), 1, " ").alias("initial"), fault(F.lit(True)).alias("own"))
    joined = marks.hint("merge").join(firsts.hint("merge"), "row", "left")
    found = F.when((F.col("own") != 1) & F.col("first").isNull(), 2).otherwise(F.col("own"))
    each = F.struct("row", "initial", found.cast("string").alias("fault"))
    by = joined.groupBy("id", F.shiftright("row", BLOCK_BITS).alias("block")).agg(F.array_sort(F.collect_list(each)).alias("all"))
    letters = lambda name: F.array_join(F.transform("all", lambda x: x[name]), "")
    return by.select("id", F.col("all")[0]["row"].alias("start"), letters("initial").alias("initials"), letters("fault").alias("faults"))


class Graph:
    """The nodes that have been reached after some rows: for each state and number of edits the least sum."""

    def __init__(self, width: int, state: int):
        self.bits = 3 * width
        self.at: dict[int, dict[int, int]] = {state: {0: 0}}

    def edge(self, to: dict[int, dict[int, int]], state: int, edits: int, total: int, cost: int, digits: int, n: int) -> None:
        total += (cost << self.bits) + (digits << self.bits - 3 * (edits + n))
        nodes = to.setdefault(state, {})
        nodes[edits + n] = min(total, nodes.get(edits + n, total))

    def move(self, to: dict[int, dict[int, int]]) -> None:
        """Go on from these nodes. A state's dearer nodes can't be on the way: what follows costs the same."""
        for state, nodes in to.items():
            if len(nodes) > 1:
                most = (min(nodes.values()) >> self.bits) + 1 << self.bits
                to[state] = {n: total for n, total in nodes.items() if total < most}
        self.at = to

    def insert(self, cost: int) -> None:
        """Up to two insertions here; a third would come back to a state that was there for less."""
        new = {state: dict(nodes) for state, nodes in self.at.items()}
        last = self.at
        for _ in range(2):
            more: dict[int, dict[int, int]] = {}
            for state, nodes in last.items():
                for n, total in nodes.items():
                    self.edge(more, _NEXT[state], n, total, cost, _INSERT, 1)
            for state, nodes in more.items():
                for n, total in nodes.items():
                    own = new.setdefault(state, {})
                    own[n] = min(total, own.get(n, total))
            last = more
        self.move(new)

    def row(self, initial: str, fault: str, costs: Costs) -> None:
        to: dict[int, dict[int, int]] = {}
        more = costs.truncated if fault == "3" else 0
        for state, nodes in self.at.items():
            goal = _NEXT[state]
            for n, total in nodes.items():
                self.edge(to, state, n, total, costs.delete, _DELETE, 1)
                if fault in "03":
                    self.edge(to, goal, n, total, costs.rename + more, _RENAME, 1)
                    if initial == _INITIAL[goal]:
                        self.edge(to, goal, n, total, costs.keep + more, _KEEP, 1)
                    elif initial == "s" and state == _NONE:
                        self.edge(to, _SYSTEM, n, total, costs.keep + more, _KEEP, 1)
        self.move(to)

    def letters(self, n: int, total: int) -> str:
        digits = f"{total & (1 << self.bits) - 1:0{self.bits // 3}o}"
        return digits[:n].translate({ord("1") + i: c for i, c in enumerate(LETTERS)})


def block_entries(initials: str, faults: str, costs: Costs) -> list[Entry]:
    """The cheapest ways through a block from every state to every other, of each number of edits."""
    out = []
    for state in range(4):
        graph = Graph(3 * len(initials), state)
        for initial, wrong in zip(initials, faults, strict=True):
            graph.insert(costs.insert)
            graph.row(initial, wrong, costs)
        out += [(state, goal, total >> graph.bits, graph.letters(n, total)) for goal, nodes in graph.at.items() for n, total in nodes.items()]
    return out


_DIGITS = {ord(c): str(i) for i, c in enumerate(LETTERS, 1)}


def audit(parts: list[list[Entry]], costs: Costs) -> tuple[int, str]:
    """Cost and letters of the best edits of a conversation, from its blocks' entries in order."""
    graph = Graph(sum(max(len(e[3]) for e in part) for part in parts) + 2, _NONE)
    for part in parts:
        to: dict[int, dict[int, int]] = {}
        for before, after, cost, letters in part:
            digits = int(letters.translate(_DIGITS), 8)
            for n, total in graph.at.get(before, {}).items():
                graph.edge(to, after, n, total, cost, digits, len(letters))
        graph.move(to)
    graph.insert(costs.insert)
    total, n = min((total, n) for state in (_NONE, _ASSISTANT) for n, total in graph.at.get(state, {}).items())
    return total >> graph.bits, graph.letters(n, total)


def walk(letters: str, initials: str, state: int) -> Iterator[tuple[int, str, int]]:
    """Of each edit from ``state`` on: the place of its row (an insertion's is the next row's), its letter, the state after it."""
    i = 0
    for letter in letters:
        if letter != "D":
            state = _SYSTEM if letter == "K" and initials[i] == "s" else _NEXT[state]
        yield i, letter, state
        i += letter != "I"


def pieces(letters: str, parts: list[str]) -> Iterator[tuple[int, str]]:
    """(state before, letters) of each block; what is inserted after the last row belongs to the last."""
    at, state = 0, _NONE
    for k, part in enumerate(parts, 1):
        end, left = at, len(part)
        while left:
            left -= letters[end] != "I"
            end += 1
        own = letters[at:] if k == len(parts) else letters[at:end]
        yield state, own
        at = end
        for _, _, state in walk(own, part, state):
            pass


def edits(letters: str, initials: str, start: int, state: int) -> Iterator[tuple[int, int, str | None, bool]]:
    """(row, place, role, own text) of what is left of a block; role None is the row's own."""
    for place, (i, letter, after) in enumerate(walk(letters, initials, state)):
        if letter != "D":
            yield start + min(i, len(initials) - 1), place, None if letter == "K" else _ROLE[after], letter != "I"


_ENTRIES = pa.list_(pa.struct([("before", pa.int8()), ("after", pa.int8()), ("cost", pa.int64()), ("letters", pa.string())]))
_PIECES = pa.list_(pa.struct([("start", pa.int64()), ("initials", pa.string()), ("before", pa.int8()), ("letters", pa.string())]))


def repair(turns: DataFrame, costs: Costs = Costs()) -> tuple[DataFrame, DataFrame]:
    """For rows (id, turn, role, text): conversations (id, blank, duplicate, truncated, illegal, gaps,
    cost, audit), and what is left, (id, row, place, role, text) in the order of row and place."""
    rows = numbered(turns)
    kind = rows.schema["id"].dataType.simpleString()

    def entries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = [
                [dict(zip(("before", "after", "cost", "letters"), e, strict=True)) for e in block_entries(i, f, costs)]
                for i, f in zip(part.column("initials").to_pylist(), part.column("faults").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, _ENTRIES)], names=[*part.schema.names, "entries"])

    kinds = f"id {kind}, start long, initials string, faults string, entries array<struct<before:tinyint,after:tinyint,cost:long,letters:string>>"
    by = blocks(rows).mapInArrow(entries, kinds).groupBy("id")
    whole = by.agg(F.array_sort(F.collect_list(F.struct("start", "initials", "faults", "entries"))).alias("blocks"))

    def solved(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                own = part.column("blocks")[i].as_py()
                initials, faults = "".join(b["initials"] for b in own), "".join(b["faults"] for b in own)
                cost, letters = audit([[tuple(e.values()) for e in b["entries"]] for b in own], costs)
                illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
                cuts = [{"start": b["start"], "initials": b["initials"], "before": before, "letters": some} for b, (before, some) in zip(own, pieces(letters, [b["initials"] for b in own]), strict=True)]
                counts = [pa.array([faults.count(str(k))], pa.int64()) for k in (1, 2, 3)]
                columns = [part.column("id").slice(i, 1), *counts, pa.array([illegal], pa.int64()), pa.array([cost], pa.int64()), pa.array([letters]), pa.array([cuts], _PIECES)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *FAULTS, "illegal", "cost", "audit", "pieces"])

    def left(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [(k, *e) for k, b in enumerate(part.select(["letters", "initials", "start", "before"]).to_pylist()) for e in edits(*b.values())]
            columns = list(zip(*found, strict=True)) or [()] * 5
            made = [pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.int32(), pa.string(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(columns[0], pa.int32())), *made], names=["id", "row", "place", "given", "own"])

    kinds = f"id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, pieces array<struct<start:long,initials:string,before:tinyint,letters:string>>"
    found = staged(whole.mapInArrow(solved, kinds), "audits")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    spans = rows.groupBy(F.col("id").alias("of")).agg(gaps.alias("gaps"))
    audits = found.drop("pieces").join(spans, F.col("id").eqNullSafe(F.col("of"))).drop("of")
    stay = found.select("id", F.inline("pieces")).mapInArrow(left, f"id {kind}, row long, place int, given string, own boolean")
    texts = rows.select("row", "role", "text")
    repaired = stay.hint("merge").join(texts.hint("merge"), "row").select("id", "row", "place", F.coalesce("given", "role").alias("role"), F.when(F.col("own"), F.col("text")).otherwise("").alias("text"))
    return audits, repaired


def digests(repaired: DataFrame) -> DataFrame:
    """Rows (id, sha256) of a conversation's ``role:text`` lines, joined by line feeds.

    A digest takes its text in order; it is streamed over sorted rows and holds one row at a time.
    """
    kind, arrow = repaired.schema["id"].dataType.simpleString(), to_arrow_type(repaired.schema["id"].dataType)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, ids, out = None, None, [], []
        for part in parts:
            for one, line in zip(part.column("id").to_pylist(), part.column("line"), strict=True):
                raw = line.as_py().encode()
                if state is None or one != now:
                    if state is not None:
                        ids.append(now)
                        out.append(state.hexdigest())
                    now, state = one, hashlib.sha256(raw)
                else:
                    state.update(b"\n" + raw)
            yield pa.RecordBatch.from_arrays([pa.array(ids, arrow), pa.array(out, pa.string())], names=["id", "sha256"])
            ids, out = [], []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], arrow), pa.array([state.hexdigest()])], names=["id", "sha256"])

    lines = repaired.repartition("id").sortWithinPartitions("id", "row", "place").select("id", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.mapInArrow(batches, f"id {kind}, sha256 string")
