"""Repairing the structure of conversations: the cheapest edits after which roles read ``s?(ua)+``, or nothing is left.

Rows of a conversation stand by ``turn``. A row is blank, a duplicate of an earlier one (role and text), truncated (its text does
not end in ``[.!?]``) or sound; the first of these counts. Edits are Keep, Rerole to user or assistant, Delete (a must for blank and
duplicate rows) and Insert of an empty user or assistant row; a truncated row that is not deleted costs more. Of the cheapest
edits, those with the least audit string (their initials in order) are taken.

One integer decides. Edits are paths through a graph of (row, inserts so far, grammar state); an edge weighs ``cost * 8**n``
plus its letter's digit at its place in the audit, ``n`` being the longest audit there can be. Digits from the left, D I K R
as 1 to 4, with zeros at the end of shorter audits, compare as the strings do, so the least sum is the cheapest path with the least
audit. An insert that costs more than two deletes is never in it: without the inserted row and the one beside it (and a system row
left alone) the roles still fit. Then audits are as long as the conversation, and long ones are cut into blocks: a block is the
least weight from each state to each, and blocks are put together in pairs.

Two passes. The first moves rows without texts and keeps one byte a row of the conversation at hand. The second sorts the texts
behind their conversation's audit, so they stream by; an audit is one string, so the longest conversation bounds both.

Defined cases: a null in any column is one space, but a null turn is no turn, stands first and is not counted in gaps; a null
``conv_id`` is a conversation; rows with one turn stand in order of role and text hash; a conversation whose rows were
all dropped has no faults, an empty audit and an empty text; an empty table gives no row; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = " DIKR"
NAMES = {"u": "user", "a": "assistant"}
# Grammar states and where a role leads from them; START and A may end a conversation.
START, S, U, A = range(4)
_MOVES = {START: {"s": S, "u": U}, S: {"u": U}, U: {"a": A}, A: {"u": U}}
_ENDS = (START, A)
BLOCK = 64
_FAULTS = ("", "blank", "duplicate", "truncated")
_MUST_GO = (1, 2)
_TRUNCATED = 3
_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def most_inserts(self, rows: int) -> int:
        """Inserts that a cheapest repair of so many rows can have: deleting them all must not be cheaper."""
        return 0 if self.insert > 2 * self.delete else rows * self.delete // max(self.insert, 1)


COSTS = Costs()
# A row as (initial, number of its fault); coded as one byte.
Row = tuple[str, int]
_INITIALS = "sua"


def _edges(row: Row, state: int, costs: Costs) -> Iterator[tuple[int, int, int]]:
    """``(cost, letter, next state)`` of the edits of a row."""
    initial, fault = row
    yield costs.delete, DELETE, state
    if fault in _MUST_GO:
        return
    more = costs.truncated if fault == _TRUNCATED else 0
    for role, to in _MOVES[state].items():
        if role == initial:
            yield costs.keep + more, KEEP, to
        if role in NAMES:
            yield costs.rerole + more, REROLE, to


def _paths(rows: list[Row], start: int, costs: Costs, most: int) -> dict[tuple[int, int], int]:
    """Least weight from ``start`` to every (inserts, state) behind the rows."""
    width = len(rows) + most
    here = {(0, start): 0}

    def relax(into: dict, node: tuple[int, int], weight: int) -> None:
        if weight < into.get(node, weight + 1):
            into[node] = weight

    for i in range(len(rows) + 1):
        for inserts in range(most):
            for state in range(4):
                if (inserts, state) in here:
                    for role, to in _MOVES[state].items():
                        if role in NAMES:
                            relax(here, (inserts + 1, to), here[inserts, state] + (costs.insert << 3 * width)
                                  + (INSERT << 3 * (width - 1 - i - inserts)))
        if i == len(rows):
            return here
        after: dict[tuple[int, int], int] = {}
        for (inserts, state), weight in here.items():
            for cost, letter, to in _edges(rows[i], state, costs):
                relax(after, (inserts, to), weight + (cost << 3 * width) + (letter << 3 * (width - 1 - i - inserts)))
        here = after


def _joined(left: tuple[int, dict], right: tuple[int, dict]) -> tuple[int, dict]:
    """Two neighbouring blocks ``(rows, {(from, to): least weight})`` as one."""
    n, m, out = left[0], right[0], {}
    for (a, b), x in left[1].items():
        for (c, d), y in right[1].items():
            if b == c:
                weight = (((x >> 3 * n) + (y >> 3 * m)) << 3 * (n + m)) + ((x & (1 << 3 * n) - 1) << 3 * m) + (y & (1 << 3 * m) - 1)
                if weight < out.get((a, d), weight + 1):
                    out[a, d] = weight
    return n + m, out


def cheapest(rows: list[Row], costs: Costs = COSTS) -> tuple[int, str]:
    """Cost and audit of the best repair."""
    most = costs.most_inserts(len(rows))
    if most or len(rows) <= BLOCK:
        width = len(rows) + most
        weight = min(w for (_, state), w in _paths(rows, START, costs, most).items() if state in _ENDS)
    else:
        width, blocks = len(rows), []
        for at in range(0, len(rows), BLOCK):
            part = rows[at: at + BLOCK]
            blocks.append((len(part), {(start, to): w for start in range(4) for (_, to), w in _paths(part, start, costs, 0).items()}))
        while len(blocks) > 1:
            blocks = [_joined(*blocks[i: i + 2]) if i + 1 < len(blocks) else blocks[i] for i in range(0, len(blocks), 2)]
        weight = min(w for (start, to), w in blocks[0][1].items() if start == START and to in _ENDS)
    digits = oct(weight & (1 << 3 * width) - 1)[2:].zfill(width) if width else ""
    return weight >> 3 * width, "".join(LETTERS[int(d)] for d in digits.rstrip("0"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, chosen by a hash of conversation and turn; dropped ones stay with ``present`` false."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), named("role").alias("role"), named("text").alias("text"),
                         kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return marked.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                         (F.col("kind") != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy")


def _read(rows: DataFrame, present: Column) -> DataFrame:
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), present.alias("present")).withColumn("digest", F.sha2("text", 256))


_ORDER = ["turn", "role", "digest"]


def coded(rows: DataFrame) -> DataFrame:
    """Rows without texts: turn, initial of the role, number of the first fault; sorted by conversation and order."""
    text = F.call_function("btrim", "text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(text == "", 1).when(F.right(text, F.lit(1)).isin(".", "!", "?"), 0).otherwise(_TRUNCATED)
    slim = rows.select("conv_id", *_ORDER, "present", fault.alias("fault"))
    same = Window.partitionBy("conv_id", "present", "role", "digest").orderBy("turn")
    numbered = slim.withColumn("nth", F.row_number().over(same))
    return numbered.select("conv_id", *_ORDER, "nth", "present", F.substring("role", 1, 1).alias("initial"), F.when(
        (F.col("fault") != 1) & (F.col("nth") > 1), 2).otherwise(F.col("fault")).cast("int").alias("fault")).repartition("conv_id").sortWithinPartitions(
        "conv_id", *_ORDER, "nth")


@dataclass
class _Conversation:
    """What is kept of the conversation at hand."""

    conv_id: object
    codes: bytearray = field(default_factory=bytearray)
    faults: list[int] = field(default_factory=lambda: [0] * len(_FAULTS))
    first: int | None = None
    last: int | None = None
    turns: int = 0
    illegal: int = 0
    before: str | None = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        self.codes.append(fault << 2 | (_INITIALS.find(initial) + 1 if initial else 0))
        self.faults[fault] += 1
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial

    def row(self, costs: Costs) -> tuple:
        rows = [(_INITIALS[(c & 3) - 1] if c & 3 else "", c >> 2) for c in self.codes]
        cost, audit = cheapest(rows, costs)
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, _MAX)
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, cost, audit)


_METRICS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLAN_ROWS = 4096


def plan_edits(rows: DataFrame, present: Column | None = None, costs: Costs = COSTS) -> DataFrame:
    """Per conversation its faults, the cost of the best repair and its audit."""
    return _plan(_read(rows, F.lit(True) if present is None else present), costs)


def _plan(read: DataFrame, costs: Costs) -> DataFrame:
    kind = read.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def out():
            columns = list(zip(*done))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], ids), *[pa.array(c, pa.int64()) for c in columns[1:-1]], pa.array(columns[-1], pa.string())],
                names=["conv_id", *_METRICS, "audit"])

        for batch in batches:
            ids = batch.schema.field("conv_id").type
            for conv_id, turn, initial, fault, present in zip(*[batch[c].to_pylist() for c in (
                    "conv_id", "turn", "initial", "fault", "present")]):
                if now is None or conv_id != now.conv_id:
                    if now:
                        done.append(now.row(costs))
                    now = _Conversation(conv_id)
                    if len(done) >= _PLAN_ROWS:
                        yield out()
                        done = []
                if present:
                    now.add(turn, initial, fault)
        if now:
            done.append(now.row(costs))
            yield out()

    return coded(read).drop("nth").mapInArrow(run, f"conv_id {kind.simpleString()}, " + ", ".join(f"{m} bigint" for m in _METRICS) + ", audit string")


class Editor:
    """Follows an audit along a conversation's rows; tells role and text of every row that the repair has."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _wanted(self) -> str:
        return next(role for role in _MOVES[self.state] if role in NAMES)

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at: self.at + 1] == "I":
            self.at += 1
            role = self._wanted()
            self.state = _MOVES[self.state][role]
            yield "I", NAMES[role], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return
        initial = role[:1] if letter == "K" else self._wanted()
        self.state = _MOVES[self.state][initial]
        yield letter, role if letter == "K" else NAMES[initial], text

    end = _inserted


def _behind_audits(read: DataFrame, plan: DataFrame) -> DataFrame:
    """Every conversation's plan, then its rows with texts in order."""
    nothing = F.lit(None)
    plans = plan.select("conv_id", F.lit(0).alias("kind"), nothing.cast("bigint").alias("turn"), nothing.cast("string").alias("role"),
                        nothing.cast("string").alias("digest"), F.col("audit").alias("text"), F.struct(*_METRICS).alias("plan"))
    rows = read.where("present").select("conv_id", F.lit(1).alias("kind"), *_ORDER, "text",
                                        nothing.cast(plans.schema["plan"].dataType).alias("plan"))
    return plans.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER).select(
        "conv_id", "kind", "role", "text", "plan")


def repaired(rows: DataFrame, present: Column | None = None, costs: Costs = COSTS) -> DataFrame:
    """The repaired conversations: ``conv_id, position, role, text`` and the ``edit`` that made the row."""
    read = _read(rows, F.lit(True) if present is None else present)
    kind = read.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, conv, position = None, None, 0
        for batch in batches:
            out = []

            def keep(found):
                nonlocal position
                for edit, role, text in found:
                    out.append((conv, position, role, text, edit))
                    position += 1

            for conv_id, what, role, text in zip(*[batch[c].to_pylist() for c in ("conv_id", "kind", "role", "text")]):
                if what == 0:
                    if editor:
                        keep(editor.end())
                    editor, conv, position = Editor(text), conv_id, 0
                else:
                    keep(editor.row(role, text))
            yield _repaired_rows(out, batch.schema.field("conv_id").type)
            ids = batch.schema.field("conv_id").type
        if editor:
            out = [(conv, position + i, role, text, edit) for i, (edit, role, text) in enumerate(editor.end())]
            yield _repaired_rows(out, ids)

    return _behind_audits(read, _plan(read, costs)).mapInArrow(run, f"conv_id {kind}, position bigint, role string, text string, edit string")


def _repaired_rows(out: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * 5
    kinds = (ids, pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "position", "role", "text", "edit"])


def digests(rows: DataFrame, present: Column | None = None, costs: Costs = COSTS) -> DataFrame:
    """``plan_edits`` with ``repaired_sha256``: of the repaired ``role:text`` lines, joined by newlines."""
    read = _read(rows, F.lit(True) if present is None else present)
    kind = read.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # conversation, metrics, editor, hash, whether anything was hashed

        def feed(found):
            for _, role, text in found:
                state[3].update(("\n" if state[4] else "").encode() + f"{role}:{text}".encode())
                state[4] = True

        def finished():
            feed(state[2].end())
            return state[0], *[state[1][m] for m in _METRICS], state[2].audit, state[3].hexdigest()

        for batch in batches:
            out, ids = [], batch.schema.field("conv_id").type
            for conv_id, what, role, text, plan in zip(*[batch[c].to_pylist() for c in ("conv_id", "kind", "role", "text", "plan")]):
                if what == 0:
                    if state:
                        out.append(finished())
                    state = [conv_id, plan, Editor(text), hashlib.sha256(), False]
                else:
                    feed(state[2].row(role, text))
            if out:
                yield rows_of(out, ids)
        if state:
            yield rows_of([finished()], ids)

    def rows_of(out, ids):
        columns = list(zip(*out))
        kinds = (ids, *[pa.int64()] * len(_METRICS), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["conv_id", *_METRICS, "audit", "repaired_sha256"])

    fields = ", ".join(f"{m} bigint" for m in _METRICS)
    return _behind_audits(read, _plan(read, costs)).mapInArrow(run, f"conv_id {kind}, {fields}, audit string, repaired_sha256 string")


def report(rows: DataFrame) -> DataFrame:
    return digests(damage(rows), F.col("present"))
