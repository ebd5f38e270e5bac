"""Conversation structure repaired at least cost, by Four-Russians block tables.

A sound conversation is empty, or a system turn or none followed by pairs of a user and an assistant
turn. Rows are judged one by one and become symbols. The cost of repairing the rest of a
conversation, seen from each state of the grammar, is a vector of four numbers; less their minimum
only a handful of vectors exist. So for every such vector and every block of ``BLOCK`` symbols the
vector before the block and the cost it adds are worked out once, and a conversation is read from
its end block by block with one lookup each. Afterwards the blocks are expanded from their right
border and the letters of the edits traced from the first row on, the least letter that is still on a
cheapest way first: ties are broken as if all cheapest ways had been written out and sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.frames import ship, stored

BLOCK = 4
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
RETAG_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
SYSTEM, USER, ASSISTANT, OTHER = range(4)
_INITIALS = ("s", "u", "a")
# States of the grammar: what came last.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
STATES = 4
# A new turn's role is settled by the state: an assistant follows a user, a user anything else.
_ADDED = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
# Symbol 0 has to go; the others are 1 + 2 * kind + (1 if truncated).
SYMBOLS = 9
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[SYSTEM, USER] = _LEGAL[USER, ASSISTANT] = _LEGAL[ASSISTANT, USER] = True

PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURNS = "conv_id long, place long, role string, text string"


def _kept(state: int, kind: int) -> int | None:
    """The state after a row of this kind is kept, None where the grammar has no place for it."""
    if kind == SYSTEM:
        return _SYSTEM if state == _NOTHING else None
    after = {USER: _USER, ASSISTANT: _ASSISTANT}.get(kind)
    return after if after == _ADDED[state] else None


def row_edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """Edits of a row, in the order of their letters: letter, cost, state after it."""
    edits = [(DELETE, DELETE_COST, state)]
    if symbol:
        kind, truncated = divmod(symbol - 1, 2)
        extra = TRUNCATED_COST * truncated
        after = _kept(state, kind)
        if after is not None:
            edits.append((KEEP, extra, after))
        edits.append((REROLE, RETAG_COST + extra, _ADDED[state]))
    return edits


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """The cheapest way from each state where turns may also be added first."""
    for _ in range(STATES):
        costs = [min(costs[q], INSERT_COST + costs[_ADDED[q]]) for q in range(STATES)]
    return tuple(costs)


FAR = 1_000
END_COSTS = _with_inserts([0, FAR, FAR, 0])
"""What is still to pay after the last row: it must be empty or end with an assistant's turn."""


def costs_before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """From the costs after a row to those before it."""
    return _with_inserts([min(cost + costs[after] for _, cost, after in row_edits(q, symbol)) for q in range(STATES)])


class Tables:
    """Numbered normalised vectors, their transitions by symbol and by block, and the letters."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [END_COSTS]
        number = {END_COSTS: 0}
        steps, added = [], []
        for vector in self.vectors:  # grows while it is read
            row, plus = [], []
            for symbol in range(SYMBOLS):
                before = costs_before(vector, symbol)
                least = min(before)
                normal = tuple(c - least for c in before)
                if normal not in number:
                    number[normal] = len(number)
                    self.vectors.append(normal)
                row.append(number[normal])
                plus.append(least)
            steps.append(row)
            added.append(plus)
        self.step, self.added = np.array(steps), np.array(added)
        codes = np.arange(SYMBOLS**block)
        before = np.repeat(np.arange(len(self.vectors))[:, None], len(codes), 1)
        total = np.zeros_like(before)
        for place in range(block):  # the last symbol of a block is its lowest digit
            symbols = (codes // SYMBOLS**place) % SYMBOLS
            total += self.added[before, symbols]
            before = self.step[before, symbols]
        self.block_step, self.block_added = before, total
        self.digits = SYMBOLS ** np.arange(block - 1, -1, -1)

    @cache
    def letters(self, after: int, symbol: int, state: int) -> tuple[str, int]:
        """The letters up to and with the edit of a row, and the state after it; ``after`` is the
        vector behind the row. Deleting sorts before adding, adding before keeping."""
        behind = self.vectors[after]
        before = costs_before(behind, symbol)
        text = ""
        while True:
            choices = {letter: (cost + behind[to], to) for letter, cost, to in row_edits(state, symbol)}
            if choices[DELETE][0] == before[state]:
                return text + DELETE, state
            if INSERT_COST + before[_ADDED[state]] == before[state]:
                text, state = text + INSERT, _ADDED[state]
                continue
            letter = min(c for c in choices if choices[c][0] == before[state])
            return text + letter, choices[letter][1]

    def repair(self, symbols: np.ndarray) -> tuple[int, str]:
        """Cost and letters of the cheapest repair of a conversation."""
        first = len(symbols) % self.block  # the rows before the first whole block
        codes = symbols[first:].reshape(-1, self.block) @ self.digits
        borders, cost, vector = [0], 0, 0
        for code in codes[::-1].tolist():
            cost += int(self.block_added[vector, code])
            vector = int(self.block_step[vector, code])
            borders.append(vector)
        for symbol in symbols[:first][::-1].tolist():
            cost += int(self.added[vector, symbol])
            vector = int(self.step[vector, symbol])
        cost += self.vectors[vector][_NOTHING]
        parts, state = [], _NOTHING
        blocks = [symbols[:first], *symbols[first:].reshape(-1, self.block)]
        for block, border in zip(blocks, reversed(borders)):
            own, behind = block.tolist(), []
            for symbol in reversed(own):
                behind.append(border)
                border = int(self.step[border, symbol])
            for symbol, after in zip(own, reversed(behind)):
                text, state = self.letters(after, symbol, state)
                parts.append(text)
        while END_COSTS[state]:
            parts.append(INSERT)
            state = _ADDED[state]
        return cost, "".join(parts)


@cache
def tables() -> Tables:
    return Tables()


# --- rows ------------------------------------------------------------------------------


def _own(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    ship(rows.sparkSession)
    own = rows.select(
        rows[conversation].cast("long").alias("conv_id"),
        rows[turn].cast("long").alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit(" ")).alias("text"),
    )
    return own.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _kind(role: Column) -> Column:
    kind = F.lit(OTHER)
    for number, initial in enumerate(_INITIALS):
        kind = F.when(F.startswith(role, F.lit(initial)), F.lit(number)).otherwise(kind)
    return kind.cast("byte")


def judged_turns(own: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """``conv_id, turn, role, digest, kind, fault, present``, whole conversations in a partition and in
    order. Conversations of ``named`` have a row that is not ``present``, so that none is missed."""
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(
        ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED
    )
    small = own.select(
        "conv_id", "turn", "role", "digest", _kind(F.col("role")).alias("kind"),
        F.coalesce(fault, F.lit(SOUND)).cast("byte").alias("fault"), F.lit(True).alias("present"),
    )
    if named is not None:
        ids = named.select(named["conv_id"].cast("long").alias("conv_id")).distinct()
        small = small.unionByName(ids.withColumn("present", F.lit(False)), allowMissingColumns=True)
    same = Window.partitionBy("conv_id", "role", "digest").orderBy("turn")
    seen = (F.row_number().over(same) > 1) & (F.col("fault") != BLANK)
    return (
        small.repartition("conv_id")
        .withColumn("seen", seen)
        .sortWithinPartitions("conv_id", "turn", "role", "digest", "seen")
        .withColumn("fault", F.when(F.col("seen"), F.lit(DUPLICATE).cast("byte")).otherwise(F.col("fault")))
    )


def _conversations(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """(id, columns of all its rows) of every conversation of a sorted partition. What is put
    together is a few bytes a row; texts are not among the columns."""
    waiting, name = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id")
        numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
        absent = ids.is_null().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (absent[1:] != absent[:-1])) + 1
        parts = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            own = None if absent[start] else int(numbers[start])
            if waiting and own != name:
                yield name, [np.concatenate(c) for c in zip(*waiting)]
                waiting = []
            name = own
            waiting.append([p[start:end] for p in parts])
    if waiting:
        yield name, [np.concatenate(c) for c in zip(*waiting)]


def _gaps(turns: np.ndarray) -> int:
    """Turn numbers missing between the first and the last; ``turns`` are sorted, without nulls."""
    if not len(turns):
        return 0
    return int(turns[-1]) - int(turns[0]) - int(np.count_nonzero(turns[1:] != turns[:-1]))


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    repair, out = tables().repair, []
    schema = pa.schema([(n, pa.string() if n == "audit" else pa.int64()) for n in [c.split()[0] for c in PLAN.split(", ")]])

    def batch_of(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    for name, (known, turns, kinds, faults, present) in _conversations(
        batches, ["known", "number", "kind", "fault", "present"]
    ):
        known, turns, kinds, faults = known[present], turns[present], kinds[present], faults[present]
        symbols = np.where((faults == BLANK) | (faults == DUPLICATE), 0, 1 + 2 * kinds + (faults == TRUNCATED)).astype(np.int64)
        cost, audit = repair(symbols)
        counts = [int(np.count_nonzero(faults == f)) for f in (BLANK, DUPLICATE, TRUNCATED)]
        illegal = int(np.count_nonzero(~_LEGAL[kinds[:-1], kinds[1:]])) if len(kinds) else 0
        out.append((name, _gaps(turns[known]), *counts, illegal, cost, audit))
        if len(out) >= 4096:
            yield batch_of(out)
            out = []
    if out:
        yield batch_of(out)


def repair_plan(
    rows: DataFrame,
    conversations: DataFrame | None = None,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Per conversation its faults, and the cost and letters of its cheapest repair:
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``gaps``: turn numbers missing between the least and the greatest. Each row's first fault counts:
    blank, duplicate (role and text seen earlier), truncated (no ``.!?`` at its end). ``illegal``:
    neighbours whose role initials are not su, ua or au. Letters: K keep, R give the role the grammar
    wants, D delete, I add an empty turn.

    Rows are taken by turn, those without one first; rows of one turn by role and digest of the text,
    repeated rows beside each other. A null role or text is one space. Rows without an id are one
    conversation. ``conversations`` (``conv_id``) names conversations to report even without rows:
    zeros and an empty ``audit``. An empty table gives no rows; other columns don't matter. Texts are
    hashed where they are read and not shuffled; of a conversation a task holds a few bytes a row.
    """
    none = F.lit(0).cast("byte")
    symbols = judged_turns(_own(rows, conversation, turn, role, text), conversations).select(
        "conv_id",
        F.col("turn").isNotNull().alias("known"),
        F.coalesce("turn", F.lit(0).cast("long")).alias("number"),
        F.coalesce("kind", none).alias("kind"),
        F.coalesce("fault", none).alias("fault"),
        "present",
    )
    return symbols.mapInArrow(_plans, PLAN)


# --- the repaired conversations --------------------------------------------------------


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's letters come first, its rows after them: each row is written as it is read."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    name, audit, at, state, place = None, "", 0, _NOTHING, 0
    out: list[tuple] = []

    def write(role: str, text: str) -> None:
        nonlocal place
        out.append((name, place, role, text))
        place += 1

    def add_turns() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            state = _ADDED[state]
            write(_ROLES[state], "")
            at += 1

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "is_row", "role", "text")]
        for conversation, is_row, role, text in zip(*columns):
            if not is_row:
                add_turns()
                name, audit, at, state, place = conversation, text, 0, _NOTHING, 0
                continue
            add_turns()
            letter, at = audit[at], at + 1
            if letter == KEEP:
                state = _SYSTEM if role.startswith("s") else _ADDED[state]
                write(role, text)
            elif letter == REROLE:
                state = _ADDED[state]
                write(_ROLES[state], text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
    add_turns()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def repaired_turns(
    rows: DataFrame,
    plan: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The conversations after the edits of ``repair_plan``: ``conv_id, place, role, text``, ``place``
    counting from 0, every conversation in one partition and in order. ``rows`` and the columns are
    those that the plan was made from. Texts pass through one at a time, sorted by Spark."""
    own = _own(rows, conversation, turn, role, text).withColumn("is_row", F.lit(True))
    heads = plan.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
        F.lit(None).cast("binary").alias("digest"), F.lit(False).alias("is_row"),
    )
    ordered = (
        own.unionByName(heads)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest")
        .select("conv_id", "is_row", "role", "text")
    )
    return ordered.mapInArrow(_repaired, TURNS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, hashes, running = [], [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]
        for conversation, place, role, text in zip(*columns):
            line = f"{role}:{text}"
            if place == 0:
                if running is not None:
                    hashes.append(running.hexdigest())
                ids.append(conversation)
                running = hashlib.sha256(line.encode())
            else:
                running.update(b"\n" + line.encode())
    if running is not None:
        hashes.append(running.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "digest"])


def repair_digests(
    rows: DataFrame, conversations: DataFrame | None = None, **columns: str
) -> DataFrame:
    """The plan with ``repaired_sha256``, over the repaired ``role:text`` lines joined by line ends; that
    of a conversation without any is the one of an empty text."""
    plan = stored(repair_plan(rows, conversations, **columns), "repair-plan")
    digests = repaired_turns(rows, plan, **columns).mapInArrow(_digests, "conv_id long, digest string")
    own = digests.select(F.col("conv_id").alias("own_id"), "digest")
    joined = plan.join(own, F.col("conv_id").eqNullSafe(F.col("own_id")), "left")
    return joined.select(*plan.columns, F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
