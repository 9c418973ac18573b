"""Conversation structure repair by a generalised LR parser with weighted edits.

Roles must read ``(s?(ua)+)?``: an optional system turn, then pairs of user and assistant. The LR tables are
built from the productions below. A conversation is read once, in turn order. The frontier of the
graph-structured stack holds one stack per top state: every turn may be kept, given another role or deleted, and
empty turns may be inserted before and after it; where two stacks end in the same state, the one with the
smaller (cost, audit) stays, since whatever follows costs both the same. (Two audits of one cost and one number of
turns never begin with each other, an insertion costs something, so the comparison holds for whatever follows.)

A conversation is streamed: Spark deals conversations to tasks and sorts their turns, and a stack carries the
running digest of its repaired text. So a task holds neither the texts nor the group; of every turn it
keeps an edit and a digest of 16 bytes by which repeated turns are known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import ship_package

# The role grammar, the two roles an edit can give, and what edits cost.
PRODUCTIONS = (("S", ""), ("S", "T"), ("S", "sT"), ("T", "P"), ("T", "TP"), ("P", "ua"))
TERMINALS = "sua"
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_FOLLOWS = {"su", "ua", "au"}
# After so many turns, what all stacks have decided alike is set aside.
SETTLE = 512


def _tables() -> tuple[list[dict[str, int]], list[list[tuple[str, int]]], set[int]]:
    """Per LR state: where each symbol leads, what can be reduced (left side, length), and the accepting states."""

    def closed(items):
        items, before = set(items), None
        while before != len(items):
            before = len(items)
            wanted = {PRODUCTIONS[p][1][dot] for p, dot in items if dot < len(PRODUCTIONS[p][1])}
            items |= {(p, 0) for p, (left, _) in enumerate(PRODUCTIONS) if left in wanted}
        return frozenset(items)

    states = [closed({(p, 0) for p, (left, _) in enumerate(PRODUCTIONS) if left == "S"})]
    moves = []
    for state in states:  # grows while it is read
        leads = {}
        for symbol in sorted({PRODUCTIONS[p][1][dot] for p, dot in state if dot < len(PRODUCTIONS[p][1])}):
            target = closed({
                (p, dot + 1) for p, dot in state if PRODUCTIONS[p][1][dot : dot + 1] == symbol
            })
            if target not in states:
                states.append(target)
            leads[symbol] = states.index(target)
        moves.append(leads)
    done = [[PRODUCTIONS[p] for p, dot in state if dot == len(PRODUCTIONS[p][1])] for state in states]
    reduces = [sorted((left, len(right)) for left, right in found if left != "S") for found in done]
    accepts = {n for n, found in enumerate(done) if any(left == "S" for left, _ in found)}
    return moves, reduces, accepts


MOVES, REDUCES, ACCEPTS = _tables()


@dataclass(frozen=True, slots=True)
class Node:
    """A state on a stack, what lies below it, and what the stack has cost."""

    state: int
    below: Node | None
    cost: int = 0
    audit: str = ""
    said: object = None  # the digest of the repaired text so far; None before the first turn

    @property
    def order(self) -> tuple[int, str]:
        return self.cost, self.audit


def _said(before, role: str, text: str):
    digest = sha256() if before is None else before.copy()
    digest.update(("" if before is None else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
    return digest


def _shift(node: Node, symbol: str, cost: int, action: str, role: str, text: str) -> Node | None:
    """The stack after a terminal and all reductions; None where the terminal does not fit."""
    state = MOVES[node.state].get(symbol) if symbol in TERMINALS else None
    if state is None:
        return None
    new = Node(state, node, node.cost + cost, node.audit + action, _said(node.said, role, text))
    while REDUCES[new.state]:
        left, length = REDUCES[new.state][0]
        under = new
        for _ in range(length):
            under = under.below
        new = Node(MOVES[under.state][left], under, new.cost, new.audit, new.said)
    return new


def _offer(frontier: dict[int, Node], node: Node | None) -> bool:
    """Merge a stack into the frontier; whether it is the best with its top."""
    if node is None:
        return False
    best = frontier.get(node.state)
    if best is not None and best.order <= node.order:
        return False
    frontier[node.state] = node
    return True


def _inserted(frontier: dict[int, Node]) -> dict[int, Node]:
    """The frontier with every useful insertion."""
    fresh = list(frontier.values())
    while fresh:
        tried = [_shift(n, t, INSERT, "I", ROLES[t], "") for n in fresh for t in ROLES]
        fresh = [n for n in tried if _offer(frontier, n)]
    return frontier


class Conversation:
    """The state of the parse of one conversation, fed turn by turn."""

    def __init__(self, key):
        self.key = key
        self.frontier = _inserted({0: Node(0, None)})
        self.settled, self.rows = [], 0
        self.seen: set[bytes] = set()
        self.low = self.high = self.last_turn = self.last_initial = None
        self.turns = 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def fault(self, role: str, text: str) -> str | None:
        """The first fault of the next turn."""
        mark = blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        repeated = mark in self.seen
        self.seen.add(mark)
        kept = text.rstrip(_SPACE)
        if not kept:
            return "blank"
        if repeated:
            return "duplicate"
        return None if kept[-1] in ".!?" else "truncated"

    def add(self, turn: int | None, role: str, text: str) -> str | None:
        self.rows += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in _FOLLOWS:
            self.counts["illegal"] += 1
        self.last_initial = initial
        fault = self.fault(role, text)
        if fault:
            self.counts[fault] += 1

        after: dict[int, Node] = {}
        more = TRUNCATED if fault == "truncated" else 0
        for node in self.frontier.values():
            _offer(after, Node(node.state, node.below, node.cost + DELETE, node.audit + "D", node.said))
            if fault in ("blank", "duplicate"):
                continue
            if initial:
                _offer(after, _shift(node, initial, more, "K", role, text))
            for symbol, name in ROLES.items():
                _offer(after, _shift(node, symbol, more + REROLE, "R", name, text))
        self.frontier = _inserted(after)
        if self.rows % SETTLE == 0:
            self._settle()
        return fault

    def _settle(self) -> None:
        """Set aside the common beginning of all audits, and the cost all have in common."""
        audits = [n.audit for n in self.frontier.values()]
        low, high = min(audits), max(audits)
        same = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        self.settled.append(low[:same])
        self.frontier = {
            n.state: Node(n.state, n.below, n.cost, n.audit[same:], n.said) for n in self.frontier.values()
        }

    def result(self) -> tuple:
        best = min((n for n in self.frontier.values() if n.state in ACCEPTS), key=lambda n: n.order)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        audit = "".join(self.settled) + best.audit if self.rows else ""
        said = best.said if self.rows and best.said is not None else sha256()
        cost = best.cost if self.rows else 0
        counts = [self.counts[k] for k in ("blank", "duplicate", "truncated", "illegal")]
        return (self.key, self.rows, gaps, *counts, cost, audit, said.hexdigest())


_FOUND = "n_turns bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, " \
    "cost bigint, audit string, repaired_sha256 string"  # fmt: skip


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, its first row, row) of sorted rows; a key of None is a key like others."""
    started, last = False, None
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for at in range(batch.num_rows):
            row = [c[at].as_py() for c in columns]
            first, started, last = not started or row[0] != last, True, row[0]
            yield first, row


def _repairs(kind: pa.DataType):
    names = [part.split()[0] for part in _FOUND.split(", ")]
    kinds = [pa.string() if part.endswith("string") else pa.int64() for part in _FOUND.split(", ")]

    def batch_of(results: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*results), [kind, *kinds])]
        return pa.record_batch(columns, names=["conv", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, results = None, []
        for first, (key, turn, role, text, copies) in _conversations(batches):
            if first:
                if current is not None:
                    results.append(current.result())
                current = Conversation(key)
                if len(results) >= 1000:
                    yield batch_of(results)
                    results = []
            for _ in range(copies):
                current.add(turn, role, text)
        if current is not None:
            yield batch_of([*results, current.result()])

    return run


def _sorted(df: DataFrame, *more: str) -> DataFrame:
    """Conversations dealt to tasks, turns in order; ties by role and text, which makes them copies."""
    return df.repartition("conv").sortWithinPartitions("conv", *more, "turn", "role", "text")


def _turns(df: DataFrame, conv: str, turn: str, role: str, text: str, copies) -> DataFrame:
    return df.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        copies.cast("int").alias("copies"),
    )


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def repair(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies_col: str | None = None,
) -> DataFrame:
    """One row per conversation: the cheapest edits that make its roles ``(s?(ua)+)?``, and its faults.

    Columns: conv_col, n_turns, gaps (turn numbers missing between the first and the last), blank, duplicate and truncated
    (turns by their first fault: no word; role and text seen before; last mark not one of ``.!?``), illegal (neighbours
    whose initials are not su, ua or au), cost, audit (K keep, R rerole, D delete, I insert, in order; of equally
    cheap edits the ASCII-least), repaired_sha256 (the repaired ``role:text``, joined by newlines).

    Turns are taken in order, null turns first, ties by role and text. A null role or text is one space. A role with
    another initial than s, u or a, or without one, cannot be kept. Null conversation ids are one
    conversation. ``copies_col`` says how often a row counts: 0 leaves the row out, and a conversation without any row left
    has zeros, an empty audit and the digest of the empty text. Repeated rows are duplicates. An empty table gives
    none. Other columns are ignored, whatever their names. Texts of any length are hashed as they stream by.
    """
    ship_package(df.sparkSession)
    copies = F.coalesce(F.col(copies_col), F.lit(0)) if copies_col else F.lit(1)
    turns = _sorted(_turns(df, conv_col, turn_col, role_col, text_col, copies))
    kind = df.schema[conv_col].dataType.simpleString()
    found = turns.mapInArrow(_repairs(_arrow(df, conv_col)), f"conv {kind}, {_FOUND}")
    return found.withColumnRenamed("conv", conv_col)


def _replayed(kind: pa.DataType):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        names = ["conv", "place", "action", "turn", "role", "text"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        edits, place, before = iter(()), 0, ""

        def insertions(conv):
            """The edits up to the next one on a turn, and that one."""
            nonlocal place, before
            for action in edits:
                if action != "I":
                    return action
                before = "a" if before == "u" else "u"
                out.append((conv, place, "I", None, ROLES[before], ""))
                place += 1
            return None

        conv = None
        for first, (key, is_turn, turn, role, text, copies, audit) in _conversations(batches):
            if first:
                insertions(conv)
                edits, place, before, conv = iter(()), 0, "", key
            if not is_turn:
                edits = iter(audit)
                continue
            for _ in range(copies):
                action = insertions(key)
                if action == "K":
                    before = role[:1]
                elif action == "R":
                    before = "a" if before == "u" else "u"
                    role = ROLES[before]
                if action in ("K", "R"):
                    out.append((key, place, action, turn, role, text))
                    place += 1
                    size += len(text)
            if len(out) >= 1000 or size > 1 << 24:
                yield batch_of(out)
                out, size = [], 0
        insertions(conv)
        if out:
            yield batch_of(out)

    return run


def repaired_turns(
    df: DataFrame,
    repaired: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies_col: str | None = None,
) -> DataFrame:
    """The turns after repair: conv_col, place (from 0), action, turn, role, text.

    ``repaired`` is what ``repair`` found for the same rows. Deleted turns are left out, inserted ones have no turn.
    """
    ship_package(df.sparkSession)
    copies = F.coalesce(F.col(copies_col), F.lit(0)) if copies_col else F.lit(1)
    turns = _turns(df, conv_col, turn_col, role_col, text_col, copies)
    rows = turns.select("conv", F.lit(True).alias("is_turn"), "turn", "role", "text", "copies", F.lit("").alias("audit"))
    plans = repaired.select(
        F.col(conv_col).alias("conv"), F.lit(False).alias("is_turn"), F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("copies"), F.col("audit"),
    )
    kind = df.schema[conv_col].dataType.simpleString()
    schema = f"conv {kind}, place bigint, action string, turn bigint, role string, text string"
    both = _sorted(plans.unionByName(rows), "is_turn")
    return both.mapInArrow(_replayed(_arrow(df, conv_col)), schema).withColumnRenamed("conv", conv_col)
