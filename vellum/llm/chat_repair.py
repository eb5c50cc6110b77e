"""Conversation repair: cheapest edits by Viterbi with coalescing survivors.

A conversation's rows, in order of turn, are edited so that the initials of its
roles read ``(s?(ua)+)?``.  Keep costs 0, a new role (user or assistant) 3, a
deletion 4, an inserted empty user or assistant turn 3; a truncated row that
stays costs 3 more; blank and duplicate rows must go.  Of the cheapest edits the
ones whose initials (D, I, K, R) are ASCII-least win.

The machine has four states: nothing yet, after system, after user, after
assistant.  Each state's best path is a leaf of one tree of edits.  A path that
loses its last reader is taken off the tree (nodes count their children and
holders); as soon as the root has a single child left, all survivors share that
edit and it is emitted with its row.  A survivor that can't catch up any more is
dropped (see ``AHEAD``), so an open stretch is as long as two ways of repair
are within a few points of each other.  Equal costs are decided by the whole
open suffixes; jump pointers find where two of them part in a logarithm of
their length.

Faults of a row, first one counts: blank (white space only), duplicate (same
role and text in an earlier row of the conversation), truncated (last character
that isn't white space is none of ``.!?``).

Scale: repeated rows are found by an aggregate on (conversation, digest) that
combines before the shuffle and a join whose hot keys can be split.  Then rows
are dealt by conversation, sorted (spillable), and streamed: a task holds one
batch and the open stretch, whatever a conversation's length.  The edits of one
conversation are one sequence, as are the digests taken of it, so a single
conversation streams through one task.

Defined results: a null role or text counts as one space; conversations may have
a null id; null turns come first, equal turns are ordered by role, then text;
of equal rows the first counts.  A role's initial is its first character (the
empty role has none), so kept roles may be any that begin with s, u or a.
Extra columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {NOTHING: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
ACCEPTS = (NOTHING, ASSISTANT)
LEGAL = {"su", "ua", "au"}
# What a state's best future can save over the one after an assistant turn: before
# anything is emitted a system row may still be kept instead of deleted.
AHEAD = {NOTHING: DELETE, SYSTEM: 0}

SCHEMA = ("conv_id long, step long, edit string, turn long, was_role string, role string, text string, "
          "fault string, cost long")
DIGESTS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string, n_repaired long")
OUT_ROWS, OUT_CHARS = 4096, 8 << 20


class Node:
    """One edit; ``kids`` and ``held`` are its readers."""

    __slots__ = ("edit", "row", "role", "cost", "parent", "jump", "depth", "kids", "held")

    def __init__(self, parent: "Node | None", edit: str = "", row: tuple | None = None, role: str | None = None, cost: int = 0):
        self.edit, self.row, self.role, self.cost, self.parent = edit, row, role, cost, parent
        self.kids: list[Node] = []
        self.held = False
        if parent is None:
            self.depth, self.jump = 0, self
        else:
            self.depth = parent.depth + 1
            j = parent.jump
            self.jump = j.jump if parent.depth - j.depth == j.depth - j.jump.depth else parent


def _up(node: Node, depth: int) -> Node:
    while node.depth > depth:
        node = node.jump if node.jump.depth >= depth else node.parent
    return node


def less(a: Node, b: Node) -> bool:
    """Whether the edits up to ``a`` are ASCII-less than those up to ``b``."""
    shorter = a.depth < b.depth
    a, b = _up(a, b.depth), _up(b, a.depth)
    if a is b:
        return shorter
    while a.parent is not b.parent:
        a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.parent, b.parent)
    return a.edit < b.edit


class Survivors:
    """The tree of edits of one conversation; ``push`` and ``finish`` return the nodes that became certain."""

    def __init__(self):
        self.root = Node(None)
        self.root.held = True
        self.best: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]

    def _let_go(self, node: Node) -> None:
        node.held = False
        while not node.held and not node.kids and node is not self.root:
            parent = node.parent
            parent.kids.remove(node)
            node = parent

    def _hold(self, node: Node) -> None:
        node.held = True
        node.parent.kids.append(node)

    @staticmethod
    def _better(new: tuple[int, Node], old: tuple[int, Node] | None) -> bool:
        return old is None or new[0] < old[0] or (new[0] == old[0] and less(new[1], old[1]))

    def _insert(self) -> None:
        """Inserted turns, two at most in a row: more never pay."""
        for _ in range(2):
            for state, (to, role) in NEXT.items():
                here, there = self.best[state], self.best[to]
                if here is None or (there is not None and here[0] + INSERT > there[0]):
                    continue
                new = here[0] + INSERT, Node(here[1], "I", None, role, INSERT)
                if self._better(new, there):
                    self._hold(new[1])
                    self.best[to] = new
                    if there is not None:
                        self._let_go(there[1])

    def _certain(self) -> list[Node]:
        out = []
        while not self.root.held and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            out.append(self.root)
        return out

    def push(self, row: tuple, initial: str, must_go: bool, truncated: bool) -> list[Node]:
        self._insert()
        new: list[tuple[int, Node] | None] = [None] * 4

        def offer(to: int, cost: int, parent: Node, edit: str, role: str | None, price: int) -> None:
            if new[to] is None or cost + price <= new[to][0]:
                made = cost + price, Node(parent, edit, row, role, price)
                if self._better(made, new[to]):
                    new[to] = made

        extra = TRUNCATED if truncated else 0
        for state, here in enumerate(self.best):
            if here is None:
                continue
            cost, leaf = here
            offer(state, cost, leaf, "D", None, DELETE)
            if not must_go:
                to = MOVES.get((state, initial))
                if to is not None:
                    offer(to, cost, leaf, "K", row[2], extra)
                to, role = NEXT[state]
                offer(to, cost, leaf, "R", role, REROLE + extra)
        reach = min((new[s][0] + (INSERT if s == USER else 0) for s in (USER, ASSISTANT) if new[s]), default=None)
        for state, ahead in AHEAD.items():
            if new[state] and reach is not None and new[state][0] > reach + ahead:
                new[state] = None
        for here in new:
            if here:
                self._hold(here[1])
        for here in self.best:
            if here:
                self._let_go(here[1])
        self.best = new
        return self._certain()

    def finish(self) -> list[Node]:
        self._insert()
        chosen = None
        for state in ACCEPTS:
            if self.best[state] and self._better(self.best[state], chosen):
                chosen = self.best[state]
        out = []
        node = chosen[1]
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1]


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, blank, later (the same role and text stand at an earlier turn), truncated."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("said", F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary")))
    at = F.struct(F.col("turn").isNotNull().alias("set"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = (rows.groupBy("conv_id", "said").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1).select(F.col("conv_id").alias("first_conv"), F.col("said").alias("first_said"), "first"))
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("said") == F.col("first_said")), "left")
    return joined.select("conv_id", "turn", "role", "text",
                         (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                         F.coalesce(at > F.col("first"), F.lit(False)).alias("later"),
                         (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))


def repair(turns: DataFrame) -> DataFrame:
    """One row per edit, conversation by conversation and in order within each partition.

    conv_id, step (from 0), edit (K, R, D, I), turn and was_role (null for inserted
    turns), role (null for deleted rows), text, fault ('' for none), cost.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    ordered = faults(turns).repartition("conv_id").sortWithinPartitions(*order)

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        step = size = 0
        conv: int | None = None
        tree: Survivors | None = None
        last = None

        def add(nodes: list[Node]) -> None:
            nonlocal step, size
            for n in nodes:
                turn, was, text, fault = (n.row[1], n.row[2], n.row[3], n.row[4]) if n.row else (None, None, "", "")
                out.append((conv, step, n.edit, turn, was, n.role, text, fault, n.cost))
                n.row = None
                step, size = step + 1, size + len(text)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "blank", "later", "truncated")]
            for c, turn, role, text, blank, later, cut in zip(*columns):
                if tree is None or c != conv:
                    if tree is not None:
                        add(tree.finish())
                    conv, tree, step, last = c, Survivors(), 0, None
                again = later or last == (turn, role, text)
                last = turn, role, text
                fault = "blank" if blank else "duplicate" if again else "truncated" if cut else ""
                add(tree.push((c, turn, role, text, fault), role[:1], blank or again, fault == "truncated"))
                if len(out) >= OUT_ROWS or size >= OUT_CHARS:
                    yield _batch(out, SCHEMA_ARROW)
                    out, size = [], 0
        if tree is not None:
            add(tree.finish())
        if out:
            yield _batch(out, SCHEMA_ARROW)

    return ordered.mapInArrow(edited, SCHEMA)


def digests(edits: DataFrame) -> DataFrame:
    """Per conversation, from ``repair``'s rows as they come: gaps between turns, rows by fault, illegal
    neighbours, cost, the edits' initials, the digest of the repaired ``role:text`` lines and their number.

    Texts are hashed as they stream by; only the string of initials grows with a conversation.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, told_any = None, False
        audit: list[str] = []
        counts: dict[str, int] = {}
        distinct = illegal = cost = kept = 0
        low = high = initial = None
        digest = hashlib.sha256()

        def row() -> tuple:
            gaps = 0 if low is None else high - low + 1 - distinct
            return (conv, gaps, counts.get("blank", 0), counts.get("duplicate", 0), counts.get("truncated", 0), illegal, cost,
                    "".join(audit), digest.hexdigest(), kept)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "step", "edit", "turn", "was_role", "role", "text", "fault", "cost")]
            for c, step, edit, turn, was, role, text, fault, price in zip(*columns):
                if step == 0:
                    if told_any:
                        out.append(row())
                    if len(out) >= OUT_ROWS:
                        yield _batch(out, DIGESTS_ARROW)
                        out = []
                    conv, told_any, audit, counts = c, True, [], {}
                    distinct = illegal = cost = kept = 0
                    low = high = initial = None
                    digest = hashlib.sha256()
                audit.append(edit)
                cost += price
                if edit != "I":
                    if fault:
                        counts[fault] = counts.get(fault, 0) + 1
                    if initial is not None and initial + was[:1] not in LEGAL:
                        illegal += 1
                    initial = was[:1]
                    if turn is not None and turn != high:
                        low, high, distinct = turn if low is None else low, turn, distinct + 1
                if edit != "D":
                    digest.update(f"{chr(10) if kept else ''}{role}:{text}".encode("utf-8"))
                    kept += 1
        if told_any:
            out.append(row())
        if out:
            yield _batch(out, DIGESTS_ARROW)

    return edits.mapInArrow(told, DIGESTS)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


SCHEMA_ARROW, DIGESTS_ARROW = _arrow(SCHEMA), _arrow(DIGESTS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
