"""Repair of the turn structure of conversations (operator 13).

The cheapest edits that give a conversation the order of roles ``(s?(ua)+)?`` are found by
a Viterbi search over four states: nothing said yet, after a system message, after a user's,
after an assistant's. The survivors of the states share a tree of back pointers whose nodes
count their references: a replaced survivor frees what only it used, and as soon as
all survivors have an ancestor in common, the edits up to it are final and leave the tree.
So memory holds the unresolved suffixes only, whatever the conversation's length. Of equally
cheap ways the one with the least edit string wins; for that the complete unresolved
suffixes are compared, back to their common ancestor.

Spark deals the rows out by conversation, marks the repeated ones, and sorts them by turn;
a task reads them as a stream. The order of edits and the hash over a conversation make
its search sequential, so a hot conversation is one long stream, with sorts that
spill and bounded memory, and no group is ever gathered.

Edits and their costs: ``K`` keep 0; ``R`` make it a user's or assistant's 3; ``D`` delete 4,
the only one for blank and duplicate rows; ``I`` insert an empty user's or assistant's
message 3. A truncated row that is not deleted costs 3 more.

Defined results: a null role or text is one space; rows go by turn, nulls first, rows of one
turn by role, then text; a row with an empty role, or one that begins with another letter than
s, u or a, cannot be kept as it is; a null ``conv_id`` is a conversation like any other;
columns other than conv_id, turn, role and text are not read, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import table_batches

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
FAULTS = ("blank", "duplicate", "truncated")
MADE_ROLES = {"u": "user", "a": "assistant"}

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
# state after a message whose role begins with the letter
MOVES = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}

_ROWS = "conv_id long, turn long, role string, text string, repeated boolean"
_EDITS = "conv_id long, place long, edit string, role string, text string"
_SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


class Row(NamedTuple):
    """One message and its first fault, if any."""

    role: str
    text: str
    fault: str | None


class Edit(NamedTuple):
    """What is done, and the message that comes of it; a deleted one has none."""

    kind: str
    role: str | None = None
    text: str | None = None


class _Node:
    """An edit after another; in use while survivors hold it or other edits go on from it."""

    __slots__ = ("before", "edit", "after", "held", "depth")

    def __init__(self, before: _Node | None, edit: Edit | None):
        self.before, self.edit = before, edit
        self.after: set[_Node] = set()
        self.held = 0
        self.depth = 0
        if before:
            self.depth = before.depth + 1
            before.after.add(self)


def _released(node: _Node) -> None:
    """One survivor less at a node; a node that nothing uses frees those before it too."""
    node.held -= 1
    while node is not None and not node.held and not node.after:
        before, node.before = node.before, None
        if before is not None:
            before.after.discard(node)
        node = before


def _suffixes(one: _Node, other: _Node) -> tuple[str, str]:
    """The edits of both that come after their last common node."""
    left: list[str] = []
    right: list[str] = []
    while one is not other:
        if one.depth >= other.depth:
            left.append(one.edit.kind)
            one = one.before
        else:
            right.append(other.edit.kind)
            other = other.before
    return "".join(reversed(left)), "".join(reversed(right))


class Repairer:
    """Survivors of one conversation; edits come out as soon as they are final."""

    def __init__(self):
        root = _Node(None, None)
        root.held = 1
        self._root = root
        self._alive: dict[int, tuple[int, _Node]] = {START: (0, root)}
        self.cost = 0

    def unresolved(self) -> int:
        """Edits between the last final one and the longest survivor's end."""
        return max(node.depth for _, node in self._alive.values()) - self._root.depth

    def add(self, row: Row) -> Iterator[Edit]:
        """Take the next row; gives the edits that became final."""
        self._insert()
        reached: dict[int, tuple[int, _Node]] = {}
        for state, (cost, node) in self._alive.items():
            self._offer(reached, state, cost + COSTS[DELETE], node, Edit(DELETE))
            if row.fault in ("blank", "duplicate"):
                continue
            extra = TRUNCATED_COST if row.fault == "truncated" else 0
            for initial, then in MOVES[state].items():
                if row.role[:1] == initial:
                    edit = Edit(KEEP, row.role, row.text)
                    self._offer(reached, then, cost + COSTS[KEEP] + extra, node, edit)
                elif initial in MADE_ROLES:
                    edit = Edit(REROLE, MADE_ROLES[initial], row.text)
                    self._offer(reached, then, cost + COSTS[REROLE] + extra, node, edit)
        for _, node in self._alive.values():
            _released(node)
        self._alive = reached
        self._forget_hopeless()
        yield from self._final()

    def end(self) -> Iterator[Edit]:
        """All edits still open, after the last row; ``cost`` is known then."""
        self._insert()
        for state in [s for s in self._alive if s not in ENDS]:
            _released(self._alive.pop(state)[1])
        while len(self._alive) > 1:
            (_, first), (state, second) = list(self._alive.items())[:2]
            worse = state if self._better(*first, *second) else next(iter(self._alive))
            _released(self._alive.pop(worse)[1])
        ((self.cost, _),) = self._alive.values()
        yield from self._final()

    def _better(self, cost: int, node: _Node, other_cost: int, other: _Node) -> bool:
        if cost != other_cost:
            return cost < other_cost
        one, two = _suffixes(node, other)
        return one < two

    def _offer(
        self, to: dict[int, tuple[int, _Node]], state: int, cost: int, before: _Node, edit: Edit
    ) -> bool:
        """Let a way into a state survive there if it is the best so far."""
        known = to.get(state)
        if known and known[0] < cost:
            return False
        node = _Node(before, edit)
        node.held = 1
        if known and not self._better(cost, node, *known):
            _released(node)
            return False
        if known:
            _released(known[1])
        to[state] = cost, node
        return True

    def _insert(self) -> None:
        """Let survivors reach other states by inserted messages, until nothing improves."""
        changed = True
        while changed:
            changed = False
            for state in list(self._alive):
                for initial, then in MOVES[state].items():
                    if initial in MADE_ROLES:
                        cost, node = self._alive[state]
                        edit = Edit(INSERT, MADE_ROLES[initial], "")
                        cost += COSTS[INSERT]
                        changed |= self._offer(self._alive, then, cost, node, edit)

    def _forget_hopeless(self) -> None:
        """Drop survivors that cannot win: another does what they can for less.

        After an assistant's message all may follow that may follow a system's, and all that
        may follow nothing but a system message, which could be deleted instead.
        """
        if ASSISTANT in self._alive:
            bound = self._alive[ASSISTANT][0]
            for state, more in ((START, COSTS[DELETE]), (SYSTEM, 0)):
                if state in self._alive and self._alive[state][0] > bound + more:
                    _released(self._alive.pop(state)[1])

    def _final(self) -> Iterator[Edit]:
        """Take from the tree what lies before the survivors' last common ancestor."""
        root = self._root
        while not root.held and len(root.after) == 1:
            child = root.after.pop()
            child.before = None
            yield child.edit
            root = child
        self._root = root


def repaired(rows: Iterable[Row]) -> Iterator[Edit]:
    """The cheapest edits of one conversation, in order, each as soon as it is final."""
    repairer = Repairer()
    for row in rows:
        yield from repairer.add(row)
    yield from repairer.end()


# --- rows in order ----------------------------------------------------------------------


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def in_turn_order(conversations: DataFrame) -> DataFrame:
    """Rows of each conversation beside each other, by turn, repeated ones marked.

    One shuffle of the rows by conversation; whether role and text came before is asked
    by a running number, which needs a sort in the task and no memory.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _text("role").alias("role"),
        _text("text").alias("text"),
    )
    dealt = rows.withColumn("digest", F.xxhash64("role", "text")).repartition("conv_id")
    same = Window.partitionBy("conv_id", "digest", "role", "text").orderBy(
        F.col("turn").asc_nulls_first()
    )
    marked = dealt.select(
        "conv_id", "turn", "role", "text", (F.row_number().over(same) > 1).alias("repeated")
    )
    return marked.sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(),
        F.col("turn").asc_nulls_first(),
        "role",
        "text",
        "repeated",
    )


_WHITE = " \t\n\x0b\x0c\r"


def fault_of(text: str, repeated: bool) -> str | None:
    """A row's first fault."""
    said = text.rstrip(_WHITE)
    if not said:
        return "blank"
    if repeated:
        return "duplicate"
    return None if said[-1] in ".!?" else "truncated"


class _Counts:
    """What a summary counts while a conversation passes."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0
        self.faults = dict.fromkeys(FAULTS, 0)
        self.initial: str | None = None

    def add(self, turn: int | None, row: Row) -> None:
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.turns += 1
        if row.fault:
            self.faults[row.fault] += 1
        initial = row.role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _streams(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[_Counts, Repairer, Iterator[Edit]]]:
    """Each conversation with its edits as a stream, to be read before the next is asked for."""
    lists = ((c.to_pylist() for c in batch.columns) for batch in batches)
    rows = (row for columns in lists for row in zip(*columns, strict=True))
    ahead = next(rows, None)

    def edits(counts: _Counts, repairer: Repairer) -> Iterator[Edit]:
        nonlocal ahead
        while ahead is not None and ahead[0] == counts.conv_id:
            _, turn, role, text, repeated = ahead
            row = Row(role, text, fault_of(text, repeated))
            counts.add(turn, row)
            yield from repairer.add(row)
            ahead = next(rows, None)
        yield from repairer.end()

    while ahead is not None:
        counts, repairer = _Counts(ahead[0]), Repairer()
        yield counts, repairer, edits(counts, repairer)


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for counts, repairer, edits in _streams(batches):
        sha, audit, first = hashlib.sha256(), [], True
        for edit in edits:
            audit.append(edit.kind)
            if edit.role is not None:
                sha.update(b"" if first else b"\n")
                sha.update(f"{edit.role}:{edit.text}".encode())
                first = False
        yield (
            counts.conv_id,
            counts.gaps(),
            *(counts.faults[f] for f in FAULTS),
            counts.illegal,
            repairer.cost,
            "".join(audit),
            sha.hexdigest(),
        )


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for counts, _, edits in _streams(batches):
        for place, edit in enumerate(edits):
            yield counts.conv_id, place, edit.kind, edit.role, edit.text


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _mapped(
    rows: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], ddl: str
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
        yield from table_batches(make(batches), _arrow_schema(ddl), size)

    return rows.mapInArrow(partial(run, size=2_000), ddl)


def repair_edits(conversations: DataFrame) -> DataFrame:
    """Every edit of every conversation in order: ``conv_id, place, edit, role, text``.

    The rows with a role are the repaired conversation.
    """
    return _mapped(in_turn_order(conversations), _edits, _EDITS)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost, the edits and a hash of the repair."""
    return _mapped(in_turn_order(conversations), _summary, _SUMMARY)
