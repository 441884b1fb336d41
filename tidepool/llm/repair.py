"""Repairs the order of turns in conversations at the least cost, by survivor-coalescence Viterbi.

A conversation should read: a system turn or none, then user and assistant in turns, ending with
an assistant. Each row is kept, given another role or deleted, and empty turns may be inserted;
the cheapest edits win, and of equally cheap ones those whose initials come first in ASCII.

The search goes row by row. Of all ways that lead to a state (what the repaired turns end
with) only the best survives, so there are four survivors at most. Their steps form a tree of
backpointers with reference counts: a step without a survivor below it is freed, and as soon as all
survivors descend from one step, this step is certain and is handed on. What is held are the
steps since the survivors parted, not the conversation.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.llm.common import fresh

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: State after a turn with this initial, by the state before.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What it costs at most to go on from the second state with what the first would do: a survivor
#: that costs more than another by more than this can neither win nor tie.
BEYOND = {
    START: {SYSTEM: 2 * INSERT, USER: INSERT + DELETE, ASSISTANT: DELETE},
    SYSTEM: {START: 0, USER: INSERT, ASSISTANT: 0},
    USER: {START: INSERT, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {START: 0, SYSTEM: 2 * INSERT, USER: INSERT},
}
#: Inserts that end a conversation, by state.
ENDING = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
SPACES = " \t\n\x0b\x0c\r"


def _inserted(state: int) -> list[tuple[int, str]]:
    """(state, initials) of the turns that may be inserted; more would come back to a state."""
    out = [(state, "")]
    for initials in ("u", "a", "ua"):
        now = state
        for initial in initials:
            now = AFTER[initial].get(now)
            if now is None:
                break
        if now not in {s for s, _ in out} | {None}:
            out.append((now, initials))
    return out


@functools.cache
def steps(initial: str, bad: bool, truncated: bool) -> tuple[dict[int, tuple], ...]:
    """By state before and state after: (cost, edits, initials inserted before, new initial) of the
    cheapest way over a row. The new initial is that of the row's role, its own if kept, '' if deleted."""
    out = []
    for state in STATES:
        best: dict[int, tuple] = {}
        for middle, put in _inserted(state):
            cost, edits = INSERT * len(put), "I" * len(put)
            ways = [(middle, cost + DELETE, edits + "D", put, "")]
            if not bad:
                cost += TRUNCATED * truncated
                if middle in AFTER.get(initial, ()):
                    ways.append((AFTER[initial][middle], cost, edits + "K", put, initial))
                ways += [(AFTER[new][middle], cost + REROLE, edits + "R", put, new) for new in "ua" if middle in AFTER[new]]
            for after, *way in ways:
                best[after] = min(best.get(after, tuple(way)), tuple(way))
        out.append(best)
    return tuple(out)


class Tree:
    """Steps with a pointer back to the step before, counted by what points to them."""

    def __init__(self) -> None:
        # step 0 is no step, 1 is the one before the first row
        self.back, self.refs, self.below = array("q", [0, 0]), array("q", [0, 1]), array("q", [0, 0])
        self.step: list = [None, None]
        self.free: list[int] = []
        self.root = 1

    def grow(self, back: int, step: tuple) -> int:
        """A new step that a survivor holds."""
        if self.free:
            node = self.free.pop()
            self.back[node], self.refs[node], self.below[node], self.step[node] = back, 1, 0, step
        else:
            node = len(self.step)
            self.back.append(back)
            self.refs.append(1)
            self.below.append(0)
            self.step.append(step)
        self.refs[back] += 1
        self.below[back] ^= node
        return node

    def release(self, node: int) -> None:
        """A survivor lets go of a step; steps that nothing points to any more are freed."""
        self.refs[node] -= 1
        while not self.refs[node] and node != self.root:
            back = self.back[node]
            self.below[back] ^= node  # the steps below, joined by exclusive or: a single one is itself
            self.refs[back] -= 1
            self.step[node] = None
            self.free.append(node)
            node = back

    def certain(self) -> Iterator[tuple]:
        """The steps that all survivors share, which leave the tree."""
        while self.refs[self.root] == 1 and self.below[self.root]:
            node = self.below[self.root]
            self.step[self.root] = None
            self.free.append(self.root)
            self.root = node
            yield self.step[node]

    def rest(self, node: int) -> list[tuple]:
        """The steps down to ``node`` that haven't been handed on."""
        out = []
        while node != self.root:
            out.append(self.step[node])
            node = self.back[node]
        return out[::-1]


class Walk:
    """One conversation, row by row.

    The survivors hold different edits that end with the same row, so none begins with
    another's: how they compare is settled where they part and stays so, whatever follows. Ranks carry the
    order of the whole unresolved suffixes along, so ties are decided on all of them.
    The digest of a survivor's repaired text goes with it; texts need not be held for it.
    """

    def __init__(self, rows: bool) -> None:
        self.tree = Tree()
        #: state -> (cost, rank, step, digest, whether there is a line)
        self.best = {START: (0, 0, 1, hashlib.sha256(), False)}
        self.audit = bytearray()
        self.counts = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        self.turns = [None, None, 0]  # least, greatest, different
        self.before = None
        self.longest = 0
        self.waiting: deque | None = deque() if rows else None
        self.out: list[tuple] = []

    def row(self, turn: int | None, role: str, text: str, duplicate: bool) -> None:
        initial = role[:1]
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        if self.before is not None:
            self.counts[3] += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        shown = text.rstrip(SPACES)
        blank, truncated = not shown, not shown.endswith((".", "!", "?"))
        fault = 0 if blank else 1 if duplicate else 2 if truncated else None
        if fault is not None:
            self.counts[fault] += 1
        ways = steps(initial, blank or duplicate, fault == 2)
        if self.waiting is not None:
            self.waiting.append((turn, role, text))
        found: dict[int, tuple] = {}
        for state, held in self.best.items():
            for after, way in ways[state].items():
                key = (held[0] + way[0], held[1], way[1])
                if after not in found or key < found[after][0]:
                    found[after] = key, state, way
        found = {s: x for s, x in found.items()
                 if not any(s != t and x[0][0] > y[0][0] + BEYOND[s][t] for t, y in found.items())}
        order = sorted(found, key=lambda s: found[s][0][1:])
        own = text.encode("utf-8", "surrogatepass")
        best = {}
        for rank, after in enumerate(order):
            (cost, _, _), state, way = found[after]
            _, _, node, digest, begun = self.best[state]
            _, _, put, new = way
            if put or new:
                digest = digest.copy()
                lines = [f"{NAMES[i]}:".encode() for i in put]
                if new:
                    lines.append((role if way[1].endswith("K") else NAMES[new]).encode("utf-8", "surrogatepass") + b":" + own)
                digest.update((b"\n" if begun else b"") + b"\n".join(lines))
                begun = True
            best[after] = cost, rank, self.tree.grow(node, way), digest, begun
        for held in self.best.values():
            self.tree.release(held[2])
        self.best = best
        for step in self.tree.certain():
            self._hand_on(step)
        self.longest = max(self.longest, len(self.tree.step) - len(self.tree.free) - 2)

    def _hand_on(self, step: tuple) -> None:
        _, edits, put, new = step
        self.audit += edits.encode()
        if self.waiting is not None:
            turn, role, text = self.waiting.popleft()
            self.out += [(None, NAMES[i], "", "I") for i in put]
            if new:
                self.out.append((turn, role if edits.endswith("K") else NAMES[new], text, edits[-1]))

    def finish(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest, most steps held)."""
        state = min(self.best, key=lambda s: (self.best[s][0] + INSERT * len(ENDING[s]), self.best[s][1]))
        cost, _, node, digest, begun = self.best[state]
        for step in self.tree.rest(node):
            self._hand_on(step)
        put = ENDING[state]
        if put:
            digest = digest.copy()
            digest.update((b"\n" if begun else b"") + b"\n".join(f"{NAMES[i]}:".encode() for i in put))
            self.audit += b"I" * len(put)
            if self.waiting is not None:
                self.out += [(None, NAMES[i], "", "I") for i in put]
        least, most, different = self.turns
        gaps = 0 if least is None else most - least + 1 - different
        return (gaps, *self.counts, cost + INSERT * len(put), self.audit.decode(), digest.hexdigest(), self.longest)


SUMMARY = ("id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string, held long")
REPAIRED = "id long, place long, turn long, role string, text string, edit string"
#: Rows that are handed on together.
TOGETHER = 4096


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [part.split(" ") for part in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _walked(rows_too: bool) -> Callable:
    """Goes through sorted rows; yields a summary for each conversation, or its repaired rows."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = REPAIRED if rows_too else SUMMARY
        name, walk, place, done = None, None, 0, []

        def take(last: bool) -> None:
            nonlocal place
            end = walk.finish() if last else None
            if rows_too:
                for row in walk.out:
                    done.append((name, place, *row))
                    place += 1
                walk.out = []
            elif last:
                done.append((name, *end))

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for own, turn, role, text, gone, duplicate in zip(*columns):
                if walk is None or own != name:
                    if walk is not None:
                        take(True)
                    name, walk, place = own, Walk(rows_too), 0
                if not gone:
                    walk.row(turn, role, text, duplicate)
                if len(walk.out) >= TOGETHER:
                    take(False)
                if len(done) >= TOGETHER:
                    yield _batch(done, schema)
                    done = []
        if walk is not None:
            take(True)
        if done:
            yield _batch(done, schema)

    return of


def _in_order(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, gone_col: str | None) -> DataFrame:
    """Conversations in order, with the rows whose role and text an earlier row has.

    The one shuffle is by conversation; it serves the search for duplicates as well. Both go by in
    sorted order, so a conversation of any length needs no memory of its size.
    """
    own = rows.select(
        F.col(conv_col).cast("long").alias("id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        (F.coalesce(F.col(gone_col), F.lit(False)) if gone_col else F.lit(False)).alias("gone"),
    ).repartition("id")
    same = Window.partitionBy("id", "gone", "role", F.sha2("text", 256)).orderBy("turn")
    return (own.withColumn("duplicate", F.row_number().over(same) > 1)
            .sortWithinPartitions("id", "turn", "role", "text", "duplicate"))


def repairs(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", gone_col: str | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the digest of the repaired turns.

    Rows are taken by turn (NULL first), then role and text. A NULL role or text counts as one
    space; rows with a NULL conversation are one conversation. Rows for which ``gone_col`` is true
    are no turns and only name their conversation: without turns it has zeros, no edits
    and the digest of nothing. No rows give no rows. ``gaps`` are numbers missing between the least
    and the greatest turn. A row is blank, else a duplicate (role and text of an earlier row), else
    truncated (its last sign isn't one of ``.!?``). ``audit`` holds the initials of Keep,
    Rerole, Delete and Insert, ``repaired_sha256`` is that of the lines ``role:text``, and ``held`` the
    most steps that were uncertain at a time.
    """
    return _in_order(rows, conv_col, turn_col, role_col, text_col, gone_col).mapInArrow(_walked(False), SUMMARY)


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", gone_col: str | None = None) -> DataFrame:
    """(id, place, turn, role, text, edit): the turns of the repaired conversations, in order by ``place``.

    Inserted turns have no number and no text. Rows come out as soon as their edit is certain;
    the texts of rows that aren't certain yet are held.
    """
    return _in_order(rows, conv_col, turn_col, role_col, text_col, gone_col).mapInArrow(_walked(True), REPAIRED)


def damaged(rows: DataFrame, kinds: int = 20) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults by the crc32 of ``conv_id:turn``, and ``gone``.

    Of ``kinds`` remainders 0 drops the row (``gone``), 1 empties the text, 2 removes its ends of
    sentences, 3 repeats the row and 4 makes it a user's. NULLs count as one space.
    """
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = fresh(rows, "kind")
    marked = rows.withColumn(kind, F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % kinds)
    copies = F.explode(F.when(F.col(kind) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    text = (F.when(F.col(kind) == 1, "").when(F.col(kind) == 2, F.regexp_replace(shown("text"), "[.!?]", ""))
            .otherwise(shown("text")))
    role = F.when(F.col(kind) == 4, "user").otherwise(shown("role"))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col(kind) == 0).alias("gone"),
                         copies.alias("copy")).drop("copy")
