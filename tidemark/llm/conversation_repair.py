"""Conversation structure repair: depth-first branch and bound over the cheapest edits of each conversation.

A conversation is in order when the initials of its roles read `(s?(ua)+)?`: perhaps a system row, then user and
assistant in turn, ending with the assistant. Blank rows and repeated ones have to be deleted. Every other row is
kept (0), given the role user or assistant (2) or deleted (3); a row that stays although its text breaks off costs 1
more; empty rows of either role are put in anywhere (2). The cheapest list of edits is wanted, of equally cheap ones
the one whose initials (Delete, Insert, Keep, Rerole) come first in ASCII order.

`search` walks the choices depth first with an explicit stack. A prefix is given up when a table of its node (rows
read, role wanted next) holds one that is no worse, or when its cost and a lower bound of what the remaining rows
cost pass the incumbent. The bound adds up the cheapest edit of each row and 2 for each of a set of disjoint pairs of
neighbours that cannot both stay as they are. The search ends when the stack is empty: the incumbent is optimal.

Rows are shuffled once by conversation, marked where role and text occurred before, and streamed in their
order. A conversation longer than SEGMENT rows is searched a segment at a time, from the best prefix into each
of the four states to the best into each of the four: for a state the better prefix stays the better whatever
follows, as two prefixes of equal cost over the same rows never begin one another. A task so holds a segment's texts,
four lists of edits (a byte a row) and four running digests, however long the conversation is.

Defined results: a null role or text is one space, a null id is a conversation of its own, null turns come first.
Rows of equal turn are taken by role and then text. An initial is the first character of a role; only s, u and a have a
place in the order. Tables without rows give none; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What separates words, what ends a sentence, what may follow what, and what edits cost.
SPACE = " \t\n\r\x0b\x0c"
ENDS = ".!?"
NEIGHBOURS = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, BREAKS_OFF = 0, 2, 3, 2, 1

#: Rows that are searched together.
SEGMENT = 256

#: States: nothing yet, after system, after user, after assistant; the initials that may come next, and what they lead to.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
#: The initial that a new or renamed row has in each state.
FILLS = ["u", "u", "a", "u"]
NAMES = {"u": "user", "a": "assistant"}
FINAL = {EMPTY, ASSISTANT}


class Row(NamedTuple):
    initial: str
    doomed: bool
    breaks_off: bool

    @property
    def least(self) -> int:
        if self.doomed:
            return DELETE
        extra = BREAKS_OFF if self.breaks_off else 0
        return min(DELETE, (KEEP if self.initial in ("s", "u", "a") else REROLE) + extra)


class Prefix(NamedTuple):
    """The best way into a state: its cost, its edits, and the state it entered the segment with."""

    cost: int
    edits: str
    entry: int


def bounds(rows: list[Row], ends: bool) -> list[int]:
    """For each place, a lower bound of what the rows from there on cost.

    Two neighbours among the rows that need not go, neither of which may follow the other as they are, cost 2
    more than their cheapest edits: one of them changes, or a row is put between them. Pairs do not share rows.
    """
    found = [0] * (len(rows) + 1)
    base = 0
    # Most pairs from the next row that need not go, and from the one after it.
    after, further, neighbour = 0, 0, "end" if ends else None
    for place in range(len(rows) - 1, -1, -1):
        row = rows[place]
        base += row.least
        if not row.doomed:
            if row.initial not in ("s", "u", "a") or neighbour is None:
                clash = False
            elif neighbour == "end":
                clash = row.initial != "a"
            else:
                clash = row.initial + neighbour not in NEIGHBOURS
            after, further = max(after, further + clash), after
            neighbour = row.initial if row.initial in ("s", "u", "a") else None
        found[place] = base + 2 * after
    return found


def search(rows: list[Row], entries: dict[int, Prefix], goals: set[int]) -> dict[int, Prefix]:
    """The best prefix into each goal over all rows, from the best prefixes into the states before them.

    Edits in the result begin with those of the entry.
    """
    least = bounds(rows, goals == FINAL)
    tables: list[dict[int, tuple[int, str]]] = [{} for _ in range(len(rows) + 1)]
    incumbents: dict[int, Prefix] = {}
    stack = [(0, state, p.cost, p.edits, state) for state, p in sorted(entries.items(), key=lambda e: e[1][:2], reverse=True)]

    def hopeless(place: int, cost: int, edits: str) -> bool:
        """No goal can be reached from here in a better way."""
        for goal in goals:
            known = incumbents.get(goal)
            if known is None or cost + least[place] < known.cost:
                return False
            if cost + least[place] == known.cost and edits <= known.edits[: len(edits)]:
                return False
        return True

    while stack:
        place, state, cost, edits, entry = stack.pop()
        table = tables[place]
        if (state in table and table[state] <= (cost, edits)) or hopeless(place, cost, edits):
            continue
        table[state] = (cost, edits)
        if place == len(rows) and state in goals:
            known = incumbents.get(state)
            if known is None or (cost, edits) < known[:2]:
                incumbents[state] = Prefix(cost, edits, entry)
        choices = [(place, NEXT[state][FILLS[state]], INSERT, "I")]
        if place < len(rows):
            row = rows[place]
            choices.append((place + 1, state, DELETE, "D"))
            if not row.doomed:
                extra = BREAKS_OFF if row.breaks_off else 0
                choices.append((place + 1, NEXT[state][FILLS[state]], REROLE + extra, "R"))
                if row.initial in NEXT[state]:
                    choices.append((place + 1, NEXT[state][row.initial], KEEP + extra, "K"))
        # The most promising one is pushed last and so followed first.
        choices.sort(key=lambda choice: (choice[2] + least[choice[0]], choice[3]), reverse=True)
        stack.extend((then, into, cost + price, edits + edit, entry) for then, into, price, edit in choices)
    return incumbents


def lines(edits: str, state: int, rows: list[tuple[str, str]]) -> Iterator[str]:
    """`role:text` of every row that the edits leave, from a state on."""
    given = iter(rows)
    for edit in edits:
        if edit == "I":
            initial, role, text = FILLS[state], NAMES[FILLS[state]], ""
        else:
            role, text = next(given)
            if edit == "D":
                continue
            initial = FILLS[state] if edit == "R" else role[:1]
            role = NAMES[initial] if edit == "R" else role
        state = NEXT[state][initial]
        yield f"{role}:{text}"


class Digest:
    """SHA-256 of what is added, as lines."""

    def __init__(self):
        self.state, self.empty = hashlib.sha256(), True

    def copy(self) -> Digest:
        other = Digest.__new__(Digest)
        other.state, other.empty = self.state.copy(), self.empty
        return other

    def add(self, line: str) -> None:
        self.state.update(("" if self.empty else "\n").encode() + line.encode())
        self.empty = False

    def value(self) -> str:
        return self.state.hexdigest()


class Lines(Digest):
    """What is added, as lines."""

    def __init__(self):
        self.state = []

    def copy(self) -> Lines:
        other = Lines()
        other.state = list(self.state)
        return other

    def add(self, line: str) -> None:
        self.state.append(line)

    def value(self) -> str:
        return "\n".join(self.state)


@dataclass
class Conversation:
    """One conversation, read row by row."""

    conv_id: object
    output: type[Digest]
    pending: list[tuple[Row, str, str]] = field(default_factory=list)
    done: list[str] = field(default_factory=list)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    last_initial: str | None = None

    def __post_init__(self):
        self.best = {EMPTY: Prefix(0, "", EMPTY)}
        self.outputs = {EMPTY: self.output()}

    def read(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if len(self.pending) >= SEGMENT:
            self.settle({EMPTY, SYSTEM, USER, ASSISTANT})
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in NEIGHBOURS
        self.last_initial = initial
        bare = text.rstrip(SPACE)
        blank = not bare
        repeated = repeated and not blank
        breaks_off = not blank and not repeated and bare[-1] not in ENDS
        self.blank += blank
        self.duplicate += repeated
        self.truncated += breaks_off
        self.pending.append((Row(initial, blank or repeated, breaks_off), role, text))

    def settle(self, goals: set[int]) -> None:
        """Search the rows read since the last time; keep the best way into each goal."""
        found = search([row for row, _, _ in self.pending], self.best, goals)
        texts = [(role, text) for _, role, text in self.pending]
        outputs = {}
        for state, prefix in found.items():
            outputs[state] = self.outputs[prefix.entry].copy()
            for line in lines(prefix.edits[len(self.best[prefix.entry].edits) :], prefix.entry, texts):
                outputs[state].add(line)
        # What all have in common is settled.
        common = os.path.commonprefix([prefix.edits for prefix in found.values()])
        self.done.append(common)
        self.best = {s: Prefix(p.cost, p.edits[len(common) :], s) for s, p in found.items()}
        self.outputs, self.pending = outputs, []

    def result(self) -> tuple:
        self.settle(FINAL)
        state, best = min(self.best.items(), key=lambda entry: entry[1][:2])
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        gaps = min(gaps, (1 << 63) - 1)
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost)
        return self.conv_id, *counts, "".join(self.done) + best.edits, self.outputs[state].value()


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]


def _repaired(output: type[Digest]):
    def batch_of(results: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        kinds = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*results), kinds)]
        return pa.RecordBatch.from_arrays(columns, COLUMNS)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, results, id_type = None, [], None
        for batch in batches:
            id_type = batch.schema.field("conversation").type
            names = ["conversation", "turn", "role", "text", "repeated", "absent"]
            for conv_id, turn, role, text, repeated, absent in zip(*[batch.column(n).to_pylist() for n in names]):
                if current is None or conv_id != current.conv_id:
                    results += [current.result()] if current else []
                    current = Conversation(conv_id, output)
                if not absent:
                    current.read(turn, role, text, repeated)
            if len(results) >= 1000:
                yield batch_of(results, id_type)
                results = []
        results += [current.result()] if current else []
        if results:
            yield batch_of(results, id_type)

    return tasks


def repair(
    conversations: DataFrame,
    absent: Column | None = None,
    texts: bool = True,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """A row for each conversation: its faults, the cost and initials of the cheapest edits, and the repaired form.

    `repaired` holds the repaired rows as `role:text` lines, or with `texts=False` only their SHA-256, which is
    made while the rows stream by. Rows for which `absent` holds are not there, but their conversation is.
    """
    space = F.lit(" ")
    rows = conversations.select(
        F.col(id_col).alias("conversation"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"),
        F.coalesce(F.col(text_col), space).alias("text"),
        F.coalesce(F.lit(False) if absent is None else absent, F.lit(False)).alias("absent"),
    ).repartition("conversation")
    # The partitioning by conversation serves the marks too: they cost a sort, not a shuffle.
    same = Window.partitionBy("conversation", "absent", "role", "text").orderBy(F.asc_nulls_first("turn"))
    order = [F.asc_nulls_first("conversation"), F.asc_nulls_first("turn"), "role", "text"]
    marked = rows.withColumn("repeated", F.row_number().over(same) > 1).sortWithinPartitions(*order)
    longs = ", ".join(f"{name} long" for name in COLUMNS[1:7])
    schema = f"conv_id {conversations.schema[id_col].dataType.simpleString()}, {longs}, audit string, repaired string"
    return marked.mapInArrow(_repaired(Lines if texts else Digest), schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, absent: rows with faults that follow from crc32 of `conv_id:turn` modulo 20.

    0 drops the row (it is marked absent), 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4
    makes it a user's. Nulls are one space.
    """
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    names = [F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    lot = F.crc32(F.concat_ws(":", *names).cast("binary")) % 20
    return conversations.select(
        "conv_id",
        "turn",
        F.when(lot == 4, "user").otherwise(role).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (lot == 0).alias("absent"),
        F.explode(F.when(lot == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
