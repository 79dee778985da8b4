"""Conversations repaired at least cost, by weighted parsing of spans.

A conversation is sound if the initials of its roles read `(s?(ua)+)?`. The grammar is in Chomsky
normal form: a nonterminal stands for all sequences that lead from one of four states to another
(nothing yet, after s, after u, after a), and each of its rules splits a sequence at a state in
between. A span's cell holds, for every nonterminal, the least (cost, audit) of edits that make the
span one of its sequences; the audit has a letter an edit, in order. One row's cell has its own
edits (Keep, Rerole, Delete) with insertions closed over before and after; longer spans are combined
from two shorter ones, bottom-up by length. Every sequence from p to q passes some state at each
place, so any one split of a span gives its least cells: spans double in length instead of taking
all splits. Of audits with equal costs none begins another, so the least of joined ones is the join
of least ones.

Rows are sorted by range over (conversation, turn, role, text), so a long conversation is parsed in
several tasks; each reduces its part to one cell, and only cells of the first and last conversation
of a task meet again. Equal rows are counted before they are moved, and what was said before is told
by the first turn of (conversation, role, text), a table without the texts. In the end texts meet
the audits in a stream sorted by conversation, row by row. A digest reads the texts of a conversation
one after the other, so that last step has one task a conversation, in bounded memory but for the
audit.

Rows stand by turn (nulls first), then by role, the first `HEAD` characters of the text, and a digest
of it. Null roles and texts count as one blank. A null conv_id is a conversation of its own. Further
columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refgauge.llm.inputs import columns_of, reachable
from refgauge.workspace import written

HEAD = 64
SPACE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
STATES = 4
#: The state after a role's initial, by state.
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
START, SOUND = 0, (0, 3)
RULES = [(p, q, [(p * STATES + r, r * STATES + q) for r in range(STATES)]) for p in range(STATES) for q in range(STATES)]

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1  # costs; the last for each truncated row that stays

Cell = tuple  # of (cost, audit) or None, by nonterminal: state * STATES + next state


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out = []
    for _, _, splits in RULES:
        best = None
        for one, two in splits:
            a, b = left[one], right[two]
            if a is None or b is None:
                continue
            cost = a[0] + b[0]
            if best is None or cost < best[0]:
                best = (cost, a[1] + b[1])
            elif cost == best[0] and a[1] + b[1] < best[1]:
                best = (cost, a[1] + b[1])
        out.append(best)
    return tuple(out)


def cell(entries: list[tuple[int, int, int, str]]) -> Cell:
    """The least of (state, next state, cost, audit) for each nonterminal."""
    best: list = [None] * STATES**2
    for p, q, cost, audit in entries:
        k = p * STATES + q
        best[k] = min(best[k], (cost, audit)) if best[k] else (cost, audit)
    return tuple(best)


NOTHING = cell([(p, p, 0, "") for p in range(STATES)])


def insertions() -> Cell:
    """What inserted rows alone can do: their closure."""
    one = cell([(p, p, 0, "") for p in range(STATES)]
               + [(p, q, INSERT, "I") for p in range(STATES) for name, q in MOVES[p].items() if name in ROLES])
    closed = one
    while (longer := joined(closed, one)) != closed:
        closed = longer
    return closed


INSERTED = insertions()


def row_cell(initial: str, unfinished: bool) -> Cell:
    """The cell of a row that may stay."""
    more = UNFINISHED if unfinished else 0
    entries = [(p, p, DELETE, "D") for p in range(STATES)]
    for p in range(STATES):
        entries += [(p, q, KEEP + more, "K") for name, q in MOVES[p].items() if name == initial]
        entries += [(p, q, REROLE + more, "R") for name, q in MOVES[p].items() if name in ROLES]
    return joined(joined(INSERTED, cell(entries)), INSERTED)


def deleted_cell(n: int) -> Cell:
    """The cell of n rows that have to go; insertions between them are never least."""
    gone = cell([(p, p, n * DELETE, n * "D") for p in range(STATES)])
    return joined(joined(INSERTED, gone), INSERTED)


CELLS = {(i, u): row_cell(i, u) for i in ("s", "u", "a", "") for u in (False, True)}
DELETED = deleted_cell(1)


class Spans:
    """The cell of a growing sequence: cells of spans whose lengths halve from left to right."""

    def __init__(self):
        self.held: list[tuple[int, Cell]] = []

    def add(self, own: Cell) -> None:
        size = 1
        while self.held and self.held[-1][0] <= size:
            before, left = self.held.pop()
            own, size = joined(left, own), before + size
        self.held.append((size, own))

    def whole(self) -> Cell:
        out = None
        for _, own in reversed(self.held):
            out = own if out is None else joined(own, out)
        return INSERTED if out is None else out


def least(whole: Cell) -> tuple[int, str]:
    """Cost and audit of the least repair of a whole conversation."""
    return min(whole[START * STATES + q] for q in SOUND if whole[START * STATES + q])


class Part(NamedTuple):
    """What neighbouring rows of a conversation amount to. Turns are null if none is known."""

    low: int | None = None
    high: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None

    def and_then(self, other: Part) -> Part:
        clash = self.last is not None and other.first is not None and self.last + other.first not in ("su", "ua", "au")
        return Part(
            other.low if self.low is None else self.low, self.high if other.high is None else other.high,
            self.turns + other.turns - (self.high is not None and self.high == other.low),
            self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
            self.illegal + other.illegal + clash, other.first if self.first is None else self.first,
            self.last if other.last is None else other.last,
        )


def rows_part(turn: int | None, initial: str, blank: bool, cut: bool, later: bool, n: int) -> Part:
    """`n` equal rows, the first of which is a duplicate if `later`."""
    copies = 0 if blank else n if later else n - 1
    return Part(turn, turn, int(turn is not None), n if blank else 0, copies, int(not blank and not later and cut),
                n - 1, initial, initial)


class Reading:
    """One conversation, or its rows in one task, row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.part, self.spans = conv_id, Part(), Spans()

    def add(self, turn, initial, blank, cut, later, n) -> None:
        if not n:
            return
        self.part = self.part.and_then(rows_part(turn, initial, blank, cut, later, n))
        goes = n if blank or later else n - 1
        if goes < n:
            self.spans.add(CELLS[initial if initial in "sua" else "", cut])
        if goes:
            self.spans.add(DELETED if goes == 1 else deleted_cell(goes))

    def row(self, open_at: int | None) -> dict:
        """The row of a conversation; with `open_at`, of its rows in that task."""
        whole = self.spans.whole()
        cost, audit = least(whole) if open_at is None else (None, None)
        return {
            "conv_id": self.conv_id, "task": open_at, **self.part._asdict(), "cost": cost, "audit": audit,
            "costs": None if open_at is None else [x and x[0] for x in whole],
            "audits": None if open_at is None else [x and x[1] for x in whole],
        }


LONG = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
READ = pa.schema([
    ("conv_id", pa.int64()), ("task", pa.int64()), *((name, pa.int64()) for name in LONG), ("first", pa.string()),
    ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("costs", pa.list_(pa.int64())),
    ("audits", pa.list_(pa.string())),
])
READ_DDL = (
    "conv_id bigint, task bigint, " + ", ".join(f"{name} bigint" for name in LONG)
    + ", first string, last string, cost bigint, audit string, costs array<bigint>, audits array<string>"
)
AT_ONCE = 2_000  # conversations in a batch that a task gives back


def batches_of(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= AT_ONCE:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def tuples_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations of a task; its first and last one may go on in other tasks."""
    task = TaskContext.get().partitionId()

    def rows() -> Iterator[dict]:
        reading, number = None, 0
        for conv_id, *row in tuples_of(batches):
            if reading is None or conv_id != reading.conv_id:
                if reading is not None:
                    yield reading.row(None if number > 1 else task)
                reading, number = Reading(conv_id), number + 1
            reading.add(*row)
        if reading is not None:
            yield reading.row(task)

    return batches_of(rows(), READ)


def join_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of the parts that tasks have read of them, which come in order."""
    names = READ.names

    def rows() -> Iterator[dict]:
        reading = None
        for values in tuples_of(batches):
            row = dict(zip(names, values))
            if reading is None or row["conv_id"] != reading.conv_id:
                if reading is not None:
                    yield reading.row(None)
                reading, whole = Reading(row["conv_id"]), None
            reading.part = reading.part.and_then(Part(*(row[name] for name in Part._fields)))
            own = tuple(None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"]))
            whole = own if whole is None else joined(whole, own)
            reading.spans.held = [(1, whole)]
        if reading is not None:
            yield reading.row(None)

    return batches_of(rows(), READ)


def turns_of(conversations: DataFrame) -> DataFrame:
    """Columns conv_id, turn, role, text, copies: how often a row counts, 0 for one that is told of only."""
    own = columns_of(conversations, ("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))
    blank = {name: F.coalesce(name, F.lit(" ")) for name in ("role", "text")}
    return own.withColumns(blank).withColumn("copies", F.lit(1).cast("long"))


def damaged(conversations: DataFrame) -> DataFrame:
    """`turns_of` with one of five faults in one row of four, set by the crc32 of `conv_id:turn`."""
    ids = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *ids).cast("binary")) % 20
    return turns_of(conversations).withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def reports(turns: DataFrame) -> DataFrame:
    """One row a conversation: faults found, and cost and audit of its least repair.

    turns: as `turns_of` gives them.
    """
    reachable(turns.sparkSession)
    rest = F.rtrim(F.col("text"), F.lit(SPACE))
    slim = turns.select(
        "conv_id", "turn", "role", F.substring("text", 1, HEAD).alias("head"), digest(F.col("text")).alias("sha"),
        (rest == "").alias("blank"), (~F.right(rest, F.lit(1)).isin(".", "!", "?")).alias("cut"), "copies",
    )
    keys = [c for c in slim.columns if c != "copies"]
    merged = slim.groupBy(*keys).agg(F.sum("copies").alias("n"))
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    said = merged.filter("n > 0 AND NOT blank").groupBy("conv_id", "role", "sha").agg(
        F.min(place).alias("earliest"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times")
    said = said.toDF("said_in", "said_as", "said", "earliest")
    same = [F.col("conv_id").eqNullSafe(F.col("said_in")), F.col("role") == F.col("said_as"), F.col("sha") == F.col("said")]
    known = merged.join(said, same, "left").withColumn(
        "later", ~F.col("blank") & F.coalesce(place > F.col("earliest"), F.lit(False)))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "head", "sha"]
    ordered = known.repartitionByRange(*order).sortWithinPartitions(*order)
    read = written(ordered.select(
        "conv_id", "turn", F.substring("role", 1, 1), "blank", "cut", "later", "n").mapInArrow(read_task, READ_DDL), "turns")
    open_ones = read.filter("task IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "task")
    return read.filter("task IS NULL").unionByName(open_ones.mapInArrow(join_tasks, READ_DDL)).select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    )


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def meeting(turns: DataFrame, reported: DataFrame) -> DataFrame:
    """Each conversation's report, then its rows in order; conversations one after the other in a partition."""
    told = reported.select("conv_id", F.lit(0).alias("kind"), *REPORT).withColumn("copies", F.lit(0).cast("long"))
    rows = turns.filter("copies > 0").withColumn("kind", F.lit(1))
    both = told.unionByName(rows, allowMissingColumns=True)
    order = [F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role",
             F.substring("text", 1, HEAD), digest(F.col("text"))]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", *REPORT, "copies", "role", "text")


def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, report) of each conversation, then (conv_id, None, edit, role, text) of all rows it ends up with."""
    conv_id, audit, at, place, names = None, "", 0, 0, ()

    def inserted() -> Iterator[tuple]:
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            yield conv_id, None, "I", names[place % 2], ""
            at, place = at + 1, place + 1

    for own, kind, *report, copies, role, text in tuples_of(batches):
        if not kind:
            yield from inserted()
            conv_id, audit, at, place = own, report[-1], 0, 0
            even = (len(audit) - audit.count("D")) % 2 == 0
            names = ("user", "assistant") if even else ("assistant", "user")
            yield conv_id, report
            continue
        for _ in range(copies):
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit != "D":
                yield conv_id, None, edit, role if edit == "K" else names[place % 2], text
                place += 1
    yield from inserted()


def repaired(turns: DataFrame, reported: DataFrame) -> DataFrame:
    """The rows of all conversations after their repair: conv_id, place, edit (Keep, Rerole, Insert), role, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            place = 0
            for conv_id, report, *row in edits(batches):
                place = place + 1 if report is None else -1
                if report is None:
                    yield dict(zip(schema.names, (conv_id, place, *row)))

        return batches_of(rows(), schema)

    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), *((n, pa.string()) for n in ("edit", "role", "text"))])
    reachable(turns.sparkSession)
    return meeting(turns, reported).mapInArrow(run, "conv_id bigint, place bigint, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """The report of each conversation with a digest of its repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            out, sha, begun = None, hashlib.sha256(), False
            for conv_id, report, *row in edits(batches):
                if report is not None:
                    if out is not None:
                        yield out | {"repaired_sha256": sha.hexdigest()}
                    out, sha, begun = {"conv_id": conv_id, **dict(zip(REPORT, report))}, hashlib.sha256(), False
                    continue
                _, role, text = row
                sha.update(("\n" * begun + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                begun = True
            if out is not None:
                yield out | {"repaired_sha256": sha.hexdigest()}

        return batches_of(rows(), schema)

    kinds = [(name, pa.string() if name in ("audit", "repaired_sha256") else pa.int64())
             for name in ("conv_id", *REPORT, "repaired_sha256")]
    schema = pa.schema(kinds)
    ddl = ", ".join(f"{name} {'string' if kind == pa.string() else 'bigint'}" for name, kind in kinds)
    return meeting(turns, reports(turns)).mapInArrow(run, ddl)
