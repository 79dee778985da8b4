"""Repaired conversations against a search over all edits, and full charts."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from edge_cases import key

from refgauge.llm import turn_repair as tr
from refgauge.llm.queries import QUERIES

SOUND = re.compile(r"(s?(ua)+)?\Z")
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def damaged(rows):
    """(conv_id, turn, role, text) after damage, by conversation and in order."""
    found = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = found.setdefault(conv, [])
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), hashlib.sha256(r[2].encode()).digest())
    return {conv: sorted(own, key=order) for conv, own in found.items()}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(initials, marks):
    """Least (cost, audit), by best-first search over rows read and the state of the target."""
    queue, done = [(0, "", 0, 0)], set()
    while queue:
        cost, audit, i, state = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(initials) and state in (0, 3):
            return cost, audit
        for name, then in STEPS[state].items():
            if name in "ua":
                heapq.heappush(queue, (cost + 2, audit + "I", i, then))
        if i < len(initials):
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state))
            if marks[i] not in ("blank", "duplicate"):
                more = marks[i] == "truncated"
                for name, then in STEPS[state].items():
                    if name == initials[i]:
                        heapq.heappush(queue, (cost + more, audit + "K", i + 1, then))
                    if name in "ua":
                        heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, then))
    raise AssertionError


def repair(rows, audit):
    out, rest = [], list(rows)
    for edit in audit:
        role, text = (None, "") if edit == "I" else rest.pop(0)[1:]
        if edit != "D":
            out.append([edit, role, text])
    assert not rest
    roles = (["s"] if len(out) % 2 else []) + ["user", "assistant"] * (len(out) // 2)
    for own, role in zip(out, roles):
        if own[0] == "K":
            assert own[1][0] == role[0]
        else:
            own[1] = role
    assert SOUND.match("".join(o[1][0] for o in out))
    return out


def expected(rows):
    found = []
    for conv, own in damaged(rows).items():
        marks, initials = faults(own), [r[1][:1] for r in own]
        turns = [r[0] for r in own if r[0] is not None]
        cost, audit = cheapest(initials, marks)
        text = "\n".join(f"{role}:{text}" for _, role, text in repair(own, audit))
        found.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"), marks.count("duplicate"),
            marks.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        ))
    return found


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(df, rows):
    got = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_query_against_a_search(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op13_turn_repair"](spark, sf), rows)


ROLES = ["user", "assistant", "system", None, "", "moderator", "User", "sage"]
TEXTS = ["Yes.", "No", "", None, " \t\n", "What?  \n", "Well then!", "é。", "x" * 70 + ".", "x" * 70 + "!", "Yes."]


def random_rows(n, convs, seed):
    rng = random.Random(seed)
    return [
        (rng.choice([None, *range(convs)]), rng.choice([None, rng.randrange(12)]), rng.choice(ROLES[:3] if rng.random() < 0.7 else ROLES),
         rng.choice(TEXTS) if rng.random() < 0.6 else f"Some text {rng.randrange(999)}.") for _ in range(n)
    ]


SCHEMA = "conv_id long, turn long, role string, text string, Text string, n long, kind string, sha string, copies string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", None, "k", "s", "c") for r in rows], SCHEMA)


@pytest.mark.parametrize("n, convs, seed", [(600, 90, 1), (500, 4, 2), (0, 1, 3)])
def test_edge_cases(spark, n, convs, seed):
    rows = random_rows(n, convs, seed)
    check(tr.digests(tr.damaged(table(spark, rows))), rows)


def test_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    rows = [(7, k // 2, rng.choice(ROLES[:3]), f"Turn {rng.randrange(900)}" + rng.choice([".", ""])) for k in range(1500)]
    rows += [(8, 1, "user", "Same.")] * 400 + [(9, None, "assistant", "Same.")] * 300
    read = tr.damaged(table(spark, rows).repartition(6))
    check(tr.digests(read), rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Hello."), (1, 2, "user", "More"), (2, 0, "assistant", "Only this.")]
    turns = tr.turns_of(table(spark, rows))
    reported = tr.reports(turns)
    got = [tuple(r) for r in tr.repaired(turns, reported).orderBy("conv_id", "place").collect()]
    assert got == [
        (1, 0, "K", "user", "Hello."), (1, 1, "R", "assistant", "More"),
        (2, 0, "I", "user", ""), (2, 1, "K", "assistant", "Only this."),
    ]


def all_splits(cells):
    """The cell of a whole sequence from a chart of all its spans, with every split."""
    chart = {(i, i + 1): c for i, c in enumerate(cells)}
    for size in range(2, len(cells) + 1):
        for i in range(len(cells) - size + 1):
            parts = [tr.joined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)]
            chart[i, i + size] = tuple(min((p[n] for p in parts if p[n]), default=None) for n in range(16))
    return chart[0, len(cells)]


def test_one_split_is_as_good_as_all():
    rng = random.Random(11)
    for _ in range(40):
        cells = [rng.choice([*tr.CELLS.values(), tr.DELETED]) for _ in range(rng.randrange(1, 9))]
        spans = tr.Spans()
        for own in cells:
            spans.add(own)
        assert spans.whole() == all_splits(cells)
