"""Periodic runs of words against a search through all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from edge_cases import TEXTS, documents, key
from hypothesis import given, settings
from hypothesis import strategies as st

from refgauge.llm import word_runs
from refgauge.llm.queries import QUERIES


def plain_runs(words, least=24, times=3):
    """Every run, by looking at each period over the whole sequence."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)  # periods ascend, so the smallest stays
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def looped(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = looped(doc_id, text)
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)))


def sequences(parts):
    out = []
    for letters, times, rest in parts:
        out += letters * times + letters[: rest % len(letters)]
    return out


parts = st.lists(
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 30), st.integers(0, 8)),
    min_size=1, max_size=6,
)


@settings(max_examples=300, deadline=None)
@given(st.lists(parts, min_size=1, max_size=3))
def test_runs_are_those_of_all_periods(docs):
    docs = [sequences(d) for d in docs]
    starts = np.cumsum([0, *map(len, docs)])
    ids = np.array([x for d in docs for x in d], np.int64)
    rows = word_runs.runs_in(ids, starts).tolist()
    assert [tuple(r) for r in rows] == [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d)]


def test_runs_inside_runs_and_shared_passages():
    rng = random.Random(3)
    unit = [1] * 30 + [2]
    nested = unit * 5 + [rng.randrange(50) for _ in range(40)]
    shared = [rng.randrange(9) for _ in range(12)] * 4
    docs = [nested, shared + [77] + shared, [5] * 5000, shared[3:], list(range(100)), [rng.randrange(2) for _ in range(3000)]]
    ids = np.array([x for d in docs for x in d])
    rows = word_runs.runs_in(ids, np.cumsum([0, *map(len, docs)])).tolist()
    assert [tuple(r) for r in rows] == [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d)]


def test_bounds_below_the_search_are_refused():
    with pytest.raises(ValueError):
        word_runs.runs_in(np.zeros(50, np.int64), np.array([0, 50]), least=10)


def test_query_against_all_periods(spark, sf):
    rows = QUERIES["op12_repair_runs"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, rows)) == sorted(expected(d.doc_id, d.text) for d in docs)
    assert sum(r.n_runs > 0 for r in rows) >= 5


def test_edge_cases(spark):
    loops = [(i, "a b c " * 40) for i in range(20, 60)] + [(None, "x y " * 100), (61, "z " * 100_000), (61, "z " * 30)]
    texts = TEXTS + loops
    rows = word_runs.digests(word_runs.with_looped_ends(documents(spark, texts))).collect()
    quick = [t for t in texts if len(t[1] or "") < 10_000]
    want = [expected(i, t) for i, t in quick]
    long = {i for i, t in texts if len(t or "") >= 10_000}
    got = [tuple(r) for r in rows]
    assert len(got) == len(texts)
    assert sorted((r for r in got if r in want), key=key) == sorted(want, key=key)
    assert {r[0] for r in got if r not in want} <= long
    assert word_runs.digests(documents(spark, [])).collect() == []


def test_runs_and_collapsed_texts(spark):
    row = word_runs.found(documents(spark, [(1, "start " + "one two\tthree\n" * 10 + "end")])).collect()[0]
    assert [tuple(r) for r in row.runs] == [(1, 30, 3)] and row.n_words == 32
    assert row.collapsed == "start one two three end"


def test_long_loops_take_no_time():
    import time

    began = time.process_time()
    for unit in ([1], [1, 2], list(range(50))):
        n = 300_000 // len(unit)
        assert word_runs.runs_in(np.array(unit * n), np.array([0, n * len(unit)])).tolist() == [[0, 0, n * len(unit), len(unit)]]
    assert time.process_time() - began < 20
