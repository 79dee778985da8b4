"""Exact and near duplicates against brute force over all rows and pairs."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from edge_cases import TEXTS, documents, key
from hypothesis import given, settings
from hypothesis import strategies as st

from refgauge.llm import components, content_sort, jaccard_join
from refgauge.llm.queries import ORACLES, QUERIES


def copies(texts):
    """The result of the content sort, row by row."""
    groups = defaultdict(list)
    for i, text in texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((i, len(text or "")))
    out = []
    for i, text in texts:
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[body], key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        digest = hashlib.sha256(body.encode()).hexdigest()
        out.append((i, best[0], len(groups[body]), (i, len(text or "")) == best, digest))
    return sorted(out, key=key)


@pytest.mark.parametrize("salts", [1, 3])
def test_content_sort_of_edge_cases(spark, salts):
    rows = content_sort.deduplicated(documents(spark), salts).collect()
    assert sorted(map(tuple, rows), key=key) == copies(TEXTS)
    assert content_sort.deduplicated(documents(spark, [])).collect() == []


def test_content_sort_of_one_large_group(spark):
    texts = [(k, "same  text" if k % 3 else f"other {k}") for k in range(600)]
    rows = content_sort.deduplicated(documents(spark, texts)).collect()
    assert sorted(map(tuple, rows), key=key) == copies(texts)


def test_one_of_each_keeps_all_columns(spark):
    docs = documents(spark)
    kept = content_sort.one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted((i, t) for (i, t), row in zip(TEXTS, marks(TEXTS)) if row and i is not None)
    assert sorted((r[0], r[1]) for r in kept.collect() if r[0] is not None and r[1] is not None) == [
        x for x in want if x[1] is not None
    ]


def test_one_row_of_each_group_stays(spark):
    texts = [(1, "a b"), (1, "a b"), (1, "a  b"), (2, "a b"), (None, "c"), (None, "c"), (None, " c"), (3, "d"), (3, "d"),
             (None, None), (None, ""), (None, "alone"), (3, "e"), (5, " f"), (5, "f ")] + [(None, "g h")] * 50
    docs = documents(spark, texts).repartition(7)
    rows = content_sort.deduplicated(docs).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size) for r in rows if r.kept) == [
        (0, 0, 1), (0, 0, 2), (0, 0, 3), (0, 0, 50), (1, 1, 4), (3, 3, 1), (3, 3, 2), (5, 5, 2)
    ]
    kept = content_sort.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r[0], r[1] or "") for r in kept.collect()), key=key) == sorted(
        [(1, "a  b"), (None, " c"), (3, "d"), (None, ""), (None, "alone"), (3, "e"), (5, " f"), (None, "g h")], key=key
    )


def marks(texts):
    found = {(i, d): k for i, _, _, k, d in copies(texts)}
    return [found[i, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()] for i, t in texts]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, sf, name):
    assert spark_rows(QUERIES[name](spark, sf)) == sql_rows(connect(sf), ORACLES[name])


def gram_sets(texts, n=3):
    sets = []
    for i, text in texts:
        words = (text or "").encode().lower().split()
        m = min(n, len(words))
        sets.append((i, {tuple(words[k : k + m]) for k in range(len(words) - m + 1)} if words else set()))
    return sets


def linked(texts, n=3, share=90):
    """(doc_id, set size, component) over all pairs."""
    sets = gram_sets(texts, n)
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= share * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(a), find(i) if i is not None else None) for i, a in sets), key=key)


def near_copies(seed, n=220):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    bases = [[r.choice(words) for _ in range(r.choice((3, 5, 9, 12, 20, 60, 180)))] for _ in range(18)]
    texts = []
    for i in range(n):
        doc = list(r.choice(bases) if r.random() < 0.6 else bases[0])
        for _ in range(r.choice((0, 0, 1, 1, 2, 3, 5))):
            k, what = r.randrange(len(doc)), r.random()
            if what < 0.4:
                doc[k] = r.choice(words)
            elif what < 0.7:
                doc.insert(k, r.choice(words))
            elif len(doc) > 1:
                del doc[k]
        texts.append((i * 7 % 1000, " ".join(doc)))
    return texts


def joined(spark, texts, **options):
    rows = jaccard_join.similarity_components(documents(spark, texts), **options).collect()
    return sorted(map(tuple, rows), key=key)


@pytest.mark.parametrize(("seed", "most"), [(1, 1000), (2, 9)])
def test_join_of_near_copies(spark, seed, most):
    texts = near_copies(seed)
    assert joined(spark, texts, most=most) == linked(texts)


def test_join_of_edge_cases(spark):
    assert joined(spark, TEXTS) == linked(TEXTS)
    assert joined(spark, []) == []


def test_join_with_other_lengths_and_thresholds(spark):
    texts = near_copies(5, 90)
    assert joined(spark, texts, n=2, share=75) == linked(texts, 2, 75)


def test_join_query_equals_all_pairs(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op5_jaccard_join"](spark, sf).collect())) == linked(texts)


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 60), st.data())
def test_sets_that_link_share_a_signature(size, data):
    r = random.Random(data.draw(st.integers(0, 10**9)))
    sizes = jaccard_join.Sizes(90)
    a = {r.getrandbits(64) for _ in range(size)}
    b = set(a)
    for _ in range(data.draw(st.integers(0, 8))):
        if r.random() < 0.5 and len(b) > 1:
            b.discard(r.choice(sorted(b)))
        else:
            b.add(r.getrandbits(64))
    if 100 * len(a & b) >= 90 * len(a | b):
        own = [set(jaccard_join.signatures(np.array(sorted(x), np.uint64), sizes).tolist()) for x in (a, b)]
        assert own[0] & own[1]


def test_signatures_of_sets_with_empty_ranges():
    sizes = jaccard_join.Sizes(90)
    crowded = np.arange(1, 41, dtype=np.uint64)  # all hashes in the first range
    fewer = crowded[:-2]
    shared = set(jaccard_join.signatures(crowded, sizes).tolist()) & set(jaccard_join.signatures(fewer, sizes).tolist())
    assert shared


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**9))
def test_search_finds_what_all_pairs_find(seed):
    texts = near_copies(seed, 30)
    sets = [jaccard_join.grams(t) for _, t in texts]
    links = jaccard_join.search(sets, list(range(len(sets))), [0] * len(sets), 90)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    for k, a in enumerate(sets):
        for j, b in enumerate(sets[:k]):
            same = len(np.intersect1d(a, b))
            if 100 * same >= 90 * (len(a) + len(b) - same):
                assert find(k) == find(j)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 50), (50, 70), (70, 100), (200, 200), (300, 301), (301, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components.components(df).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 50: 50, 70: 50, 100: 50, 300: 300, 301: 300}
    assert components.components(df.limit(0)).collect() == []


def test_leading_grams_of_linked_sets():
    rng = random.Random(5)
    for share in (50, 80, 90):
        for size in [*range(1, 60), 200, 500]:
            b = [rng.getrandbits(64) for _ in range(size)]
            a = b[: rng.randint(-(-share * size // 100), size)]
            a += [rng.getrandbits(64) for _ in range(rng.randint(0, size // 5))]
            if 100 * len(set(a) & set(b)) < share * len(set(a) | set(b)):
                a = b
            (x, n), (y, m) = (jaccard_join.leading(np.array(sorted(z), np.uint64), share) for z in (a, b))
            assert len(set(x.tolist()) & set(y.tolist())) >= max(n, m) > 0


def test_common_passages_tie_no_candidates(spark):
    passage = " ".join(f"common{k}" for k in range(20))
    texts = [(k, " ".join([*(f"w{k}x{j}" for j in range(80)), passage])) for k in range(1, 60)]
    texts += [(60, texts[9][1] + " more words"), (61, texts[9][1].replace("w10x3 ", "other "))]
    docs = documents(spark, texts)
    ties = jaccard_join.candidate_edges(jaccard_join.signed(docs, 5, 80)).collect()
    assert sorted(map(tuple, ties)) == [(60, 10), (61, 10)]
    rows = jaccard_join.similarity_components(docs, n=5, share=80).collect()
    assert {r.doc_id for r in rows if r.component_id != r.doc_id} == {60, 61}
