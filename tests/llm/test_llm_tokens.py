"""Token shards, packing and byte-level BPE against the libraries themselves."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from edge_cases import TEXTS, documents, key
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from refgauge.llm import byte_bpe, encode, packing, repair_shards
from refgauge.llm.queries import QUERIES, vocabulary
from refgauge.workspace import new_path

WORDS = vocabulary("word_bpe_49k.json")
BYTES = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def ranks():
    with open(vocabulary("byte_bpe_50k.tiktoken"), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab.,'st!% \n\t \x1cÉéß漢😀0|<>"), max_size=30), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    import pyarrow as pa

    for path, word_level in ((WORDS, True), (BYTES, False)):
        own = encode.encoder(path, word_level)
        want = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in own.encode(pa.array(texts, pa.string()))] == want


def test_words_of_letters_skip_normalizer_and_pattern(words):
    import pyarrow as pa

    own = encode.PieceEncoder(WORDS, True)
    seen = []
    whole, own.tokenizer = own.tokenizer, type("Seen", (), {
        "encode_batch_fast": lambda self, pieces, **options: seen.extend(pieces) or whole.encode_batch_fast(pieces, **options)
    })()
    letters = [chr(k) for k in range(1 << 16) if encode.LETTERS.fullmatch(chr(k))]
    pieces = [a + b for a in letters[::7] for b in letters[::1789]] + letters
    others = ["", "×", "÷", "É", "a1", "ab.", "don't", "e\u0301", "ǆ", "x" * 3 + "$"]
    codes = [own.learn(p, encode.keys_of(pa.array(p, pa.large_string()))) for p in (pieces, others)]
    assert seen == others
    want = [e.ids for e in words.encode_batch([*pieces, *others], add_special_tokens=False)]
    assert [own.ids[own.ends[c] : own.ends[c + 1]].tolist() for c in np.concatenate(codes)] == want


def test_pieces_are_told_apart_by_all_their_bytes(monkeypatch):
    import pyarrow as pa

    pieces = ["", "a", "a\0", "\0", "ab" * 4, "ab" * 4 + "\0", "é" * 23, "é" * 23 + "a", "x" * 48, "y" * 500]
    cut = pa.array(["before", *pieces], pa.large_string()).slice(1)
    keys = encode.keys_of(cut)
    assert len({tuple(k) for k in keys.tolist()}) == 8 and not keys[[0, -2, -1]].any()
    monkeypatch.setattr(encode, "SLOT_BITS", 2)  # pieces take each other's place
    own = encode.PieceEncoder(WORDS, True)
    texts = [" ".join(pieces[k % 7 + 1 :]) for k in range(50)]
    want = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(3):
        assert [x.tolist() for x in own.encode(pa.array(texts))] == want


def test_pairs_in_order_with_their_places():
    r = np.random.default_rng(5)
    left, right, places = r.integers(0, 9, 500), r.integers(0, 9, 500), np.sort(r.permutation(900)[:500])
    for symbols in (9, 1 << 30):  # beyond 64 bits for number and place together
        keys, at = repair_shards.by_pair(left.astype(np.uint32), right.astype(np.uint32), places, symbols)
        rows = sorted(zip((left * symbols + right).tolist(), places.tolist()))
        assert list(zip(keys.tolist(), at.tolist())) == rows


def test_cache_that_overflows_changes_nothing(words):
    import pyarrow as pa

    own = encode.PieceEncoder(WORDS, True, limit=20)
    for k in range(6):
        texts = [f"some words {k} again some words. {n}{k}" for n in range(30)]
        want = [e.ids for e in words.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in own.encode(pa.array(texts))] == want


def test_pieces_that_come_back_stay_in_the_cache():
    import pyarrow as pa

    own, seen = encode.PieceEncoder(WORDS, True, limit=20), []
    learn = own.learn
    own.learn = lambda pieces, keys: seen.extend(pieces) or learn(pieces, keys)
    for k in range(12):
        fresh = " ".join(f"w{k}w{n}" for n in range(8))
        own.encode(pa.array([f"{fresh} one{'' if k % 3 else ' two three'}"]))
    assert own.n_codes <= 40 and all(seen.count(p) == 1 for p in ("one", "two", "three"))


def shard_rows(spark, docs, **options):
    path = new_path(spark, "test-shards")
    repair_shards.write(docs, path, WORDS, **options)
    stored = repair_shards.blocks(spark, path)
    return stored, [tuple(r)[:4] for r in repair_shards.digests(stored).collect()]


def test_shards_of_edge_cases(spark, words):
    stored, rows = shard_rows(spark, documents(spark), block_ids=1000)
    assert stored.count() > 3
    sums = {}
    for i, text in TEXTS:
        ids = ids_of(words, text, 2)
        sums.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for i, start, n, crc in sorted(rows, key=lambda r: r[1]):
        assert start == at
        sums[i].remove((n, crc))
        at += n
    assert not any(sums.values())
    assert [key(r[:1]) for r in sorted(rows, key=lambda r: r[1])] == sorted(
        (key((i,)) for i, _ in TEXTS), key=lambda k: (not k[0][0], k)
    )


def test_shards_of_no_documents(spark):
    assert shard_rows(spark, documents(spark, []))[1] == []


def test_any_range_of_a_document_can_be_read_alone(spark):
    stored, _ = shard_rows(spark, documents(spark))
    own = encode.encoder(WORDS, True)
    import pyarrow as pa

    by_id = {7: None}
    for row in stored.collect():
        expander, symbols, starts = repair_shards.opened(row.asDict())
        for k, i in enumerate(row.doc_ids):
            if i == 7:
                by_id[7] = (expander, symbols[starts[k] : starts[k + 1]])
    expander, symbols = by_id[7]
    ids = np.append(own.encode(pa.array([dict(TEXTS)[7]]))[0], 2)
    assert len(symbols) < len(ids) / 3  # the text repeats itself
    for a, b in ((0, 1), (0, len(ids)), (17, 17), (12345, 12399), (len(ids) - 2, len(ids))):
        assert expander.ids_between(symbols, a, b).tolist() == ids[a:b].tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=60), min_size=1, max_size=5))
def test_grammar_expands_to_its_ids(docs):
    flat = np.array([x for d in docs for x in d], np.uint32)
    starts = np.cumsum([0, *map(len, docs)])
    g = repair_shards.compress(flat, starts, 5, least=2, rounds=4)
    expander = repair_shards.Expander(g.base, g.rules, g.expansions)
    for k, d in enumerate(docs):
        assert expander.ids(g.symbols[g.starts[k] : g.starts[k + 1]]).tolist() == d


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.integers(0, 300), st.randoms())
def test_bits(width, n, r):
    values = np.array([r.randrange(1 << width) for _ in range(n)], np.uint32)
    data = repair_shards.to_bits(values, width)
    assert len(data) == -(-n * width // 8) and repair_shards.from_bits(data, width, n).tolist() == values.tolist()
    long = np.resize(values, 200_001) if n else values
    assert np.array_equal(repair_shards.from_bits(repair_shards.to_bits(long, width), width, len(long)), long)


def test_shards_are_smaller_than_plain_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = new_path(spark, "test-shards")
    repair_shards.write(docs.coalesce(1), path, WORDS)
    ids, size = repair_shards.blocks(spark, path).selectExpr("sum(n_ids)", "sum(" + " + ".join(
        f"length({c})" for c in ("doc_starts", "rules", "expansions", "symbols")) + ")").first()
    assert size < 0.75 * 2 * ids


def test_ranges_look_only_at_rules_they_meet():
    r = np.random.default_rng(8)
    flat = np.tile(r.integers(0, 50, 997), 30).astype(np.uint32)
    g = repair_shards.compress(flat, np.array([0, len(flat)]), 50)
    expander = repair_shards.Expander(g.base, g.rules, g.expansions)
    for a, b in ((0, 5), (996, 1001), (12_345, 12_346), (7, 29_910), (100, 100), (29_900, 99_999)):
        assert expander.ids_between(g.symbols, a, b).tolist() == flat[a:b].tolist()
    assert expander.flat is None  # nothing was expanded for them as a whole
    wide = repair_shards.Expander(100_000, np.array([[99_999, 70_000]]), np.array([2]))
    assert wide.ids(np.array([100_000, 5])).tolist() == [99_999, 70_000, 5]


def most_common_pair(g):
    pairs = Counter()
    for a, b in zip(g.starts[:-1], g.starts[1:]):
        own = g.symbols[a:b].tolist()
        pairs.update(zip(own[:-1], own[1:]))
    return max(pairs.values(), default=0)


def test_no_frequent_pair_is_left():
    r = np.random.default_rng(3)
    text, passage = r.integers(0, 900, 700), r.integers(0, 900, 150)
    docs = [text] * 40 + [np.concatenate([r.integers(0, 900, 60), passage, r.integers(0, 900, 31)]) for _ in range(50)]
    docs += [np.zeros(5000, int), r.integers(0, 12, 20_000)]
    flat, starts = np.concatenate(docs).astype(np.uint32), np.cumsum([0, *map(len, docs)])
    g = repair_shards.compress(flat, starts, 900)
    assert most_common_pair(g) < repair_shards.LEAST
    assert set(np.diff(g.starts)[:40]) == {1}  # a copy is one symbol
    assert repair_shards.Expander(g.base, g.rules, g.expansions).ids(g.symbols).tolist() == flat.tolist()


def test_rules_are_not_limited_to_16_bit_symbols():
    pairs = np.arange(14_000, dtype=np.uint32)  # 7,000 frequent pairs beside a vocabulary of 60,000
    flat, starts = np.tile(pairs, 16), np.arange(0, 16 * len(pairs) + 1, 2)
    g = repair_shards.compress(flat, starts, 60_000)
    assert len(g.rules) == 7000 and len(g.symbols) == 16 * 7000
    assert repair_shards.Expander(g.base, g.rules, g.expansions).ids(g.symbols).tolist() == flat.tolist()


def check_packing(rows, texts, tokenizer, capacity):
    want, sequences = {}, {}
    for i, text in texts:
        ids = ids_of(tokenizer, text, 1)
        for k, a in enumerate(range(0, len(ids), capacity)):
            piece = ids[a : a + capacity]
            want.setdefault((i, k, a, len(piece), zlib.crc32(piece.tobytes())), []).append(1)
    for r in rows:
        want[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)].pop()
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert not any(want.values())
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_edge_cases(spark, words):
    rows = packing.pack(documents(spark).repartition(5), WORDS, capacity=64, most=40).collect()
    check_packing(rows, TEXTS, words, 64)
    assert packing.pack(documents(spark, []), WORDS).collect() == []


def test_packing_is_tight(spark, sf, words):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = packing.pack(docs.repartition(12), WORDS, capacity=512, spare=2).collect()
    n = check_packing(rows, texts, words, 512)
    sizes = np.array([r.length for r in rows])
    assert n <= 1.02 * (packing.best_fit(sizes, 512).max() + 1)  # all pieces in one task


def test_best_fit_takes_the_least_room():
    sizes = np.array([6, 5, 4, 3, 2])
    bins = packing.best_fit(sizes, 10).tolist()
    assert bins == [0, 1, 0, 1, 1]


def test_byte_bpe_of_edge_cases(spark, ranks):
    rows = byte_bpe.digests(documents(spark), BYTES).collect()
    want = []
    for i, text in TEXTS:
        ids = np.array(ranks.encode_ordinary(text or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((tuple(r)[:4] for r in rows), key=key) == sorted(want, key=key)
    assert byte_bpe.digests(documents(spark, []), BYTES).collect() == []


def test_offsets_and_decoding(spark, ranks):
    texts = [(i, t) for i, t in TEXTS if i in (5, 12, 13, 18)]
    tokens = byte_bpe.encoded(documents(spark, texts), BYTES)
    assert {r.doc_id: r.text for r in byte_bpe.decoded(tokens, BYTES).collect()} == dict(texts)
    for row in tokens.collect():
        text, at = dict(texts)[row.doc_id], 0
        for i, offset in zip(row.ids, row.offsets):
            assert len(text.encode()[:at].decode("utf-8", "ignore")) == offset
            at += len(ranks.decode_single_token_bytes(i))


def test_queries_cover_all_documents(spark, sf, words, ranks):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    at, want = 0, []
    for i, text in docs:
        ids = ids_of(words, text, 2)
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r)[:4] for r in QUERIES["op1_repair_shards"](spark, sf).collect()) == want
    check_packing(QUERIES["op2_best_fit_packing"](spark, sf).collect(), docs, words, 4096)
    for r in QUERIES["op8_byte_bpe"](spark, sf).collect():
        ids = np.array(ranks.encode_ordinary(dict(docs)[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
