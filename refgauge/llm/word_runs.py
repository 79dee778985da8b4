"""Periodic runs of words, found in the grammar of the texts.

The words of a batch of documents are numbered and replaced by a grammar (Re-Pair: pairs of
neighbouring symbols that come at least twice in the batch become one symbol, until none is left).
What is left of a document is put under a balanced tree, so every two neighbouring words of it meet
at the boundary of one node. Runs that cross the boundary of a node lie in the node's own words, so
they are computed once for each symbol of the grammar, wherever it stands, and once for each node of
the trees above. They are then translated to all places at which a symbol stands in a derivation. A
run that goes on past the end of a symbol was seen whole at a node higher up; intervals inside
another one of the same period are parts of it and are merged into it.

At a boundary the periods to try are distances to equal stretches of `GRAM` words at or before it:
a run of at least 24 words and three periods agrees with itself, one period on, over 16 words or
more around its boundary, so 8 of them stand on one side. How far two places agree is found with
numbers given to all stretches of 1, 2, 4, .. words, which are equal only if the stretches are.
Documents in which no stretch of `GRAM` words comes twice have no runs and need no grammar.

A run is a stretch of at least `least` consecutive words and `times` periods, of smallest period q
(words q apart are equal), that no neighbouring word extends. Words are what stands between
characters of [\\x20\\x09-\\x0D], compared as they are. Null and empty texts, and those of white
space, have no words and no runs. Rows with null or equal ids are kept apart and give results of
their own; further columns are left out. An empty table gives an empty result. Memory goes with the
longest text, not with the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refgauge.llm.encode import small_batches
from refgauge.llm.inputs import SPACE, documents_of, reachable
from refgauge.llm.repair_shards import compress

LEAST, TIMES = 24, 3
GRAM, GRAM_LEVEL = 8, 3  # words of a stretch by which periods are found, as a power of two
MIX = np.uint64(0x9E3779B97F4A7C15)
AT_ONCE = 1 << 21  # candidates compared at a time


def repeated_grams(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks documents in which a stretch of `GRAM` words seems to come twice; it misses none."""
    marks = np.zeros(len(starts) - 1, bool)
    if len(ids) < GRAM:
        return marks
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    hashed = (ids.astype(np.uint64) + np.uint64(1)) * MIX
    for step in (1, 2, 4):
        hashed = (hashed[:-step] ^ hashed[:-step] >> np.uint64(29)) * MIX + hashed[step:]
    inside = owner[: len(hashed)] == owner[GRAM - 1 :]
    own = owner[: len(hashed)][inside]
    hashed = hashed[inside] ^ own.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(hashed)
    again = hashed[order[1:]] == hashed[order[:-1]]
    marks[own[order[1:]][again]] = True
    return marks


def ranks_of(ids: np.ndarray, longest: int) -> list[np.ndarray]:
    """[k][i]: a number for the 2^k words from i on, equal for equal words; up to where none is."""
    found = [np.unique(ids, return_inverse=True)[1].astype(np.int32)]
    while (step := 1 << len(found) - 1) * 2 <= longest:
        last = found[-1].astype(np.int64)
        values, rank = np.unique(last[:-step] * (int(last.max()) + 1) + last[step:], return_inverse=True)
        found.append(rank.astype(np.int32))
        if len(values) == len(rank) and len(found) > GRAM_LEVEL:
            break
    return found


def agreement(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """For how many words, `most` at most, the places a and b agree: from them on, or before them."""
    done = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        size, rank = 1 << k, ranks[k]
        fits = np.flatnonzero(done + size <= most)
        shift = -done[fits] - size if back else done[fits]
        done[fits[rank[a[fits] + shift] == rank[b[fits] + shift]]] += size
    return done


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts 2, 0, 3: owners 0 0 2 2 2 and numbers 0 1 0 1 2."""
    owners = np.repeat(np.arange(len(counts)), counts)
    return owners, np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)


def crossing_runs(
    ranks: list[np.ndarray], low: np.ndarray, middle: np.ndarray, high: np.ndarray, least: int, times: int
) -> tuple[np.ndarray, ...]:
    """Runs inside low:high that cross the place `middle`, of many nodes: (node, start, end, period)."""
    grams = ranks[GRAM_LEVEL].astype(np.int64)
    n = len(ranks[0]) + 1
    keys = grams * n + np.arange(len(grams))
    keys.sort()
    nodes = np.concatenate([np.arange(len(low))] * 2)
    places = np.concatenate([middle, middle - GRAM])
    fits = (places >= low[nodes]) & (places + GRAM <= high[nodes])
    nodes, places = nodes[fits], places[fits]
    reach = (high - low)[nodes] // times
    first = np.searchsorted(keys, grams[places] * n + np.maximum(low[nodes], places - reach))
    last = np.searchsorted(keys, grams[places] * n + np.minimum(high[nodes] - GRAM, places + reach), "right")
    more = last - first > 1
    nodes, places, first, counts = nodes[more], places[more], first[more], (last - first)[more]
    found = [np.empty((4, 0), np.int64)]
    ends = np.cumsum(counts)
    cut = 0
    while cut < len(nodes):
        stop = max(cut + 1, int(np.searchsorted(ends, ends[cut] - counts[cut] + AT_ONCE, "right")))
        owner, number = spread(counts[cut:stop])
        other = keys[first[cut:stop][owner] + number] % n
        period = np.abs(other - places[cut:stop][owner])
        pairs = np.unique(nodes[cut:stop][owner] * n + period)
        node, period = pairs // n, pairs % n
        node, period = node[period > 0], period[period > 0]
        for place in (middle[node], middle[node] - period):
            inside = (place >= low[node]) & (place + period <= high[node])
            own, q, at = node[inside], period[inside], place[inside]
            start = at - agreement(ranks, at, at + q, at - low[own], True)
            end = at + q + agreement(ranks, at, at + q, high[own] - at - q, False)
            ok = (end - start >= np.maximum(least, times * q)) & (start < middle[own]) & (middle[own] < end)
            found.append(np.stack([own[ok], start[ok], end[ok], q[ok]]))
        cut = stop
    node, start, end, period = np.concatenate(found, 1)
    order = np.lexsort((period, end, start, node))  # of equal intervals the smallest period counts
    node, start, end, period = node[order], start[order], end[order], period[order]
    fresh = np.ones(len(node), bool)
    fresh[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[fresh], start[fresh], end[fresh], period[fresh]


def runs_in(ids: np.ndarray, starts: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (document, start, length, period) of all runs of documents ids[starts[k]:starts[k + 1]].

    `least` is at least 16 + `GRAM`, `times` at least 3, for which the search of periods is whole.
    """
    if least < 16 + GRAM or times < 3:
        raise ValueError("runs are found from 24 words and three periods on")
    if len(ids) < least:
        return np.empty((0, 4), np.int64)
    starts = starts.astype(np.int64)
    base = int(ids.max()) + 1
    grammar = compress(ids, starts, base, least=2)
    rules = grammar.rules.astype(np.int64)
    sizes = np.concatenate([np.ones(base, np.int64), grammar.expansions.astype(np.int64)])
    symbols = grammar.symbols.astype(np.int64)
    place = np.concatenate([[0], np.cumsum(sizes[symbols])])

    # All places at which large symbols stand, from what is left of the documents downwards.
    own, at, standing = symbols, place[:-1], []
    while len(own):
        large = sizes[own] >= least
        own, at = own[large], at[large]
        standing.append(np.stack([own, at]))
        pair = rules[own - base]
        own, at = np.concatenate([pair[:, 0], pair[:, 1]]), np.concatenate([at, at + sizes[pair[:, 0]]])
    own, at = np.concatenate([np.empty((2, 0), np.int64), *standing], 1)
    order = np.argsort(own, kind="stable")
    own, at = own[order], at[order]
    names, first, counts = np.unique(own, return_index=True, return_counts=True)

    # Nodes: a symbol at its first place, and the boundaries between symbols that are left.
    number = np.arange(len(symbols)) - np.repeat(grammar.starts[:-1], np.diff(grammar.starts))
    stop = np.repeat(grammar.starts[1:], np.diff(grammar.starts))
    inner = np.flatnonzero(number)
    half = number[inner] & -number[inner]
    low = np.concatenate([at[first], place[inner - half]])
    middle = np.concatenate([at[first] + sizes[rules[names - base, 0]], place[inner]])
    high = np.concatenate([at[first] + sizes[names], place[np.minimum(inner + half, stop[inner])]])
    once = np.concatenate([counts, np.ones(len(inner), np.int64)])
    source = np.concatenate([first, np.zeros(len(inner), np.int64)])
    large = high - low >= least
    low, middle, high, once, source = (x[large] for x in (low, middle, high, once, source))
    named = np.flatnonzero(large) < len(names)

    ranks = ranks_of(ids, int(np.diff(starts).max()))
    node, start, end, period = crossing_runs(ranks, low, middle, high, least, times)
    owner, copy = spread(once[node])
    moved = np.zeros(len(owner), np.int64)
    symbol = named[node][owner]
    moved[symbol] = at[source[node][owner][symbol] + copy[symbol]] - low[node][owner][symbol]
    start, end, period = start[owner] + moved, end[owner] + moved, period[owner]

    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    so_far = np.maximum.accumulate(period * (len(ids) + 1) + end)
    whole = np.ones(len(end), bool)
    whole[1:] = period[1:] * (len(ids) + 1) + end[1:] > so_far[:-1]
    start, end, period = start[whole], end[whole], period[whole]
    doc = np.searchsorted(starts, start, "right") - 1
    rows = np.stack([doc, start - starts[doc], end - start, period], 1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Marks the words that no run (start, length, period) contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def found(docs: DataFrame) -> DataFrame:
    """One row a document: its runs by start and period, and its words without what runs repeat.

    Columns doc_id, n_words, runs (start, length, period; numbers of words) and collapsed, the words
    joined by a blank but for those that a run contains after its first period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column("text").to_pylist()]
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            flat = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode()
            ids = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            doubtful = np.flatnonzero(repeated_grams(ids, starts))
            rows = np.empty((0, 4), np.int64)
            if len(doubtful):
                own = np.concatenate([ids[starts[k] : starts[k + 1]] for k in doubtful])
                own = np.unique(own, return_inverse=True)[1]
                rows = runs_in(own, np.concatenate([[0], np.cumsum(lengths[doubtful])]))
                rows[:, 0] = doubtful[rows[:, 0]]
            bounds = np.searchsorted(rows[:, 0], np.arange(len(words) + 1))
            for k in np.unique(rows[:, 0]):
                stays = kept_words(len(words[k]), rows[bounds[k] : bounds[k + 1], 1:])
                words[k] = [words[k][i] for i in np.flatnonzero(stays)]
            runs = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in (1, 2, 3)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths), pa.ListArray.from_arrays(bounds.astype(np.int32), runs),
                 pa.array([b" ".join(own).decode("utf-8", "surrogatepass") for own in words], pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    reachable(docs.sparkSession)
    return documents_of(docs).mapInArrow(
        run, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
        "collapsed string")


def with_looped_ends(docs: DataFrame) -> DataFrame:
    """The documents, one in ten of them ending in a loop that the crc32 of its id sets.

    Let h be that number (null id: of empty text) and g = h div 10. If h is a multiple of 10, each word
    from a = g mod n on becomes one of the p words there, in turn; p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.expr(rf"filter(split(text, r'{SPACE}'), x -> x <> '')")
    looped = documents_of(docs).select("doc_id", "text", (h % 10 == 0).alias("loops"), F.expr("1L").alias("n"))
    g = F.floor(h / 10)
    looped = looped.withColumn("g", g).withColumn("w", F.when(F.col("loops"), words)).withColumn("n", F.size("w").cast("long"))
    looped = looped.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    text = F.expr("concat_ws(' ', transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p as int)])))")
    return looped.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def exponent_above(one: Column, other: Column) -> Column:
    return one["length"] * other["period"] > other["length"] * one["period"]


def digests(docs: DataFrame) -> DataFrame:
    """One row a document: number of runs, the one of the greatest exponent, digests of all and of what is kept."""
    best = F.aggregate("runs", F.col("runs")[0], lambda top, r: F.when(exponent_above(r, top), r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.when(F.size("runs") > 0, best).alias("best"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
