"""Documents whose sets of word n-grams have a Jaccard similarity of at least a threshold.

Which sets can link at all is found by their first n-grams by hash, of which two sets that link have
some number in common (see `leading`). Of those that any other document has among its own, each
document leaves out its commonest, one fewer than it must share; the rarest that two sets share is
never left out by either, so no link is missed, and passages that come everywhere tie nothing.
Documents tied by the rest form blocks; in a block the exact search runs.

The search is T-occurrence with DivideSkip: every document of a block, smallest first, looks up the
inverted lists of its n-grams among the smaller ones. Its short lists are merged by a heap; only
what stands in enough of them is looked for in the long lists, by binary search, until the required
overlap is reached or out of reach. Documents already in one component are not compared again.

Blocks of more than `most` documents are cut into chunks, each of documents of one class of sizes:
each chunk is searched, then some pivots of the block against each chunk, and last those pairs of
chunks of equal or neighbouring classes that still hold more than one component between them. Thus a large group of near copies costs in proportion to its size, and
nothing is left out. Documents with equal sets are searched once.

Null and empty texts and texts without words have no n-grams and link with nothing; texts of fewer
words than n have one. Rows that repeat an id are one document in the graph, linked by any of their
texts. Rows with a null id are returned with a null component. Further columns are left out. An
empty table gives an empty result. N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refgauge.llm.components import components
from refgauge.llm.encode import small_batches
from refgauge.llm.inputs import documents_of, reachable, texts_of, without
from refgauge.workspace import written

# Odd numbers that spread bits.
K1, K2, K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPARE = 1  # ranges that may be empty
MU = 0.0085  # weight of probing against merging


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits all depend on all bits of x."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * M1
        x = (x ^ (x >> np.uint64(27))) * M2
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept for short ones; emptied when they are too many."""

    limit = 100_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_hashes = WordHashes()


def grams(text: str | None, n: int = 3) -> np.ndarray:
    """The ascending hashes of the distinct word n-grams of a text, A-Z as a-z."""
    if len(_hashes) > _hashes.limit:
        _hashes.clear()
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both for ASCII only
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(codes) - n + 1, n, np.uint64) * K3
        for k in range(n):
            total = mixed(total * K1 + codes[k : len(codes) - n + 1 + k] * K2)
    return np.unique(total)


class Sizes:
    """Classes of set sizes for a threshold of `share` percent, and ranges for two neighbouring ones.

    A set links only with sets of its own class or one beside it.
    """

    def __init__(self, share: int):
        self.share = share
        self.tops = [0]

    def class_of(self, size: int) -> int:
        while self.tops[-1] < size:
            low = self.tops[-1] + 1
            self.tops.append(low * 100 // self.share)
        return bisect_left(self.tops, size)

    def ranges(self, c: int) -> int:
        """Ranges for sets of class c and c + 1."""
        while len(self.tops) <= c + 1:
            self.class_of(self.tops[-1] + 1)
        both = self.tops[c] + self.tops[c + 1]
        differ = both * (100 - self.share) // (100 + self.share)
        return differ + 1 + SPARE if differ else 1


_edges: dict[int, np.ndarray] = {}


def range_edges(n: int) -> np.ndarray:
    if n not in _edges:
        _edges[n] = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    return _edges[n]


def signatures(own: np.ndarray, sizes: Sizes) -> np.ndarray:
    """Signatures of a set: of the non-empty ranges, for its class with the next and the one before.

    Two sets that link share one. The join itself takes `leading` n-grams, which are fewer and rarer.

    If more than `SPARE` ranges are empty, the first n-grams by hash follow, as many as two sets that
    link must have one in common among.
    """
    if not len(own):
        return own
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(own + K3))])
    c, out, sparse = sizes.class_of(len(own)), [], False
    for lower in (c, c - 1):
        if lower < 1:
            continue
        n = sizes.ranges(lower)
        cuts = np.concatenate([[0], np.searchsorted(own, range_edges(n)), [len(own)]])
        filled = np.flatnonzero(cuts[1:] > cuts[:-1])
        sparse |= n > 1 and n - len(filled) > SPARE
        with np.errstate(over="ignore"):
            of_range = sums[cuts[filled + 1]] - sums[cuts[filled]]
            place = (filled.astype(np.uint64) + np.uint64(lower << 32)) * K2
        out.append(mixed(of_range ^ mixed(place)))
    if sparse:
        out.append(mixed(own[: len(own) - -(-len(own) * sizes.share // 100) + 1] ^ K2))
    return np.concatenate(out)


def leading(own: np.ndarray, share: int) -> tuple[np.ndarray, int]:
    """The first n-grams of a set by hash, and how many of them any set that links has among its own.

    With l(n) = n - ceil(share * n / 100) + 1, a set of n n-grams gives n - ceil(share * n / 100) +
    l(n). Two sets that link have ceil(share * n / 100) n-grams in common at least, n the larger size,
    so the first min(l(n), l(m)) of these are among those that either gives; the smallest m that links
    tells a set how many that is.
    """
    size = len(own)
    least = -(-share * size // 100)
    spare = size - least
    return own[: 2 * spare + 1], least - -(-share * least // 100) + 1


SIGNED = "doc_id bigint, n_shingles bigint, digest bigint, needed int, leading array<bigint>"


def signed(docs: DataFrame, n: int, share: int) -> DataFrame:
    """Every document with the size, a digest and the leading n-grams of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counts, digests, needed, found = [], [], [], []
            for text in batch.column("text").to_pylist():
                own = grams(text, n)
                counts.append(len(own))
                digests.append(int(mixed(mixed(own ^ K1).sum(keepdims=True) + np.uint64(len(own)))[0]))
                first, least = leading(own, share)
                needed.append(least)
                found.append(first.view(np.int64))
            ends = np.cumsum([0, *map(len, found)])
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(needed, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)],
                ["doc_id", "n_shingles", "digest", "needed", "leading"],
            )

    return documents_of(docs).mapInArrow(run, SIGNED)


def candidate_edges(rows: DataFrame) -> DataFrame:
    """Ties every document to the least one with which it shares a leading n-gram that neither leaves out.

    Rows that repeat an id leave out no more together than each would alone.
    """
    every = rows.select(F.col("doc_id").alias("a"), "needed", F.explode("leading").alias("gram"))

    def several(grams: DataFrame) -> DataFrame:
        counts = grams.groupBy("gram").agg(F.min("a").alias("b"), F.max("a").alias("top"), F.count(F.lit(1)).alias("times"))
        return counts.filter("b < top")

    commonest = Window.partitionBy("a", "needed").orderBy(F.col("times").desc(), "gram")
    shared = every.join(several(every).select("gram", "times"), "gram")
    rest = written(
        shared.withColumn("rank", F.row_number().over(commonest)).filter("rank >= needed").select("a", "gram"), "ties",
    )
    return rest.join(several(rest).select("gram", "b"), "gram").filter("a > b").select("a", "b").distinct()


def overlap(a: int, b: int, share: int) -> int:
    """The least intersection with which sets of these sizes link."""
    return -(-share * (a + b) // (100 + share))


class Groups:
    """Sets of places, merged as links are found."""

    def __init__(self, labels: list[int]):
        first: dict[int, int] = {}
        self.parent = [first.setdefault(label, k) for k, label in enumerate(labels)]

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k


def search(sets: list[np.ndarray], labels: list[int], sides: list[int], share: int) -> list[tuple[int, int]]:
    """Links that join what `labels` keep apart, one for each two groups that become one.

    sides: 0 for documents that are compared with all, else those of equal sides are not compared.
    """
    groups, links = Groups(labels), []
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    lengths = [len(sets[k]) for k in order]
    lists: dict[int, list[int]] = {}
    for place, k in enumerate(order):
        size, own = lengths[place], sets[k].tolist()
        required = -(-share * size // 100)  # with the smallest set that can link
        first = bisect_left(lengths, required)
        found = [x for x in map(lists.get, own) if x is not None and x[-1] >= first]
        if len(found) >= required > 0:
            found.sort(key=len)
            probes = min(required - 1, int(required / (MU * math.log2(len(found[-1]) + 1) + 1)))
            short, long = found[: len(found) - probes], found[len(found) - probes :]
            merged = heapq.merge(*(x[bisect_left(x, first) :] if x[0] < first else x for x in short))
            for other, run in groupby(merged):
                count = sum(1 for _ in run)
                j = order[other]
                if count < required - probes or sides[j] and sides[j] == sides[k]:
                    continue
                here, there = groups.find(k), groups.find(j)
                if here == there:
                    continue
                need, left = overlap(size, lengths[other], share), len(long)
                for x in long:
                    if count >= need or count + left < need:
                        break
                    left -= 1
                    at = bisect_left(x, other)
                    count += at < len(x) and x[at] == other
                if count >= need:
                    groups.parent[here] = there
                    links.append((k, j))
        for gram in own:
            lists.setdefault(gram, []).append(place)
    return links


def searched(rows: DataFrame, n: int, share: int) -> DataFrame:
    """Links (a, b) found among rows (task, side, doc_id, label, text) of the same task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(group: list[tuple]) -> pa.RecordBatch:
            found = search([x[3] for x in group], [x[2] for x in group], [x[0] for x in group], share)
            ids = [x[1] for x in group]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[a] for a, _ in found], pa.int64()), pa.array([ids[b] for _, b in found], pa.int64())],
                ["a", "b"],
            )

        task, group = None, []
        for batch in small_batches(batches):
            columns = (batch.column(c).to_pylist() for c in ("task", "side", "doc_id", "label", "text"))
            for now, side, doc_id, label, text in zip(*columns):
                if now != task and group:
                    yield links(group)
                    group = []
                task = now
                group.append((side, doc_id, label, grams(text, n)))
        if group:
            yield links(group)

    ordered = rows.repartition("task").sortWithinPartitions("task")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def relabelled(blocks: DataFrame, links: list[DataFrame]) -> DataFrame:
    """Blocks with each document's label as its component by the links found so far."""
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    own = components(every)
    return blocks.drop("label").join(own, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "block", "size", "chunk", F.coalesce("component", "doc_id").alias("label")
    )


CHUNKS = 1 << 20  # chunks of one class in a block, at most


def links_in_blocks(
    docs: DataFrame, blocks: DataFrame, n: int, share: int, most: int, pivots: int = 32
) -> list[DataFrame]:
    """Links among the documents of each block (doc_id, block, size, n_shingles); `size`: documents in it.

    Large blocks are searched in chunks of documents of one class of sizes, since only equal and
    neighbouring classes link.
    """
    tops = Sizes(share)
    tops.class_of(1 << 40)
    tops = ", ".join(f"{top}L" for top in tops.tops)
    own_class = F.expr(f"cast(size(filter(array({tops}), top -> top < n_shingles)) as bigint)")
    classed = blocks.withColumn("class", F.when(F.col("size") > most, own_class).otherwise(0))
    alike = classed.groupBy("block", "class").agg(F.count(F.lit(1)).alias("alike"))
    chunk = F.col("class") * CHUNKS + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.ceil(F.col("alike") / most))
    blocks = written(
        classed.join(alike, ["block", "class"]).select(
            "doc_id", "block", "size", chunk.alias("chunk"), F.col("doc_id").alias("label")), "blocks",
    )

    def found_among(rows: DataFrame) -> DataFrame:
        """rows: doc_id, label, block, side, and the chunks x and y that meet in a task."""
        tasks = rows.select("doc_id", "label", "side", F.struct("block", "x", "y").alias("task"))
        return written(searched(texts_of(docs, tasks), n, share), "links")

    own = blocks.select("doc_id", "label", "block", F.lit(0).alias("side"), F.col("chunk").alias("x"), F.col("chunk").alias("y"))
    links = [found_among(own)]
    large = blocks.filter(F.col("size") > most)
    if not large.head(1):
        return links

    # Pivots: the first documents of the largest components so far, against every chunk.
    now = written(relabelled(large, links), "blocks")
    members = Window.partitionBy("block").orderBy(F.col("members").desc(), "label")
    chosen = (
        now.groupBy("block", "label").agg(F.count(F.lit(1)).alias("members"))
        .withColumn("rank", F.row_number().over(members)).filter(F.col("rank") <= pivots)
        .select("block", "label", F.col("label").alias("doc_id"))
    )
    chunks = now.select("block", F.col("chunk").alias("x")).distinct()
    side = now.select("doc_id", "label", "block", F.lit(1).alias("side"), F.col("chunk").alias("x"), F.lit(-1).alias("y"))
    other = chosen.join(chunks, "block").select("doc_id", "label", "block", F.lit(2).alias("side"), "x", F.lit(-1).alias("y"))
    links.append(found_among(side.unionByName(other)))

    # Pairs of chunks that still hold more than one component.
    now = written(relabelled(large, links), "blocks")
    ends = now.groupBy("block", "chunk").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left = ends.select("block", F.col("chunk").alias("x"), "low", "high")
    right = ends.select(F.col("block").alias("block2"), F.col("chunk").alias("y"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    pairs = left.join(right, (F.col("block") == F.col("block2")) & (F.col("x") < F.col("y"))).filter(
        (F.least("low", "low2") < F.greatest("high", "high2")) & (F.floor(F.col("y") / CHUNKS) - F.floor(F.col("x") / CHUNKS) <= 1)
    ).select("block", "x", "y")
    if pairs.head(1):
        meeting = pairs.select("block", "x", "y", F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("x").alias("chunk")), F.struct(F.lit(2).alias("side"), F.col("y").alias("chunk")))).alias("at"))
        meeting = meeting.select("block", "x", "y", "at.side", "at.chunk")
        links.append(found_among(now.join(meeting, ["block", "chunk"]).select("doc_id", "label", "block", "side", "x", "y")))
    return links


def similarity_components(docs: DataFrame, n: int = 3, share: int = 90, most: int = 1000) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id.

    Two documents link when 100 * intersection >= share * union of their sets of word n-grams.
    component_id: the least doc_id that links lead to. most: documents of a block searched at once.
    """
    reachable(docs.sparkSession)
    rows = written(signed(docs, n, share), "signed")
    linkable = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    tied = components(candidate_edges(linkable))
    members = written(
        linkable.join(tied, F.col("doc_id") == F.col("node"))
        .select("doc_id", F.col("component").alias("block"), "digest", "n_shingles"), "members",
    )
    same = ["block", "digest", "n_shingles"]
    equal = members.groupBy(*same).agg(F.min("doc_id").alias("b"))
    copies = members.join(equal, same).filter("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
    single = equal.select(F.col("b").alias("doc_id"), "block", "n_shingles").distinct()
    sizes = single.groupBy("block").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    edges = copies
    for links in links_in_blocks(docs, single.join(sizes, "block"), n, share, most):
        edges = edges.unionByName(links)
    found = components(edges)
    return rows.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, n: int = 3, share: int = 90, most: int = 1000) -> DataFrame:
    """The rows of `docs`, all columns, with the least doc_id of each component only."""
    found = similarity_components(docs, n, share, most)
    return without(docs, found.filter("component_id <> doc_id").select("doc_id"))
