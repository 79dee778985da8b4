"""Quality scores by supervised subword embeddings.

Learned vectors stand in a table that is found into by hashing: one for every word, for every n-gram of
a word's bytes between boundary marks, for every n-gram of words (`WORD_GRAMS`) and for every n-gram of
the first characters of words (`INITIAL_GRAMS`), which are few enough to be known from other words. The mean
of all of them in a document, and of `PRIOR` vectors of zero that keep short texts from extremes, goes
through a softmax over the two classes. Vectors and softmax are trained by stochastic gradient descent in numpy
on a bounded, documented sample of the labelled rows (`sample` of them, by smallest hash of the id),
from whole texts, in one task; the driver gets the model alone.

With two classes the difference of their logits is linear in the mean, so for scoring each table
entry is reduced to one number, and each distinct word to the sum and number of its entries and to
its two hashes; a document's score is then the softmax of one mean. Only text is an input of a score.

A label counts as 1 or 0; rows with a null label, a null id or a held-out id teach nothing. Texts
without words (null too) have the score of the bias alone. An id with several labels teaches each
of them. Without any label the score is 0.5. Rows that repeat give repeated results. Further columns
are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refgauge.llm.encode import give_back, small_batches
from refgauge.llm.inputs import columns_of, documents_of, mapped, reachable, remainder

BUCKETS = 1 << 15
SHORTEST, LONGEST = 2, 4
WORD_GRAMS, INITIAL_GRAMS = (2, 3), (2, 3, 4, 5)
SAMPLE = 4_000
PRIOR = 60
AT_ONCE = 1 << 20  # bytes of text that are scored together


class Bag(NamedTuple):
    label: int
    entries: bytes
    counts: bytes


class Model(NamedTuple):
    """value[b]: what entry b adds to the logit of label 1 against label 0; bias: that of no entry."""

    value: np.ndarray
    bias: float


# Odd numbers that spread bits, one for each length of n-grams.
SPREAD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
MIX = np.uint64(SPREAD[0])


def entries(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The table entries of words and of their n-grams of bytes, and for each entry its word's place."""
    n = len(words)
    marked = np.frombuffer(b"".join([b"<" + word + b">" for word in words]), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, n) + 2
    owner = np.repeat(np.arange(n), sizes)
    found = [np.fromiter(map(zlib.crc32, words), np.int64, n) % buckets]
    places = [np.arange(n)]
    running = marked
    for length in range(2, LONGEST + 1):
        if len(marked) < length:
            break
        # The bytes so far and one more, as one number; none reaches into another word.
        running = running[:-1] << np.uint64(8) | marked[length - 1 :]
        inner = owner[: len(running)] == owner[length - 1 :]
        mixed = running[inner] * np.uint64(SPREAD[length - 2])
        if length >= SHORTEST:
            found.append(((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64))
            places.append(owner[: len(running)][inner])
    return np.concatenate(found), np.concatenate(places)


def hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and of its first character (a whole one, of up to four bytes)."""
    first = [w[: 1 + (w[0] >= 0xC0) + (w[0] >= 0xE0) + (w[0] >= 0xF0)] for w in words]
    return tuple(np.fromiter(map(zlib.crc32, own), np.uint64, len(own)) for own in (words, first))


def gram_entries(
    own: np.ndarray, initial: np.ndarray, owner: np.ndarray, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the table entries of n-grams inside documents, and the document of each.

    own, initial: the hashes of all words, one after the other. owner: the document of each word.
    """
    for kind, (tokens, lengths) in enumerate(((own, WORD_GRAMS), (initial, INITIAL_GRAMS))):
        running = tokens
        for n in range(2, max(lengths) + 1):
            if len(tokens) < n:
                break
            running = (running[:-1] ^ running[:-1] >> np.uint64(31)) * MIX + tokens[n - 1 :]
            if n in lengths:
                inside = owner[: len(running)] == owner[n - 1 :]
                mixed = (running[inside] + np.uint64(kind)) * MIX
                yield ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64), owner[: len(running)][inside]


def bag(text: str | None, buckets: int) -> np.ndarray:
    """How often each table entry comes in a text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    total = np.bincount(entries(words, buckets)[0], minlength=buckets)
    for found, _ in gram_entries(*hashes(words), np.zeros(len(words), np.int64), buckets):
        total += np.bincount(found, minlength=buckets)
    return total


def bags(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (label, entries, counts): how often each table entry comes in a document."""
    if buckets > 1 << 16:
        raise ValueError("table entries are stored in 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            ids, counts = [], []
            for text in batch.column("text").to_pylist():
                total = bag(text, buckets)
                used = np.flatnonzero(total)
                ids.append(used.astype("<u2").tobytes())
                counts.append(total[used].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                ["label", "entries", "counts"],
            )

    return docs.mapInArrow(run, "label int, entries binary, counts binary")


def train(
    rows: list, buckets: int, size: int = 8, epochs: int = 8, batch: int = 128, rate: float = 0.5, seed: int = 7
) -> Model:
    """Vectors and softmax from bags with labels, by gradient descent over shuffled mini-batches."""
    if not rows:
        return Model(np.zeros(buckets, np.float32), 0.0)
    random = np.random.default_rng(seed)
    labels = np.array([row.label for row in rows])
    ids = [np.frombuffer(row.entries, "<u2") for row in rows]
    shares = [(c := np.frombuffer(row.counts, "<f4")) / (c.sum() + PRIOR) for row in rows]
    vectors = (random.random((buckets, size), np.float32) - 0.5) / size
    softmax, bias = np.zeros((size, 2), np.float32), np.zeros(2, np.float32)
    # Sparse bags as dense rows of one mini-batch at a time.
    steps, step = epochs * -(-len(rows) // batch), 0
    speed_v, speed_w = np.zeros(buckets, np.float32) + 1e-8, np.zeros((size, 2), np.float32) + 1e-8
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), batch):
            own = order[at : at + batch]
            x = np.zeros((len(own), buckets), np.float32)
            for k, i in enumerate(own):
                x[k, ids[i]] = shares[i]
            hidden = x @ vectors
            logits = hidden @ softmax + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), labels[own]] -= 1
            p /= len(own)
            slope_w, slope_v = hidden.T @ p, x.T @ (p @ softmax.T)
            # Steps are scaled by past slopes, as rare entries otherwise hardly move.
            speed_w += slope_w**2
            speed_v += (slope_v**2).mean(1)
            pace = rate * (1 - step / steps)
            softmax -= pace * slope_w / np.sqrt(speed_w)
            vectors -= pace * slope_v / np.sqrt(speed_v)[:, None]
            bias -= pace * 0.2 * p.sum(0)
            step += 1
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def learned(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS, held_out: int = 5
) -> Model:
    """A model of labels.quality from at most `sample` labelled rows that are not held out.

    The sample is what has the smallest hashes of ids; its ids, no more than `sample`, are broadcast.
    """
    reachable(docs.sparkSession)
    known = columns_of(labels, ("doc_id", "bigint"), ("quality", "int"))
    chosen = (
        known.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(remainder(F.col("doc_id"), held_out) != 0)
        .withColumnRenamed("quality", "label")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    )
    rows = documents_of(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Bag(*row) for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
        # Training must not depend on the order in which rows come.
        model = train(sorted(found, key=lambda r: (r.entries, r.counts, r.label)), buckets)
        yield pa.RecordBatch.from_arrays([pa.array([model.value.tobytes()]), pa.array([model.bias])], ["value", "bias"])
        del found
        give_back()

    one = bags(rows, buckets).repartition(1).mapInArrow(fit, "value binary, bias double").collect()
    return Model(np.frombuffer(one[0].value, np.float32), one[0].bias) if one else train([], buckets)


class Scorer:
    """Scores of texts; what each word adds to the logit, and its number of entries, is kept."""

    def __init__(self, model: Model, limit: int = 80_000):
        self.model, self.limit = model, limit
        self.forget()

    def forget(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.sums, self.counts = np.empty(0), np.empty(0)
        self.own, self.initial = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def learn(self, words: list[bytes]) -> None:
        found, places = entries(words, len(self.model.value))
        n = len(words)
        self.sums = np.concatenate([self.sums, np.bincount(places, self.model.value[found], n)])
        self.counts = np.concatenate([self.counts, np.bincount(places, minlength=n)])
        own, initial = hashes(words)
        self.own, self.initial = np.concatenate([self.own, own]), np.concatenate([self.initial, initial])
        self.codes.update(zip(words, range(len(self.codes), len(self.codes) + n)))

    def scores(self, texts: pa.Array) -> np.ndarray:
        split = [(text or "").encode("utf-8", "surrogatepass").split() for text in texts.to_pylist()]
        if len(self.codes) > self.limit:
            self.forget()
        fresh = list(set().union(*split).difference(self.codes))
        if fresh:
            self.learn(fresh)
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        codes = np.fromiter((c for words in split for c in map(self.codes.__getitem__, words)), np.int64, lengths.sum())
        place = np.repeat(np.arange(len(split)), lengths)
        total = np.bincount(place, self.sums[codes], len(split))
        n = np.bincount(place, self.counts[codes], len(split))
        value = self.model.value
        for found, owner in gram_entries(self.own[codes], self.initial[codes], place, len(value)):
            total, n = total + np.bincount(owner, value[found], len(split)), n + np.bincount(owner, minlength=len(split))
        return 1 / (1 + np.exp(-(total / (n + PRIOR) + self.model.bias)))


def scored(docs: DataFrame, model: Model, threshold: float = 0.3, held_out: int = 5) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    reachable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of the size of its table of entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in small_batches(batches, most=AT_ONCE):
            found = pa.array(scorer.scores(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    rows = documents_of(docs).mapInArrow(run, "doc_id bigint, score double")
    return rows.select(
        "doc_id", (remainder(F.col("doc_id"), held_out) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores at least `threshold`."""
    reachable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(places: dict[str, int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer, place = Scorer(shared.value), places["text"]
            for batch in small_batches(batches, f"c{place}", AT_ONCE):
                yield batch.filter(pa.array(scorer.scores(batch.column(place)) >= threshold))

        return run

    return mapped(docs, make)
