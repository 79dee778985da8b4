"""Best-fit packing of token pieces into sequences, by hierarchical residual packing.

Every task packs the pieces of its own documents by best fit, longest first. Bins with hardly any
room left are final. The others go on as items: they are dealt to fewer tasks, which best-fit them
into each other, and so on until one task has had all that is left or a round saves too little. A
task never gets more than `most` items, so bins that cannot be joined (each more than half full)
stay spread over tasks.

Null texts count as empty, as do empty ones: their piece is the end id alone. Rows that repeat are
packed as often as they come. Only documents longer than a sequence are cut. Ties between bins of
equal room go to the one opened last. An empty table gives an empty result. Further columns are
left out. What each round decides is written before the next round reads it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refgauge.llm.encode import encoder, small_batches
from refgauge.llm.inputs import documents_of, reachable
from refgauge.workspace import written

PIECE = np.dtype(
    [("doc_id", "<i8"), ("null_id", "?"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")]
)
BINS = "bin bigint, fill int, level int, pieces binary"


def pieces_of(doc_id: int | None, ids: np.ndarray, length: int) -> list[tuple]:
    """The pieces of a document: all of it, or cuts of `length` ids and a rest."""
    return [
        (doc_id or 0, doc_id is None, k, a, min(length, len(ids) - a), zlib.crc32(ids[a : a + length]))
        for k, a in enumerate(range(0, len(ids), length))
    ]


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of every item. Longest first; each goes where the least room remains."""
    bin_of = np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by the room they have
    rooms = 0  # bit r is set if some bin has room r
    n = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
            room -= size
        else:
            chosen, room, n = n, capacity - size, n + 1
        bin_of[item] = chosen
        if room:
            open_bins[room].append(chosen)
            rooms |= 1 << room
    return bin_of


def packed(fills: np.ndarray, blobs: list[bytes], capacity: int, level: int, first: int) -> pa.RecordBatch:
    """Items joined into bins, in the form of `BINS`."""
    bin_of = best_fit(fills, capacity)
    order = np.argsort(bin_of, kind="stable")
    n = int(bin_of.max()) + 1 if len(bin_of) else 0
    cuts = np.searchsorted(bin_of[order], np.arange(n + 1)).tolist()
    order = order.tolist()
    joined = [b"".join([blobs[i] for i in order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    sums = np.bincount(bin_of, weights=fills, minlength=n).astype(np.int32)
    base = level << 57 | TaskContext.get().partitionId() << 33
    return pa.RecordBatch.from_arrays(
        [
            pa.array(base + first + np.arange(n, dtype=np.int64)), pa.array(sums, pa.int32()),
            pa.array(np.full(n, level, np.int32)), pa.array(joined, pa.binary()),
        ],
        ["bin", "fill", "level", "pieces"],
    )


def first_bins(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, most: int, pieces: int) -> DataFrame:
    """Tokenizes documents and packs the pieces of each task, at most `most` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], np.uint32)
        held: list[tuple] = []
        made = 0

        def flush() -> pa.RecordBatch:
            table = np.array(held, PIECE)
            size = PIECE.itemsize
            data = table.tobytes()
            blobs = [data[a : a + size] for a in range(0, len(data), size)]
            return packed(table["length"].astype(np.int64), blobs, capacity, 0, made)

        for batch in small_batches(batches):
            all_ids = encoder(vocabulary, True, pieces).encode(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), all_ids):
                held += pieces_of(doc_id, np.concatenate([ids, end]), capacity)
            if len(held) >= most:
                yield flush()
                made, held = made + len(held), []
        if held:
            yield flush()

    return documents_of(docs).mapInArrow(run, BINS)


def merged_bins(bins: DataFrame, capacity: int, level: int, most: int) -> DataFrame:
    """Packs bins as items into larger bins, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fills, blobs, made = [], [], 0
        for batch in batches:
            fills += batch.column("fill").to_pylist()
            blobs += batch.column("pieces").to_pylist()
            if len(fills) >= most:
                yield packed(np.array(fills, np.int64), blobs, capacity, level, made)
                made, fills, blobs = made + len(fills), [], []
        if fills:
            yield packed(np.array(fills, np.int64), blobs, capacity, level, made)

    return bins.mapInArrow(run, BINS)


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096,
    spare: int = 8, fan_in: int = 16, most: int = 200_000, pieces: int = 150_000,
) -> DataFrame:
    """One row a piece: where it is in its document, and its sequence and place there.

    spare: bins with at most so much room are final. fan_in: tasks that meet in one of the next
    round. most: items a task packs at a time. pieces: see `PieceEncoder`.
    """
    spark = docs.sparkSession
    reachable(spark)
    level = written(first_bins(docs, vocabulary, end_id, capacity, most, pieces), "bins")
    final = [level.filter(F.col("fill") >= capacity - spare)]
    rest = level.filter(F.col("fill") < capacity - spare)
    n = rest.count()
    tasks = level.rdd.getNumPartitions()
    for number in range(1, 60):
        tasks = max(-(-n // most), min(tasks // fan_in, -(-n // 64)), 1)
        level = written(merged_bins(rest.select("bin", "fill", "level", "pieces").repartition(tasks), capacity, number, most), "bins")
        final.append(level.filter(F.col("fill") >= capacity - spare))
        rest = level.filter(F.col("fill") < capacity - spare)
        left = rest.count()
        if tasks == 1 or left > 0.98 * n:
            break
        n = left
    bins = rest
    for done in final:
        bins = bins.unionByName(done)
    return bins.mapInArrow(spread, PLACES)


PLACES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "sequence_id bigint, offset bigint"
)


def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each piece of each bin."""
    for batch in batches:
        blobs = batch.column("pieces").to_pylist()
        pieces = np.frombuffer(b"".join(blobs), PIECE)
        counts = np.array([len(b) // PIECE.itemsize for b in blobs], np.int64)
        lengths = pieces["length"].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(lengths)])
        firsts = np.cumsum(counts) - counts
        offsets = before[:-1] - np.repeat(before[firsts], counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(pieces["doc_id"], mask=pieces["null_id"]), pa.array(pieces["piece"]),
                pa.array(pieces["start"]), pa.array(lengths), pa.array(pieces["crc"].astype(np.int64)),
                pa.array(np.repeat(batch.column("bin").to_numpy(), counts)), pa.array(offsets),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )
