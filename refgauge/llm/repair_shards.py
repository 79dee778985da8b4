"""Token ids in grammar-compressed shards with random access.

Documents are range-partitioned by id and sorted; each task encodes its range, appends the end id
and writes blocks of some million ids. In a block, frequent pairs of neighbouring symbols are
replaced by new symbols (Re-Pair, many pairs a round): a round counts all pairs within documents,
takes those that come often enough, and replaces their occurrences from left to right, until no pair
does. A block keeps the rules, how many ids each symbol expands to, where each document starts among
the symbols, and the symbols, so any range of ids of any document can be decoded from its own symbols
and the rules that they lead to. All these numbers are stored in as many bits as the largest of a
block needs. Pairs are replaced down to `LEAST` occurrences, where a rule (two symbols and a length)
takes about as many bits as it saves.

The file format is a Parquet table with one row a block (payloads as bytes), so shards are written
and read by Spark's own committers in any store. `first_id` counts ids before a block in its part;
the totals of parts, one row each, turn that into positions in the whole.

Null texts count as empty: the end id alone. A null id sorts first. Rows with equal ids follow each
other, in the order of a digest of their text; equal rows are interchangeable. Further columns are
left out. An empty table gives no blocks and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refgauge.llm.encode import encoder, gather, small_batches
from refgauge.llm.inputs import documents_of, reachable

LEAST = 4
SHIFT = 4  # a round takes pairs with at least this power of 1/2 of the top count
BLOCKS = (
    "part bigint, block bigint, first_id bigint, n_ids bigint, base int, doc_ids array<bigint>, "
    "symbol_bits int, size_bits int, n_rules bigint, n_symbols bigint, "
    "doc_starts binary, rules binary, expansions binary, symbols binary"
)


class Grammar(NamedTuple):
    """Symbols from `base` on stand for the pair `rules[symbol - base]` and for `expansions` ids."""

    base: int
    rules: np.ndarray  # (n, 2) of 32-bit symbols
    expansions: np.ndarray  # ids per rule
    symbols: np.ndarray  # of all documents, one after the other
    starts: np.ndarray  # where each document starts in symbols, and the end


def to_bits(values: np.ndarray, width: int) -> bytes:
    """Numbers below 2**width, one after the other in `width` bits each."""
    out = []
    for at in range(0, len(values), 1 << 16):  # a multiple of 8 numbers ends with a whole byte
        part = np.ascontiguousarray(values[at : at + (1 << 16)], "<u4")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        out.append(np.packbits(bits.ravel(), bitorder="little").tobytes())
    return b"".join(out)


def from_bits(data: bytes, width: int, n: int) -> np.ndarray:
    """The `n` numbers that `to_bits` has stored."""
    out = np.empty(n, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, n, 1 << 16):
        m = min(n - at, 1 << 16)
        own = raw[at * width // 8 : -(-(at + m) * width // 8)]
        bits = np.zeros((m, 32), np.uint8)
        bits[:, :width] = np.unpackbits(own, count=m * width, bitorder="little").reshape(m, width)
        out[at : at + m] = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    return out


def replaceable(places: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Which of ascending places at which pairs stand are left when none may overlap the one before.

    following: where the symbol after each place stands.
    """
    new_run = np.concatenate([[True], places[1:] != following[:-1]])[: len(places)]
    run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(places)), 0))
    return (np.arange(len(places)) - run_start) % 2 == 0


def by_pair(left: np.ndarray, right: np.ndarray, places: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of pairs of symbols (all below `symbols`) in order, and the ascending places of each pair."""
    keys = left.astype(np.uint64) * np.uint64(symbols) + right
    bits = int(places[-1]).bit_length()
    if symbols * symbols << bits <= 1 << 64:  # both in one number: sorted faster than an order is found
        keys <<= np.uint64(bits)
        keys |= places.view(np.uint64)
        keys.sort()
        return keys >> np.uint64(bits), (keys & np.uint64((1 << bits) - 1)).view(np.int64)
    order = np.argsort(keys, kind="stable")
    return keys[order], places[order]


def compress(ids: np.ndarray, starts: np.ndarray, base: int, least: int = LEAST, rounds: int | None = None) -> Grammar:
    """The grammar of documents ids[starts[k]:starts[k + 1]]; pairs that come `least` times are frequent.

    Each round takes pairs down to a share of the commonest one's count, until no pair is frequent (or
    after `rounds`). Pairs that were not frequent never get so, but with a new symbol in them, so a
    round looks only at places where a pair was frequent or a symbol is new (`live`). Symbols keep
    their places, and know the next and the one before, until the end.
    """
    starts, n = starts.astype(np.int64), len(ids)
    symbols = np.append(ids, 0).astype(np.uint32)
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    lasts, firsts = starts[1:][starts[1:] > 0] - 1, starts[:-1][starts[:-1] < n]
    after[lasts], before[firsts], after[n] = n, n, n  # a document's last symbol pairs with nothing
    stays, live = np.ones(n + 1, bool), after < n
    rules, sizes, number = np.empty((0, 2), np.uint32), np.ones(base, np.int64), 0
    while rounds is None or number < rounds:
        number += 1
        at = np.flatnonzero(live)
        if not len(at):
            break
        keys, at = by_pair(symbols[at], symbols[after[at]], at, len(sizes))
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        counts = np.diff(edges)
        often = counts >= least
        if not often.any():
            break
        chosen = counts >= max(least, int(counts.max()) >> SHIFT)
        pairs = keys[edges[:-1][chosen]]
        places = np.sort(at[np.repeat(chosen, counts)] << 32 | np.repeat(np.arange(len(pairs)), counts[chosen]))
        places, new = places >> 32, places & 0xFFFFFFFF
        left = replaceable(places, after[places])
        kept, new = places[left], new[left]
        at = at[np.repeat(often, counts)]
        used = np.bincount(new, minlength=len(pairs)) > 0
        named = np.cumsum(used) - 1 + len(sizes)
        own = np.stack(np.divmod(pairs[used], np.uint64(len(sizes))), 1).astype(np.uint32)
        gone = after[kept]
        symbols[kept], after[kept] = named[new], after[gone]
        before[after[kept]] = kept
        stays[gone] = False
        live[:] = False
        live[at], live[kept], live[before[kept]] = True, True, True
        live[gone] = False
        live[kept[after[kept] == n]] = False
        live[n] = False
        rules = np.concatenate([rules, own])
        sizes = np.concatenate([sizes, sizes[own[:, 0]] + sizes[own[:, 1]]])
    ends = np.concatenate([[0], np.cumsum(stays[:n])])
    return Grammar(base, rules, sizes[base:].astype(np.uint32), symbols[:n][stays[:n]], ends[starts])


class Expander:
    """Decodes symbols of one grammar."""

    def __init__(self, base: int, rules: np.ndarray, expansions: np.ndarray):
        self.base, self.rules, self.expansions = base, rules.astype(np.int64), expansions.astype(np.int64)
        self.flat = None

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each symbol stands for."""
        out = np.ones(len(symbols), np.int64)
        deep = symbols >= self.base
        out[deep] = self.expansions[symbols[deep].astype(np.int64) - self.base]
        return out

    def expand_all(self) -> None:
        """The ids of every symbol, for whole blocks."""
        sizes = np.concatenate([np.ones(self.base, np.int64), self.expansions])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.flat = np.empty(int(self.ends[-1]), np.uint16 if self.base <= 1 << 16 else np.uint32)
        self.flat[: self.base] = np.arange(self.base)
        done = self.base
        while done < len(sizes):  # rules up to the first that needs one of these very rules
            rest = self.rules[done - self.base :]
            late = np.flatnonzero(rest.max(1) >= done)
            stop = done + (int(late[0]) if len(late) else len(rest))
            pairs = self.rules[done - self.base : stop - self.base].ravel()
            values, _ = gather(self.flat, self.starts[pairs], self.ends[pairs])
            self.flat[self.starts[done] : self.ends[stop - 1]] = values
            done = stop

    def ids(self, symbols: np.ndarray) -> np.ndarray:
        if self.flat is None:
            self.expand_all()
        return gather(self.flat, self.starts[symbols], self.ends[symbols])[0].astype(np.uint32)

    def ids_between(self, symbols: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Ids start:stop of a document's symbols; lengths tell which rules have to be looked at."""
        own, first = symbols.astype(np.int64), 0
        while len(own):
            sizes = self.sizes(own)
            ends = first + np.cumsum(sizes)
            inside = (ends > start) & (ends - sizes < stop)
            own, before = own[inside], (ends - sizes)[inside]
            deep = own >= self.base
            if not deep.any():
                break
            first = int(before[0])
            place = np.cumsum(np.where(deep, 2, 1)) - 1
            longer = np.empty(int(place[-1]) + 1, np.int64)
            longer[place] = own
            longer[place[deep]] = self.rules[own[deep] - self.base, 1]
            longer[place[deep] - 1] = self.rules[own[deep] - self.base, 0]
            own = longer
        return own.astype(np.uint32)


def write(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, base: int = 49408, block_ids: int = 2_000_000,
    pieces: int = 400_000,
) -> None:
    """Writes the blocks of all documents, in ascending order of ids, as a Parquet table.

    base: size of the vocabulary. block_ids: ids after which a block is closed. pieces: see `PieceEncoder`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        doc_ids, held, n, number, before = [], [], 0, 0, 0
        end = np.array([end_id], np.uint32)

        def block() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in held], np.int64)
            g = compress(np.concatenate(held), np.concatenate([[0], np.cumsum(sizes)]), base)
            width = int(max(g.symbols.max(), base + len(g.rules))).bit_length()
            size_bits = int(g.expansions.max(initial=1)).bit_length()
            row = {
                "part": part, "block": number, "first_id": before, "n_ids": n, "base": base, "doc_ids": doc_ids,
                "symbol_bits": width, "size_bits": size_bits, "n_rules": len(g.rules), "n_symbols": len(g.symbols),
                "doc_starts": to_bits(np.diff(g.starts), 32), "rules": to_bits(g.rules.ravel(), width),
                "expansions": to_bits(g.expansions, size_bits), "symbols": to_bits(g.symbols, width),
            }
            return pa.RecordBatch.from_pylist([row], SCHEMA)

        for batch in small_batches(batches):
            ids = encoder(vocabulary, True, pieces).encode(batch.column("text"))
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids):
                doc_ids.append(doc_id)
                held.append(np.concatenate([own, end]))
                n += len(own) + 1
                if n >= block_ids:
                    yield block()
                    number, before = number + 1, before + n
                    doc_ids, held, n = [], [], 0
        if held:
            yield block()

    reachable(docs.sparkSession)
    rows = documents_of(docs).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "uncompressed").parquet(path)


SCHEMA = pa.schema([
    ("part", pa.int64()), ("block", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
    ("base", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("symbol_bits", pa.int32()), ("size_bits", pa.int32()),
    ("n_rules", pa.int64()), ("n_symbols", pa.int64()), ("doc_starts", pa.binary()),
    ("rules", pa.binary()), ("expansions", pa.binary()), ("symbols", pa.binary()),
])


def opened(row: dict) -> tuple[Expander, np.ndarray, np.ndarray]:
    """The expander, symbols and document starts of a block."""
    width, n = row["symbol_bits"], row["n_rules"]
    rules = from_bits(row["rules"], width, 2 * n).reshape(-1, 2)
    expander = Expander(row["base"], rules, from_bits(row["expansions"], row["size_bits"], n))
    sizes = from_bits(row["doc_starts"], 32, len(row["doc_ids"])).astype(np.int64)
    return expander, from_bits(row["symbols"], width, row["n_symbols"]), np.concatenate([[0], np.cumsum(sizes)])


def blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def offsets(stored: DataFrame) -> DataFrame:
    """The number of ids in all parts before each: one row a part, that is a task of the writing job."""
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))


def digests(stored: DataFrame) -> DataFrame:
    """One row a document, decoded from its block: place, number and checksum of its ids.

    Payloads stay where they are read; what meets the offsets, which are broadcast, are rows of numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                expander, symbols, starts = opened(row)
                ids = expander.ids(symbols).astype("<u4", copy=False)
                before = np.concatenate([[0], np.cumsum(expander.sizes(symbols))])[starts]
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(before[:-1], before[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sums), row["part"])), pa.array(row["doc_ids"], pa.int64()),
                        pa.array(before[:-1] + row["first_id"], pa.int64()),
                        pa.array(np.diff(before), pa.int64()), pa.array(sums, pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                    ],
                    ["part", "doc_id", "first", "n_tokens", "ids_crc32", "n_symbols"],
                )

    schema = "part bigint, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint, n_symbols bigint"
    decoded = stored.mapInArrow(run, schema).join(F.broadcast(offsets(stored)), "part")
    start = (F.col("first") + F.col("offset")).alias("start")
    return decoded.select("doc_id", start, "n_tokens", "ids_crc32", "n_symbols")
