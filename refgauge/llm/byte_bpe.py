"""Byte-level BPE encoding and decoding.

The tokenizers library encodes over Arrow batches. Its tokens are texts over 256 printable
characters, one for each byte; the inverse of that mapping gives the bytes of every id, from which
token offsets come and with which ids are decoded. A character of several bytes may be split over
tokens; decoding joins bytes, not characters, so such characters come back whole.

Null texts count as empty: no ids, no bytes. Repeated rows give repeated results. Further columns
are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from refgauge.llm.encode import encoder, gather, small_batches
from refgauge.llm.inputs import documents_of, reachable


def byte_of_character() -> dict[str, int]:
    """The printable character that stands for each byte: itself if visible, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteTable:
    """The bytes of every id of a byte-level vocabulary."""

    def __init__(self, vocabulary: dict[str, int]):
        byte = byte_of_character()
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        sizes = np.array([len(t) for t in tokens], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, and the byte offset at which each id ends."""
        return gather(self.flat, self.starts[ids], self.ends[ids])


_tables: dict[str, ByteTable] = {}


def byte_table(path: str) -> ByteTable:
    if path not in _tables:
        _tables[path] = ByteTable(encoder(path, False).tokenizer.get_vocab(with_added_tokens=False))
    return _tables[path]


def character_offsets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token the character it starts in, and whether it starts inside that character."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    inside = (data & 0xC0) == 0x80
    before = np.cumsum(~inside)
    return before[starts] - 1, inside[starts]


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids, and for every id the character offset at which it starts in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = byte_table(vocabulary)
        for batch in small_batches(batches):
            ids = encoder(vocabulary, False).encode(batch.column("text"))
            offsets = [character_offsets(*bytes_of.decode(x))[0] for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())),
                    pa.array(offsets, pa.list_(pa.int64())),
                ],
                ["doc_id", "ids", "offsets"],
            )

    reachable(docs.sparkSession)
    schema = "doc_id bigint, ids array<bigint>, offsets array<bigint>"
    return documents_of(docs).mapInArrow(run, schema)


def decoded(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the text of `ids`; bytes that are no UTF-8 become replacement characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = byte_table(vocabulary)
        for batch in batches:
            texts = [
                bytes_of.decode(np.array(x or [], np.int64))[0].tobytes().decode("utf-8", "replace")
                for x in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    reachable(tokens.sparkSession)
    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row a document: number of ids, digests of ids and decoded bytes, tokens inside characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = byte_table(vocabulary)
        for batch in small_batches(batches):
            ids = encoder(vocabulary, False).encode(batch.column("text"))
            n, of_ids, of_bytes, split = [], [], [], []
            for x in ids:
                data, ends = bytes_of.decode(x)
                n.append(len(x))
                of_ids.append(hashlib.sha256(x.astype("<u4", copy=False)).hexdigest())
                of_bytes.append(hashlib.sha256(data).hexdigest())
                starts = ends[:-1]
                split.append(int(np.count_nonzero((data[starts] & 0xC0) == 0x80)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_bytes, pa.string()), pa.array(split, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split_characters"],
            )

    reachable(docs.sparkSession)
    schema = (
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
        "n_split_characters bigint"
    )
    return documents_of(docs).mapInArrow(run, schema)
