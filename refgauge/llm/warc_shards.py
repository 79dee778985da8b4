"""Pages as WARC archives in shards that do not depend on how the table was laid out.

Records stand in the order of (page_id, digest of the payload, url). Shards are ranges of page ids
between splitters, which are rows chosen by a hash of their content, so the same pages give the same
files, byte by byte, in any number of tasks. A task writes whole shards and begins a new file when
the compressed size of the open one has reached `roll_bytes`; every record is a gzip member of its
own. WARC and HTTP headers, record ids and digests are made anew from the rows.

Files are written under temporary names that no other attempt has. A manifest, one row a file, is
what tasks that succeeded return; the files it names are then moved to their final names, and the
manifest is stored last. Readers start from the manifest and check size and number of records of
every file and the digests of every record, so neither lost tasks nor broken runs show.

Of records with equal payloads of at least `least` bytes the one with the smallest page_id is a
response and the others are revisits that refer to it; of equal page ids the first in order. Smaller
payloads are responses all. Html null or empty: a payload of no bytes. A null page_id is larger than
all others. Rows that repeat are records that repeat. Null and empty urls become `urn:page:` and the
id. Further columns are left out. An empty table gives no files and an empty result.

Files go through pyarrow's file systems: a local or mounted folder, or any store they know.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refgauge.llm.inputs import columns_of, reachable
from refgauge.workspace import written

LEAST = 100
SHARD_BYTES, ROLL_BYTES = 64 << 20, 16 << 20
OVERSAMPLE = 32  # rows sampled for each shard
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PLAIN = "!#$%&'()*+,/:;=?@[]~"  # characters that urls keep besides letters, digits and -._
END = b"\r\n\r\n"
NULLS = 2.0**63  # stands for null ids among splitters


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and its path there."""
    local = re.match(r"(?:file:/*)?(/.*)", folder) or re.match(r"file:/*(.*)", folder)
    if local:
        return fs.LocalFileSystem(), "/" + local[1].lstrip("/")
    if "://" not in folder:
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


class Record(NamedTuple):
    page_id: int | None
    url: str | None
    digest: str
    number: int  # among records of equal page_id and payload
    payload: bytes
    revisit: bool = False
    refers_to: int | None = None


def record_id(page_id: int | None, digest: str, number: int) -> str:
    return f"<{uuid.UUID(bytes=hashlib.sha256(f'{page_id}:{digest}:{number}'.encode()).digest()[:16]).urn}>"


def head(fields: dict[str, str | int | None]) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in fields.items() if value is not None]
    return ("WARC/1.1\r\n" + "".join(lines) + "\r\n").encode()


def record_bytes(record: Record) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(record.payload)}\r\n\r\n"
    block = http.encode() + (b"" if record.revisit else record.payload)
    fields = {
        "WARC-Type": "revisit" if record.revisit else "response",
        "WARC-Record-ID": record_id(record.page_id, record.digest, record.number), "WARC-Date": DATE,
        "WARC-Target-URI": quote(record.url, safe=PLAIN) if record.url else f"urn:page:{record.page_id}",
        "WARC-Payload-Digest": f"sha256:{record.digest}", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Profile": PROFILE if record.revisit else None,
        "WARC-Refers-To": record_id(record.refers_to, record.digest, 0) if record.revisit else None,
        "Content-Type": "application/http;msgtype=response", "Content-Length": len(block), "Page-Id": record.page_id,
        "Refers-To-Page-Id": record.refers_to if record.revisit else None,
    }
    return head(fields) + block + END


def info_bytes(name: str) -> bytes:
    block = b"format: WARC file version 1.1\r\n"
    return head({
        "WARC-Type": "warcinfo", "WARC-Record-ID": record_id(None, name, 0), "WARC-Date": DATE, "WARC-Filename": name,
        "Content-Type": "application/warc-fields", "Content-Length": len(block),
    }) + block + END


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without name or time."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


class Shard:
    """Files of one shard: opened under a temporary name, closed when large enough."""

    def __init__(self, folder: str, number: int, roll_bytes: int):
        self.files, self.path = store(folder)
        self.number, self.roll_bytes = number, roll_bytes
        self.count, self.out = 0, None

    def open(self) -> None:
        self.name = f"pages-{self.number:08d}-{self.count:04d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        self.files.create_dir(f"{self.path}/_temporary", recursive=True)
        self.out = self.files.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
        self.size, self.records, self.count = 0, 0, self.count + 1
        self.write(info_bytes(self.name))

    def write(self, data: bytes) -> None:
        squeezed = member(data)
        self.out.write(squeezed)
        self.size += len(squeezed)

    def add(self, record: Record) -> Iterator[dict]:
        if self.out is None:
            self.open()
        self.write(record_bytes(record))
        self.records += 1
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[dict]:
        if self.out is not None:
            self.out.close()
            self.out = None
            yield {"name": self.name, "temporary": self.temporary, "records": self.records, "size": self.size}


MANIFEST = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("records", pa.int64()), ("size", pa.int64())])
MANIFEST_DDL = "name string, temporary string, records bigint, size bigint"


def with_shards(rows: DataFrame, slim: DataFrame, shard_bytes: int) -> DataFrame:
    """A column `shard`, ascending with (page_id, digest), from splitters chosen by content.

    Splitters are `OVERSAMPLE`-quantiles of a sample, which the driver sees: some `OVERSAMPLE` ids for
    each `shard_bytes` of payload. An id that takes up several quantiles has that many shards, parted
    by the digest.
    """
    size = slim.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    shards = -(-(size["bytes"] or 0) // shard_bytes) or 1
    one_in = -(-size["n"] // (shards * OVERSAMPLE)) or 1
    chosen = slim.filter(F.pmod(F.xxhash64("page_id", "digest"), F.lit(one_in)) == 0) if shards > 1 else slim.limit(0)
    value = F.coalesce(F.col("page_id").cast("double"), F.lit(NULLS))
    sample = sorted(r["at"] for r in chosen.select(value.alias("at")).collect())
    often = Counter(sample[OVERSAMPLE::OVERSAMPLE])
    parted = {at: n for at, n in often.items() if n > 1}
    inner = {*often, *(at + 1 for at in parted), NULLS} - {float("inf")}
    splits = [float("-inf"), *sorted(inner), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="at", outputCol="bucket").transform(rows.withColumn("at", value))
    sub = F.lit(0)
    if parted:
        numbers = {float(k): parted[at] for k, at in enumerate(splits) if at in parted}
        own = F.create_map(*(F.lit(x) for pair in numbers.items() for x in pair))[F.col("bucket")]
        share = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("double") / 2.0**32
        sub = F.coalesce(F.floor(share * own), F.lit(0))
    width = max(parted.values(), default=1)
    return bucketed.withColumn("shard", (F.col("bucket").cast("long") * width + sub).cast("long")).drop("at", "bucket")


def write(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, least: int = LEAST
) -> None:
    """Writes the archives of all pages below `folder`, which must not hold any yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            shard, marked, before, number, first = None, None, None, 0, None
            for batch in batches:
                for own, page_id, digest, kind, refers_to, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                    if not kind:
                        marked, first = (page_id, digest), refers_to
                        continue
                    if shard is None or shard.number != own:
                        yield from shard.close() if shard else ()
                        shard = Shard(folder, own, roll_bytes)
                    same = (page_id, digest)
                    number = number + 1 if same == before else 0
                    before = same
                    revisit = same == marked and (page_id != first or number > 0)
                    payload = html.encode("utf-8", "surrogatepass")
                    yield from shard.add(Record(page_id, url, digest.hex(), number, payload, revisit, first if revisit else None))
            yield from shard.close() if shard else ()

        for row in rows():
            yield pa.RecordBatch.from_pylist([row], MANIFEST)

    spark = pages.sparkSession
    reachable(spark)
    rows = columns_of(pages, ("page_id", "bigint"), ("url", "string"), ("html", "string"))
    rows = rows.withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.encode("html", "UTF-8"), 256)))
    slim = written(rows.select("page_id", "digest", F.octet_length("html").cast("long").alias("size")), "payloads")
    equal = slim.filter(F.col("size") >= least).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    marks = slim.join(equal, "digest").select("page_id", "digest", "first").distinct()
    both = rows.withColumn("kind", F.lit(1)).unionByName(marks.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    order = ["shard", F.col("page_id").asc_nulls_last(), "digest", "kind", F.col("url").asc_nulls_first()]
    ordered = with_shards(both, slim, shard_bytes).repartition("shard").sortWithinPartitions(*order)
    made = written(
        ordered.select("shard", "page_id", "digest", "kind", "first", "url", "html").mapInArrow(run, MANIFEST_DDL), "files")
    commit(made, folder)


def commit(made: DataFrame, folder: str) -> None:
    """Gives the files of a manifest their final names and stores the manifest; may be run again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        files.create_dir(f"{path}/data", recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{path}/{row['temporary']}", f"{path}/data/{row['name']}"
                if files.get_file_info(source).type == fs.FileType.File:
                    files.move(source, target)
                if files.get_file_info(target).size != row["size"]:
                    raise OSError(f"{target} is not the file that was written")
            yield batch

    made.mapInArrow(run, MANIFEST_DDL).write.parquet(f"{folder}/manifest")


def records(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    top, _, rest = data.partition(END)
    lines = top.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != END or len(block) != int(fields["Content-Length"]):
        raise ValueError("no whole WARC record")
    return fields, block


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    data = b""
    while True:
        squeeze, parts = zlib.decompressobj(31), []
        while not squeeze.eof:
            data = data or stream.read(1 << 20)
            if not data:
                if parts:
                    raise EOFError("the last record is cut off")
                return
            parts.append(squeeze.decompress(data))
            data = squeeze.unused_data if squeeze.eof else b""
        yield b"".join(parts)


PAGE = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string()), ("file", pa.string()),
])


def page_of(fields: dict[str, str], block: bytes, file: str, with_payload: bool) -> dict:
    """The row of a record, from its content; wrong digests are an error."""
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"a block in {file} has changed")
    kind, told = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    http, _, payload = block.partition(END)
    size = int(re.search(rb"(?m)^Content-Length: (\d+)", http)[1])
    own = told if kind == "revisit" else hashlib.sha256(payload).hexdigest()
    if own != told or (kind == "response" and size != len(payload)):
        raise ValueError(f"a payload in {file} has changed")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("Page-Id"), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": own,
        "record_type": kind, "refers_to": number("Refers-To-Page-Id"), "file": file,
        "payload": payload.decode("utf-8", "surrogatepass") if with_payload and kind == "response" else None,
    }


def read(spark: SparkSession, folder: str, with_payload: bool = True, tasks: int = 4096) -> DataFrame:
    """One row a record of the archives that the manifest of `folder` names; each file goes to one of `tasks` tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                held, size, n = [], 0, 0
                with files.open_input_stream(f"{path}/data/{row['name']}", compression=None) as stream:
                    for data in members(stream):
                        fields, block = records(data)
                        if fields["WARC-Type"] != "warcinfo":
                            held.append(page_of(fields, block, row["name"], with_payload))
                            size, n = size + (len(block) if with_payload else 200), n + 1
                            if size > 4 << 20:
                                yield pa.RecordBatch.from_pylist(held, PAGE)
                                held, size = [], 0
                if n != row["records"]:
                    raise ValueError(f"{row['name']} has {n} records instead of {row['records']}")
                yield pa.RecordBatch.from_pylist(held, PAGE)

    reachable(spark)
    manifest = spark.read.schema(MANIFEST_DDL).parquet(f"{folder}/manifest")
    ddl = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, payload string, file string")
    return manifest.repartition(max(1, min(manifest.count(), tasks)), "name").mapInArrow(run, ddl)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives and returns, read back, what each record says of its page."""
    write(pages, folder)
    return read(pages.sparkSession, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
