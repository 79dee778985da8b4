"""WARC archives against the pages they were made of."""

import gzip
import hashlib
import os
import random

import pytest
from edge_cases import key

from refgauge.llm import warc_shards
from refgauge.llm.queries import QUERIES
from refgauge.workspace import new_path

SCHEMA = "page_id long, url string, html string, Html string, shard long, kind int, digest string, first long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, 1, "d", 3) for r in rows], SCHEMA)


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) of (page_id, url, html), by brute force."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    first, out = {}, []
    for page_id, _, html in order:
        data = (html or "").encode()
        again = len(data) >= 100 and data in first
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
                    first[data] if again else None))
        first.setdefault(data, page_id)
    return sorted(out, key=key)


def got(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
                   for r in df.collect()), key=key)


def plain(folder):
    return folder.removeprefix("file:")


def files_of(folder):
    base = plain(folder) + "/data"
    return {name: open(f"{base}/{name}", "rb").read() for name in sorted(os.listdir(base)) if not name.startswith(".")}


def sample(n=400, seed=4):
    rng = random.Random(seed)
    shared = ["é" * 60, "same page " * 40, "short", "", None]
    rows = []
    for k in range(n):
        html = rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choices("abc <p>é漢\n", k=rng.randrange(3000)))
        rows.append((None if k % 50 == 0 else rng.randrange(n), rng.choice([None, "", "http://a.b/ü?q=1 2\r\nX: y", f"https://c.d/{k}"]), html))
    return rows + rows[:20]


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(QUERIES["op11_warc_shards"](spark, sf)) == expected(rows)


def test_edge_cases(spark):
    for rows in (sample(), []):
        folder = new_path(spark, "test-warc")
        assert got(warc_shards.round_trip(table(spark, rows), folder)) == expected(rows)


def test_payloads_come_back_and_every_archive_reads_as_gzip(spark):
    rows, folder = sample(200, 9), new_path(spark, "test-warc")
    warc_shards.write(table(spark, rows), folder, shard_bytes=30_000, roll_bytes=5_000)
    back = warc_shards.read(spark, folder).collect()
    want = {hashlib.sha256((h or "").encode()).hexdigest(): h or "" for _, _, h in rows}
    assert all(r.payload == want[r.payload_digest] for r in back if r.record_type == "response")
    files = files_of(folder)
    assert len(files) > 5
    for name, data in files.items():
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and name.encode() in text
        assert b"\r\nX: y" not in text.replace(b"<p>", b"")  # urls cannot add header lines
    order = [(r.page_id is None, r.page_id or 0) for r in sorted(back, key=lambda r: r.file)]
    by_file = {}
    for r in back:
        by_file.setdefault(r.file, []).append((r.page_id is None, r.page_id or 0))
    ids = [x for name in sorted(by_file) for x in by_file[name]]
    assert ids == sorted(ids) and len(order) == len(rows)


def test_files_do_not_depend_on_layout(spark):
    rows, made = sample(300, 2), []
    for n in (1, 7):
        folder = new_path(spark, "test-warc")
        own = table(spark, random.Random(n).sample(rows, len(rows))).repartition(n)
        warc_shards.write(own, folder, shard_bytes=40_000, roll_bytes=20_000)
        made.append(files_of(folder))
    assert made[0] == made[1] and len(made[0]) > 3


def test_one_id_in_many_shards(spark):
    rows = [(5, f"http://x/{k}", f"page {k} " * 30) for k in range(300)] + [(6, "u", "v" * 200), (4, "u", "w" * 200)]
    folder = new_path(spark, "test-warc")
    warc_shards.write(table(spark, rows), folder, shard_bytes=6_000)
    assert got(warc_shards.read(spark, folder)) == expected(rows)
    assert len(files_of(folder)) > 4


def test_broken_runs_do_not_show(spark):
    rows, folder = sample(60, 5), new_path(spark, "test-warc")
    with pytest.raises(Exception, match="(?i)path"):
        warc_shards.read(spark, folder)
    warc_shards.write(table(spark, rows), folder)
    base = plain(folder)
    with open(f"{base}/data/pages-00000099-0000.warc.gz", "wb") as lost:  # left by another attempt
        lost.write(b"half a file")
    assert got(warc_shards.read(spark, folder)) == expected(rows)
    name = next(n for n in files_of(folder) if "00000099" not in n)
    with open(f"{base}/data/{name}", "r+b") as whole:
        whole.truncate(os.path.getsize(f"{base}/data/{name}") - 30)
    with pytest.raises(Exception, match="(?i)cut off|records"):
        warc_shards.read(spark, folder).collect()
