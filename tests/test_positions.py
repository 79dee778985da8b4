"""Global row numbers and the chunks made of them."""

import random

import pytest
from pyspark.sql import functions as F

from refgauge import fixed
from refgauge.operators import positions, scoring
from refgauge.operators.positions import with_position
from refgauge.workspace import written


@pytest.mark.parametrize("n, partitions", [(0, 4), (1, 4), (1000, 7), (1000, 1)])
def test_positions_follow_the_order(spark, n, partitions):
    ids = [3 * i for i in range(n)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(5)
    found = with_position(df, ["id"], partitions=partitions).collect()
    assert sorted((r.position, r.id) for r in found) == list(enumerate(sorted(ids)))


def test_positions_restart_in_each_file(spark):
    files = ("f0", "f1", None)
    rows = [(files[i % 3], i) for i in range(200)]
    df = spark.createDataFrame(rows, "file string, id bigint")
    found = with_position(df, ["id"], within="file", partitions=8).collect()
    for f in files:
        got = sorted((r.position, r.id) for r in found if r.file == f)
        assert got == list(enumerate(sorted(i for g, i in rows if g == f)))


@pytest.fixture
def ranges(monkeypatch):
    """The tables that are written: one file a range."""
    made = []
    monkeypatch.setattr(positions, "written", lambda df, name: made.append(written(df, name)) or made[-1])
    return made


def test_a_hot_key_is_split(spark, ranges):
    rows = [(7 if i % 3 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, other bigint")
    found = with_position(df, ["id"], partitions=8)
    assert sorted(r.position for r in found.collect()) == list(range(3000))
    ids = [r.id for r in found.orderBy("position").collect()]
    assert ids == sorted(ids)
    parts = ranges[0].filter("id = 7").select(F.input_file_name().alias("f")).distinct().count()
    assert parts > 1


def test_copies_of_a_row_are_split(spark, ranges):
    df = spark.createDataFrame([(7,)] * 2000 + [(i,) for i in range(100)], "id bigint").repartition(4)
    found = with_position(df, ["id"], partitions=8)
    assert sorted(r.position for r in found.collect()) == list(range(2100))
    sizes = [r["count"] for r in ranges[0].groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 700


def test_one_missing_score_blanks_its_chunk(spark):
    revisions = spark.range(205).withColumnRenamed("id", "revision_id")
    scores = revisions.filter("revision_id not in (60, 204)").select(
        "revision_id", *[F.lit(.1).alias(c) for c in fixed.CLASSES]
    )
    found = scoring.chunked_scores(revisions, scores).collect()
    kept = sorted(r.revision_id for r in found if r.Stub is not None)
    assert len(found) == 205
    assert kept == [*range(50), *range(100, 200)]


def test_many_groups_stay_off_the_driver(spark):
    df = spark.range(200_000).selectExpr("id % 100000 AS file", "id")
    found = with_position(df, ["id"], within="file")
    assert found.filter("position <> floor(id / 100000)").count() == 0 and found.count() == 200_000


def test_one_score_row_a_revision_counts(spark):
    revisions = spark.range(100).withColumnRenamed("id", "revision_id")
    scores = revisions.select("revision_id", *[F.lit(.1).alias(c) for c in fixed.CLASSES])
    found = scoring.chunked_scores(revisions, scores.union(scores.filter("revision_id < 30")))
    assert found.count() == 100 and found.filter("Stub IS NULL").count() == 0
