"""Dumps to features, clusters and reports; and dumps as a stream."""

import bz2

import pytest
from pyspark.sql import functions as F

from refgauge import fixed, pipeline
from refgauge.operators import features, profile
from refgauge.sources import dumps
from refgauge.streaming.dumps import follow_dumps

DATE = "20190701"


def page(i, title, text):
    text = text.replace("&", "&amp;").replace("<", "&lt;")
    return (f"<page><title>{title}</title><ns>0</ns><id>{i}</id><revision><id>{1000 + i}</id>"
            f'<text xml:space="preserve">{text}</text></revision></page>')


def write_dump(folder, part, first, n=60, date=DATE):
    body = "".join(
        page(i, f"Help:P{i}" if i % 10 == 9 else f"P{i}", "x" + "w " * i + "[[a]]" * (i % 7) + "{{cite book|x}}" * (i % 3))
        for i in range(first, first + n)
    )
    name = f"enwiki-{date}-pages-articles-multistream{part}.xml-p{first}.bz2"
    (folder / name).write_bytes(bz2.compress(f"<mediawiki><siteinfo/>{body}</mediawiki>".encode()))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    xml, out = tmp_path_factory.mktemp("xml"), tmp_path_factory.mktemp("out") / "t"
    write_dump(xml, 1, 0)
    write_dump(xml, 2, 60)
    scores = spark.range(1000, 1120).filter("id <> 1070").select(
        F.col("id").alias("revision_id"), *[F.lit((i + 1) / 21).alias(c) for i, c in enumerate(fixed.CLASSES)]
    )
    pipeline.process_dumps(spark, str(xml), str(out), scores)
    return str(xml), str(out)


def test_dumps_to_tables(spark, folder):
    raw = pipeline.raw_pages(spark, folder[1])
    assert raw.groupBy("file").count().orderBy("file").collect()[0]["count"] == 60
    assert raw.count() == 120
    # Revision 1070 is in the first chunk of 50 of the second file.
    found = pipeline.page_scores(spark, folder[1])
    kept = sorted(r.revision_id for r in found.filter("Stub is not null").collect())
    assert found.count() == 120 and kept == [*range(1000, 1060), *range(1110, 1120)]


def test_features_of_a_date(spark, folder):
    table = pipeline.create_features(spark, folder[1], DATE)
    assert table.columns == ["title", *fixed.FEATURES, *fixed.CLASSES]
    assert table.count() == 70 - 7
    one = table.filter("title = 'P5'").first()
    assert (one.n_words, one.n_internal_links, one.book_citations) == (8, 5, 2)
    plain = pipeline.create_features(spark, folder[1], DATE, scores=False, save=False)
    assert plain.count() == 108
    small = pipeline.create_features(spark, folder[1], DATE, scores=False, limit=5)
    assert small.count() == 5
    assert pipeline.create_features(spark, folder[1], DATE, debug=True).count() == features.DEBUG_ROWS
    with pytest.raises(Exception):
        pipeline.create_features(spark, folder[1], "20200101", save=False).count()


def test_clusters_of_a_table(spark, folder, tmp_path):
    table = pipeline.create_features(spark, folder[1], DATE, scores=False, save=False)
    path = str(tmp_path / "model")
    placed = pipeline.get_clusters(table, path, ks=range(2, 4))
    again = pipeline.predict(table, path)
    rows = lambda df: sorted((r.title, r.prediction) for r in df.collect())
    assert rows(placed) == rows(again) and len(rows(placed)) == 108
    assert placed.columns == [*table.columns, "prediction"]
    assert {p for _, p in rows(pipeline.get_clusters(table, path, k=3))} == {0, 1, 2}


def test_assessment(spark, folder):
    pages = pipeline.page_texts(spark, folder[1], DATE)
    scores = pipeline.page_scores(spark, folder[1])
    assert pipeline.assess(pages, scores).count() == 120
    rows = {r.title: r for r in pipeline.assess(pages, scores, [" P5 ", "Help:P9", "P70"]).collect()}
    assert rows["P5"].predicted_class == "FA" and "100% books" in rows["P5"].mix
    assert rows["Help:P9"].note == fixed.TAG_SENTENCES["help"]
    assert rows["P70"].predicted_class is None and rows["P70"].mix


def test_stream_takes_each_dump_once(spark, folder, tmp_path):
    xml = tmp_path / "xml"
    xml.mkdir()
    write_dump(xml, 1, 0)
    run = lambda: follow_dumps(spark, str(xml), str(tmp_path / "f"), str(tmp_path / "p")).awaitTermination(120)
    assert run()
    assert spark.read.parquet(str(tmp_path / "f")).count() == 54
    write_dump(xml, 2, 60)
    assert run() and run()
    found = spark.read.parquet(str(tmp_path / "f"))
    assert found.count() == found.select("title").distinct().count() == 108
    batch = pipeline.create_features(spark, folder[1], DATE, scores=False, save=False)
    assert sorted(map(tuple, found.drop("revision_id").collect())) == sorted(map(tuple, batch.collect()))


def test_large_dumps_are_split(spark, tmp_path):
    body = "".join(page(i, f"P{i}", "é" * 300) for i in range(2000))
    (tmp_path / "big.xml").write_text(f"<mediawiki>{body}</mediawiki>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        pages = dumps.read_pages(spark, str(tmp_path))
        assert pages.rdd.getNumPartitions() > 4
        assert sorted(int(r.id) for r in pages.select("id").collect()) == list(range(2000))
        assert pages.filter(F.char_length("`revision.text`") != 300).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dates_and_reruns_give_each_page_once(spark, tmp_path):
    xml, out = tmp_path / "xml", str(tmp_path / "out")
    xml.mkdir()
    scores = spark.range(1000, 1120).select(
        F.col("id").alias("revision_id"), *[F.lit((i + 1) / 21).alias(c) for i, c in enumerate(fixed.CLASSES)]
    )
    rows = lambda df: sorted(map(tuple, df.collect()))
    write_dump(xml, 1, 0)
    # As after a run that broke off between its two tables.
    pipeline.process_dumps(spark, str(xml), out)
    pipeline.process_dumps(spark, str(xml), out, scores)
    first = [rows(pipeline.raw_pages(spark, out).select("file", "title")), rows(pipeline.page_scores(spark, out))]
    pipeline.process_dumps(spark, str(xml), out, scores)
    again = [rows(pipeline.raw_pages(spark, out).select("file", "title")), rows(pipeline.page_scores(spark, out))]
    assert first == again and len(first[0]) == len(first[1]) == 60
    # Another date of the same pages, in a folder of its own.
    later = tmp_path / "later"
    later.mkdir()
    write_dump(later, 1, 0, date="20190801")
    pipeline.process_dumps(spark, str(later), out, scores.union(scores))
    assert pipeline.raw_pages(spark, out).count() == pipeline.page_scores(spark, out).count() == 120
    for date in (DATE, "20190801"):
        assert pipeline.create_features(spark, out, date, save=False).count() == 54
        pages = pipeline.page_texts(spark, out, date)
        assert pipeline.assess(pages, pipeline.page_scores(spark, out)).count() == 60


def test_debug_keeps_scores_and_is_saved(spark, folder):
    table = pipeline.create_features(spark, folder[1], DATE, debug=True)
    assert {"text", "Stub", "n_words", "revision_id"} <= set(table.columns)
    assert sorted(r.revision_id for r in table.collect()) == [1000 + i for i in range(60) if i % 10 != 9][:50]


def test_stored_counts_meet_their_scores_without_being_moved(spark, folder):
    pipeline.store_counts(spark, folder[1], DATE, buckets=4)
    want = sorted(map(tuple, pipeline.create_features(spark, folder[1], DATE, save=False).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for _ in range(2):
            table = pipeline.scored_features(spark, folder[1], DATE, buckets=4)
            assert sorted(map(tuple, table.collect())) == want and len(want) == 63
            plan = table._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            # As in another session, which knows nothing of the tables.
            for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]:
                spark.sql(f"DROP TABLE {name}")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    new = pipeline.page_scores(spark, folder[1], DATE).withColumn("FA", F.lit(0.5))
    pipeline.store_scores(new, folder[1], DATE, buckets=4)
    found = pipeline.scored_features(spark, folder[1], DATE, buckets=4)
    assert {r.FA for r in found.collect()} == {0.5} and found.count() == 63


def test_profiles_of_dumps_add_up(spark, folder, tmp_path):
    xml, out = tmp_path / "xml", str(tmp_path / "out")
    xml.mkdir()
    write_dump(xml, 1, 0)
    scores = spark.range(0).select(F.col("id").alias("revision_id"), *[F.lit(0.1).alias(c) for c in fixed.CLASSES])
    for n, date in enumerate((DATE, "20190801")):
        place = tmp_path / date
        place.mkdir()
        write_dump(place, 1, 60 * n, date=date)
        pipeline.process_dumps(spark, str(place), out, scores)
        pipeline.store_counts(spark, out, date, buckets=2)
        pipeline.profile_dumps(spark, out, date, buckets=2)
    every = [pipeline.create_features(spark, out, date, scores=False, save=False) for date in (DATE, "20190801")]
    names = list(fixed.FEATURES)
    together = every[0].unionByName(every[1])
    parts = pipeline.profiles(spark, out)
    assert parts.count() == 2
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(profile.merged_ranges(parts, names)) == rows(profile.feature_ranges(together, names))
    assert rows(profile.merged_totals(parts, names[:9])) == rows(profile.feature_totals(together, names[:9]))


def test_sketches_of_many_values(spark):
    df = spark.range(300_000).selectExpr(
        "id % 7 AS dump", "concat('v', id % 60000) AS many", "if(id % 3 = 0, NULL, concat('f', id % 4)) AS few", "if(id % 10 < 3, 'hot', string(id)) AS skewed")
    sketches = profile.part_sketches(df, "dump", ["many", "few", "skewed"])
    found = {r["column"]: r for r in profile.merged_distinct(sketches).collect()}
    for name, n in (("many", 60_000), ("few", 4), ("skewed", 210_001)):
        assert found[name].n_rows == 300_000 and abs(found[name].n_distinct - n) <= 0.03 * n
    frequent = profile.merged_frequent(sketches, 4).collect()
    assert {(r.value, r.n) for r in frequent if r["column"] == "few"} == {(f"f{k}", 50_000) for k in range(4)}
    assert [(r.value, r.n) for r in frequent if r["column"] == "skewed"][0] == ("hot", 90_000)
