"""Dumps, tables and models in files."""

import re

import pytest
from pyspark.sql import functions as F

from refgauge.operators import articles
from refgauge.plans import rendered
from refgauge.plans.queries import QUERIES
from refgauge.sources import dumps, tables
from refgauge.workspace import new_path, passing, shared_folder, written

DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" xml:lang="en">
  <siteinfo><sitename>W</sitename></siteinfo>
  <page>
    <title> A &amp; B </title><ns>0</ns><id>10</id>
    <revision>
      <id>55</id><parentid>54</parentid><timestamp>2019-07-01T00:00:00Z</timestamp>
      <contributor><username>u</username><id>9</id></contributor>
      <comment/>
      <model>wikitext</model><format>text/x-wiki</format>
      <text xml:space="preserve" bytes="20">
==H==
&lt;ref&gt;x&lt;/ref&gt;

line, "quoted"
</text>
      <sha1>abc</sha1>
    </revision>
  </page>
  <page>
    <title>C</title><ns>0</ns><id>11</id><redirect title="A" />
    <revision><id>56</id><contributor><ip>10.0.0.1</ip></contributor><text xml:space="preserve"></text></revision>
  </page>
</mediawiki>
"""


def dump_folder(tmp_path):
    (tmp_path / "part1.xml").write_text(DUMP)
    (tmp_path / "part2.xml").write_text(DUMP.replace("<id>10</id>", "<id>20</id>"))
    return str(tmp_path)


def test_dump_pages(spark, tmp_path):
    rows = dumps.read_pages(spark, dump_folder(tmp_path)).orderBy("dump", "id").collect()
    assert [(r["dump"], r["id"]) for r in rows] == [
        ("part1.xml", "10"), ("part1.xml", "11"), ("part2.xml", "11"), ("part2.xml", "20")]
    first, second = rows[0].asDict(), rows[1].asDict()
    assert first["title"] == "A & B"
    assert first["revision.id"] == "55" and first["revision.timestamp"] == "2019-07-01T00:00:00Z"
    assert first["revision.contributor.username"] == "u" and first["revision.contributor.id"] == "9"
    assert first["revision.text"] == '==H==\n<ref>x</ref>\n\nline, "quoted"'
    assert first["revision.comment"] is None and first["revision.contributor.ip"] is None
    assert second["revision.text"] is None and second["revision.contributor.ip"] == "10.0.0.1"
    assert "revision" not in first and "redirect" not in first


def test_raw_tables(spark, tmp_path):
    pages = dumps.read_pages(spark, dump_folder(tmp_path))
    path = str(tmp_path / "raw")
    tables.write_raw_pages(pages, path)
    schema = ", ".join(f"`{c}` string" for c in pages.columns if c != "dump")
    every = tables.read_raw_pages(spark, path, schema)
    assert sorted({r.file for r in every.collect()}) == ["part1_xml_raw.csv", "part2_xml_raw.csv"]
    one = tables.read_raw_pages(spark, path, schema, "part1*_raw.csv")
    text = articles.strip_prefix(one).filter("id = '10'").first().text
    assert text == '==H==\n<ref>x</ref>\n\nline, "quoted"'
    assert sorted(map(str, every.drop("file").collect())) == sorted(map(str, pages.drop("dump").collect()))


def test_names_of_tables(spark):
    assert spark.range(1).select(tables.raw_name(F.lit("enwiki-1.xml-p1"))).first()[0] == "enwiki-1_xml-p1_raw.csv"
    assert tables.features_path("d", "20190701").endswith("/enwiki-20190701-features")
    assert tables.features_path("d", "20190701", limited=True).endswith("-features-small")


def test_csv_keeps_spaces_quotes_and_lines(spark, tmp_path):
    rows = [(' a "b", c \n\nd ', 1.5), ("\n\\x", None)]
    df = spark.createDataFrame(rows, "t string, x double")
    tables.write_csv(df.coalesce(1), str(tmp_path / "c"))
    back = tables.read_csv(spark, str(tmp_path / "c"), "t string, x double").collect()
    assert sorted(map(tuple, back)) == sorted(rows)


def test_work_goes_to_the_shared_folder(spark):
    folder = shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or named.rstrip("/") == folder
    assert new_path(spark, "x").startswith(folder) and new_path(spark, "x") != new_path(spark, "x")
    assert written(spark.range(5), "t").count() == 5


class Unset:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = self
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_local_sessions_make_their_own_folder():
    local = Unset("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder
    with pytest.raises(ValueError):
        shared_folder(Unset("spark://host:7077"))


def small_page(i, text="x", tag="<page>"):
    return (f"{tag}<title>T{i}</title><ns>0</ns><id>{i}</id><revision><id>{i}</id>"
            f'<text xml:space="preserve">{text}</text></revision></page>')


def test_broken_pages_are_told(spark, tmp_path):
    (tmp_path / "good.xml").write_text(f"<mediawiki>{small_page(1)}{small_page(2, tag='<page >')}</mediawiki>\n")
    (tmp_path / "stray.xml").write_text(f"<mediawiki>{small_page(3)}{small_page(4, 'a & b')}{small_page(5)}</mediawiki>")
    (tmp_path / "cut.xml").write_text(f"<mediawiki>{small_page(6)}{small_page(7)[:-30]}")
    ids = lambda df: sorted(int(r.id) for r in df.collect())
    assert ids(dumps.read_pages(spark, f"{tmp_path}/good.xml")) == [1, 2]
    for name in ("stray", "cut"):
        with pytest.raises(Exception, match="broken page"):
            dumps.read_pages(spark, f"{tmp_path}/{name}.xml").collect()
    assert ids(dumps.sound_pages(spark, str(tmp_path))) == [1, 2, 3, 5, 6]
    assert sorted(r["dump"] for r in dumps.rejects(spark, str(tmp_path)).collect()) == ["cut.xml", "stray.xml"]


def test_passing_tables_are_removed(spark):
    with passing(spark):
        kept = written(spark.range(3), "passing")
        assert kept.count() == 3
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kept.inputFiles()[0])
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        assert store.exists(path)
    assert not store.exists(path) and not store.exists(path.getParent())


def test_texts_are_not_moved(spark, sf):
    """No exchange in a plan over articles carries the text, but where the query returns it."""
    for name in ("n_words", "paragraphs", "filter_articles", "tag_articles", "feature_table", "article_report", "page_score_join"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        for part in plan.split("Exchange")[1:]:
            assert not re.search(r"\btext#", part.split("\n")[0])


def test_queries_without_text_do_not_read_it(spark, sf):
    for name in ("strip_prefix", "column_profile"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "text:string" not in plan


def test_rendered_text_is_computed_once(spark, sf):
    plan = articles.filter_articles(rendered.articles(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_repeat") == 1
