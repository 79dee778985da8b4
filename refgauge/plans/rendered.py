"""Wiki-style inputs derived from the `documents` table, row by row and whole.

The tables hold no markup, so each line of a document is written as a heading, a link, a
citation and so on, by its place. `plans.oracles` states the same rule in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refgauge import fixed

FIRST_REVISION = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, title, text)."""
    docs = documents(spark, folder)
    return once(docs, page_id=F.col("doc_id"), title=title(), text=text())


def titles(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, title, revision_id) of the articles; the scan leaves the texts alone."""
    doc = F.col("doc_id")
    return table(spark, folder, "documents").select(
        doc.alias("page_id"), title().alias("title"), revision_of(doc).alias("revision_id")
    )


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """A projection whose columns are computed once per row, however often they are used.

    A plain projection would be merged into each filter and count above it, and the text
    written anew for all of them. Rows stay in their tasks.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(F.inline(F.array(row)))


def title() -> Column:
    return F.expr(r"""
        concat(
            CASE doc_id % 23 WHEN 0 THEN 'Template:' WHEN 1 THEN 'Category:' WHEN 2 THEN 'File:'
                WHEN 3 THEN 'Wikipedia:' WHEN 4 THEN 'Portal:' WHEN 5 THEN 'Help:' ELSE '' END,
            'Article ', doc_id)""")


def text() -> Column:
    # The first word of a line is what its heading, link or citation names.
    word = "substring_index(x, ' ', 1)"
    return F.expr(rf"""
        concat(
            CASE WHEN doc_id % 29 = 7 THEN '#REDIRECT [[Other]] '
                WHEN doc_id % 31 = 3 THEN '{{{{disambiguation}}}} ' ELSE '' END,
            array_join(transform(split(text, '
'), (x, i) -> CASE (doc_id + i) % 13
                WHEN 0 THEN concat('

==', {word}, '==

')
                WHEN 1 THEN concat('

===', {word}, '===

')
                WHEN 2 THEN concat('[[', {word}, '|', {word}, ']] ', x)
                WHEN 3 THEN concat('[[', {word}, ']] ', x)
                WHEN 4 THEN concat(x, '{{{{cite book|title=', {word}, '}}}}')
                WHEN 5 THEN concat(x, '{{{{Cite journal|title=', {word}, '}}}}')
                WHEN 6 THEN concat(x, '{{{{cite web|url=http://ex.org/', {word}, '}}}}')
                WHEN 7 THEN concat(x, '{{{{cite news|title=', {word}, '}}}}')
                WHEN 8 THEN concat(x, '<ref>', {word}, '</ref>{{{{cn}}}}')
                WHEN 9 THEN concat(x, '[https://ex.org ', {word}, ']')
                WHEN 10 THEN concat('[', array_join(array_repeat({word}, 8), '|'), ']')
                WHEN 11 THEN concat('

', x)
                ELSE x END), '
'),
            CASE doc_id % 3 WHEN 0 THEN '

==References==
tail'
                WHEN 1 THEN '

==External links==
[http://a.b c]' ELSE '' END)""")


def categorized(spark: SparkSession, folder: str) -> DataFrame:
    """Articles, every fourth of them in two categories."""
    links = F.when(F.col("page_id") % 4 == 0, " [[Category:A-b (c)]] [[:Category:D]]").otherwise("")
    return articles(spark, folder).withColumn("text", F.concat("text", links))


def revision_of(doc_id: Column) -> Column:
    return doc_id + F.lit(FIRST_REVISION)


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """(revision_id, Stub .. FA); some revisions have no score."""
    doc = F.col("doc_id")
    weight = [((doc * (2 * j + 1) + j) % 11 + 1).cast("double") for j in range(6)]
    total = reduce(lambda a, b: a + b, weight)
    return (
        table(spark, folder, "documents")
        .filter(doc % 97 != 13)
        .select(
            revision_of(doc).alias("revision_id"),
            *[(weight[j] / total).alias(c) for j, c in enumerate(fixed.CLASSES)],
        )
    )


def revised(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with the id of their revision."""
    return articles(spark, folder).withColumn("revision_id", revision_of(F.col("page_id")))


def raw_pages(spark: SparkSession, folder: str, texts: bool = True) -> DataFrame:
    """Flat page rows under dotted names, as they come out of a dump, with their dump file.

    texts: without, the scan leaves the texts alone, and the hash is that of the id.
    """
    docs = documents(spark, folder)
    doc = F.col("doc_id")
    anonymous = doc % 5 == 0
    part = (doc % 3 + 1).cast("string")
    columns = {
        "title": title(),
        "ns": F.lit("0"),
        "id": doc.cast("string"),
        "revision.id": revision_of(doc).cast("string"),
        "revision.timestamp": F.lit("2019-07-01T00:00:00Z"),
        "revision.contributor.username": F.when(~anonymous, F.col("source")),
        "revision.contributor.ip": F.when(anonymous, F.lit("10.0.0.1")),
        "revision.model": F.lit("wikitext"),
        "revision.format": F.lit("text/x-wiki"),
        "revision.text": text(),
        "revision.sha1": F.sha1("text"),
        "dump": F.concat(F.lit("enwiki-20190701-pages-articles-multistream"), part, F.lit(".xml")),
    }
    if texts:
        return once(docs, **columns)
    columns["revision.sha1"] = F.sha1(doc.cast("string"))
    del columns["revision.text"]
    return docs.select(*[value.alias(name) for name, value in columns.items()])


def score_responses(spark: SparkSession, folder: str) -> DataFrame:
    """(response,): scores as the JSON a score service answers with, for some 50 revisions each."""
    probability = F.create_map(*[x for c in fixed.CLASSES for x in (F.lit(c), F.col(c))])
    score = F.struct(probability.alias("probability")).alias("score")
    models = F.struct(F.struct(score).alias("wp10"))
    entry = F.struct(F.col("revision_id").cast("string"), models)
    request = F.floor(F.col("revision_id") / fixed.SCORE_CHUNK)
    asked = scores(spark, folder).groupBy(request).agg(
        F.map_from_entries(F.collect_list(entry)).alias("scores")
    )
    return asked.select(F.to_json(F.create_map(F.lit("enwiki"), F.struct("scores"))).alias("response"))


def edit_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, html): edit forms, the text escaped in their text area, some letters in three ways."""
    text = F.col("text")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    for char, code, name in (("é", 233, "eacute"), ("ü", 252, "uuml"), ("ñ", 241, "ntilde")):
        forms = [F.lit(f"&{form};") for form in (f"#{code}", f"#x{code:X}", name)]
        form = F.element_at(F.array(*forms), (F.col("page_id") % 3 + 1).cast("int"))
        text = F.replace(text, F.lit(char), form)
    return articles(spark, folder).select("page_id", F.concat(
        F.lit('<html><body><form><textarea id="box" rows="25">'), text,
        F.lit("</textarea><textarea>other</textarea></form></body></html>"),
    ).alias("html"))


def history_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, html): lists of revisions, newest first; every seventh page has none.

    The attribute is quoted in three ways.
    """
    doc = F.col("doc_id")
    quote = F.element_at(F.array(F.lit('"'), F.lit("'"), F.lit("")), (doc % 3 + 1).cast("int"))
    item = lambda r: F.concat(F.lit('<li class="r" data-mw-revid='), quote, r.cast("string"), quote, F.lit(">x</li>"))
    items = F.when(doc % 7 != 0, F.concat(item(revision_of(doc)), item(doc))).otherwise("")
    html = F.concat(F.lit('<html><ul><li class="menu">Home</li></ul><ul>'), items, F.lit("</ul></html>"))
    return table(spark, folder, "documents").select(doc.alias("page_id"), html.alias("html"))


def separated(spark: SparkSession, folder: str, step: float = 100.0, own: bool = False) -> DataFrame:
    """(vec_id, part, point): embeddings moved apart into five parts, by `label % 5`.

    A part's points are raised by `step` in every fifth dimension; with `own`, by a multiple of its
    own, so that the directions of most spread differ. Values lie within one of zero before.
    """
    part = F.col("label") % 5
    size = F.lit(step) * (part + 1 if own else 1)
    point = F.transform(
        F.col("embedding").cast("array<double>"), lambda x, i: x + F.when(i % 5 == part, size).otherwise(0.0)
    )
    return table(spark, folder, "embeddings").select("vec_id", part.alias("part"), point.alias("point"))
