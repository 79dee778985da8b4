"""Counts on hand-written strings, and on random markup against SQL and plain patterns."""

import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from refgauge import fixed
from refgauge.functions import markup
from refgauge.operators import features
from refgauge.plans import oracles


def count(spark, column, *texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, text string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("text"))).collect()]


def test_words(spark):
    assert count(spark, markup.n_words, "", " a ", "a b", "a\nb", "a  b", None) == [1, 3, 2, 1, 3, None]


def test_headings(spark):
    texts = [
        "==A==", "===A===", "====Foo====", "==References==", "== References ==",
        "==External links==", "==A== links", "==References==Foo==", "======Z======",
        "==A== x\nlinks", "==Links==\n==B==", "==A==B==",
    ]
    found = [count(spark, lambda t, k=k: markup.heading_count(t, k), *texts) for k in range(2, 7)]
    assert found[0] == [1, 1, 1, 0, 1, 0, 0, 1, 1, 1, 1, 1]
    assert found[1] == [0, 1, 1, 0, 0, 0, 0, 0, 1, 0, 0, 0]
    assert found[2] == [0, 0, 1, 0, 0, 0, 0, 0, 1, 0, 0, 0]
    assert found[3] == found[4] == [0] * 8 + [1] + [0] * 3
    with pytest.raises(ValueError):
        markup.heading_count(F.col("text"), 7)


def test_headings_v1(spark):
    texts = ["==References==", "==External links==", "==A== links", "===A===", None]
    assert count(spark, lambda t: markup.heading_count_v1(t, 2), *texts) == [1, 1, 1, 1, None]


def test_citations(spark):
    texts = [
        "{{cite book|title=x}}", "{{Cite BOOK}}", "{{cite book\n|title=x}}", "{cite book}",
        "{{cite bookshelf}}", "{{cite web}}", "{{cite book{{cite book}}}}", "{{cıte booK|x}}",
        "{{cite book|a\rb}}", None,
    ]
    book = lambda **kw: count(spark, lambda t: markup.citation_count(t, "book", **kw), *texts)
    plain = [len(re.findall("{cite book(.*?)}", str(t), re.IGNORECASE)) for t in texts[:-1]]
    assert book() == [*plain, None] == [1, 1, 0, 1, 1, 0, 1, 1, 1, None]
    assert book(any_case=False) == [1, 0, 0, 1, 1, 0, 1, 0, 1, None]
    assert book(space=True) == [0] * 9 + [None]
    assert count(spark, lambda t: markup.citation_count(t, "web"), "{{cite website}}") == [1]


def test_links(spark):
    assert count(
        spark, markup.n_internal_links,
        "[[A]] [[A|B]] [[A#C|B]]", "[[A#C]]", "[[File:A]]", "[[café]]", "[[A|B|C]]", None,
    ) == [3, 0, 0, 0, 0, None]
    assert count(
        spark, markup.n_external_links,
        "http://a.b https://c.d", "[http://a.b]", "[http://a.b c]",
        '[http://a.b c d]<ref name="x">[http://e.f]', '[http://a.b]<ref name="x">[http://e.f]',
        "http://a%20b", "ftp://a.b", None,
    ) == [2, 1, 1, 1, 2, 1, 0, None]


def test_other_counts(spark):
    assert count(spark, markup.n_unreferenced, "{{cn}}<ref>a b</ref><ref>[x]</ref>", "", None) == [2, 0, None]
    assert count(
        spark, markup.n_categories, "[[Category:A-b (c)]] [[:Category:D]] [[category:E]]", None
    ) == [2, None]
    eight, seven = "[" + "|".join("abcdefgh") + "]", "[" + "|".join("abcdefg") + "]"
    assert count(spark, markup.n_images, eight + seven + eight, "[]", None) == [2, 0, None]
    assert count(spark, markup.n_level4_pieces, "a====b====c", "", None) == [3, 1, None]
    assert count(spark, markup.first_lines, "1\n2\n3\n4\n5\n6", "1\n2", None) == ["1\n2\n3\n4\n5", "1\n2", None]


def test_paragraphs(spark):
    texts = [
        "one", "", "a\n\nb", "a\n\n\n\nb", "a\n\n==H==\n\nb", "a\n\n{{box\n|x=1}}\n\nb",
        "a\n\n==References==\nr\n\nq", "a\n\n==External Links==\nr\n\nq",
        "{{a {{b}} c}}\nx", "x\n\n{{a\n{{b}}\n}}", "x\n\n[[File:y]]", "[[A]]\n[[B]]", None,
    ]
    assert count(spark, markup.n_paragraphs, *texts) == [0, -1, 1, 1, 1, 1, 0, 0, 0, 0, 0, -1, None]
    assert count(spark, markup.n_paragraphs_v1, "a\n\nb\n\nc", "a\n\n{{b}}\n\nc", None) == [2, 0, None]


def test_averages_follow_the_paragraph_count(spark):
    df = spark.createDataFrame([(3, 6, 0), (3, 6, 2), (0, 6, -1)],
                               "n_internal_links int, n_external_links int, n_paragraphs int")
    rows = features.link_averages(df).collect()
    for r in rows:
        assert r.average_internal_links == r.n_internal_links / (r.n_paragraphs + 1e-8)
        assert r.average_external_links == r.n_external_links / (r.n_paragraphs + 1e-8)


TOKENS = [
    "{{", "}}", "{", "}", "[[", "]]", "[", "]", "|", "#", "=", "==", "===", "==A==", "\n", "\n\n",
    "a", "b c", " ", ".", "links", "Links", "References", "==References==", "==External links==",
    "{{cn}}", "<ref>", "</ref>", "{{cite book", "{{Cite web", "{cite news ", "http://", "https://x.y",
    "%20", "[http://a.b c]", '<ref name="n">', "[[Category:", "a|b|c|d|e|f|g|h", "é", "{{x}}\n",
    "{{a {{b}} c}}\n", "}}\n", "]]\n", "[[File:x]]", "======C======", "{{cite journal|t}}",
]


def random_texts(n, tokens, seed, size=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(tokens) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_random_markup_against_sql(spark):
    texts = random_texts(20000, TOKENS, 11)
    # SQL's end of text is the very end only; Java's may stand before a last newline.
    texts = [t.rstrip("\n") for t in texts]
    db = duckdb.connect()
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id int, text string")
    db.register("pages_table", pages.toArrow())
    db.execute("CREATE TABLE articles AS SELECT * FROM pages_table")
    expressions = dict(oracles.COUNTS)
    columns = features.counts(F.col("text"))
    for name, sql in oracles.COUNTS_V1.items():
        expressions[f"{name}_1"] = sql
        columns[f"{name}_1"] = features.counts_v1(F.col("text"))[name]
    expected = db.execute(f"SELECT {oracles.columns(expressions)} FROM articles ORDER BY page_id").fetchall()
    found = pages.orderBy("page_id").select(*[columns[n].alias(n) for n in expressions]).collect()
    names = list(expressions)
    bad = [
        (names[j], texts[i], f[j], e[j])
        for i, (f, e) in enumerate(zip(found, expected)) for j in range(len(names)) if f[j] != e[j]
    ]
    assert not bad, bad[:5]
    assert [n for j, n in enumerate(names) if all(f[j] == 0 for f in found)] == []


def test_templates_equal_their_plain_pattern(spark):
    tokens = ["{{", "}}", "{", "}", "a", "\n", "\n\n", "}}\n", "{{x}}", " ", "\r", "\r\n", " ",
              "{{a {{b}} c}}\n", "}} }}\n"]
    df = spark.createDataFrame([(t,) for t in random_texts(30000, tokens, 3, 24)], "t string")
    inside = r"\{\{(?:[^{}]|\{\{.*\}\})*\}\}"
    ours = {inside + r"\n+": (markup.TEMPLATE_BLOCK, markup.BLOCK_END), inside + "$": (markup.TEMPLATE_TAIL, markup.TAIL_END)}
    for plain, own in ours.items():
        found = {few: markup.replace_templates(F.col("t"), *own, "#", few) for few in (-1, 2, markup.FEW)}
        both = df.select("t", F.regexp_replace("t", plain, "#").alias("p"), *[c.alias(f"o{k}") for k, c in enumerate(found.values())])
        assert both.filter("p <> t").count() > 1000
        assert both.filter("p <> o0 OR p <> o1 OR p <> o2").take(3) == []


@pytest.mark.parametrize("text", [
    "{{box\n" + "* {{flag|x}}\n" * 50000 + "}}\nend",
    "{{box\n" + "* {{flag|x}}\n" * 50000,
    "{{box\n" + "* {{flag|x}} }}\n" * 50000 + "end",
    "{{" + "a" * 500000,
    "{{a}}" * 20000 + "\n",
    "http://" + "a%20b.c-d" * 50000,
    "[[" + "a" * 500000 + "|",
    "{{cite book " + "x" * 500000,
    "=" * 20000,
    "\n" * 20000,
    "{{" * 10000,
    "{{x " * 20000,
    "{{x\n" * 20000,
    "{{x " * 40000 + "}}\nend",
    "{{x " * 40000 + "}} }}\nend",
    "{{a {{b}} c\n" * 40000,
    "{{a {{b}} c\n" * 40000 + "}}",
    "{{a {{b {{c}} d\nx\n" * 20000 + "{\n",
    "{" * 100000 + "}}\n",
    ("{{a {{b}} c\n" * 200 + "{\n") * 200,
], ids=["nested", "unclosed", "ambiguous", "run", "siblings", "host", "link", "cite", "equals", "blank",
        "braces", "words", "lines", "one close", "two closes", "open lines", "late close", "dead lines", "long run", "parts"])
def test_large_texts_need_no_stack_and_little_time(spark, text):
    df = spark.createDataFrame([("t", text)], "title string, text string")
    start = time.time()
    assert features.add_features(df).drop("text").count() == 1
    row = features.add_features(df).drop("text").first()
    assert row.n_words is not None
    assert time.time() - start < 20


def test_null_text_gives_null_counts(spark):
    df = spark.createDataFrame([("t", None)], "title string, text string")
    row = features.add_features(df).first().asDict()
    assert all(row[f] is None for f in fixed.FEATURES)
    assert features.feature_table(df, scores=False).count() == 0
