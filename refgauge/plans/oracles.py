"""SQL for the queries, written apart from the Spark code and for another engine.

Its regular expressions have no lookaround and no possessive quantifiers, so headings,
paragraphs and the like are stated here in their plain form.
"""

from __future__ import annotations

from refgauge import fixed

NL = "chr(10)"
BLANK = f"{NL} || {NL}"
CL = "[a-zA-Z0-9.,!? ]+"
URL = r"https?://(?:[-\w.]|(?:%[\da-fA-F]{2}))+"

TITLE = f"""
    CASE doc_id % 23 WHEN 0 THEN 'Template:' WHEN 1 THEN 'Category:' WHEN 2 THEN 'File:'
        WHEN 3 THEN 'Wikipedia:' WHEN 4 THEN 'Portal:' WHEN 5 THEN 'Help:' ELSE '' END
    || 'Article ' || doc_id::VARCHAR"""

W = "split_part(x, ' ', 1)"
TEXT = f"""
    CASE WHEN doc_id % 29 = 7 THEN '#REDIRECT [[Other]] '
         WHEN doc_id % 31 = 3 THEN '{{{{disambiguation}}}} ' ELSE '' END
    || array_to_string(list_transform(string_split(text, {NL}), lambda x, i:
        CASE (doc_id + i - 1) % 13
        WHEN 0 THEN {BLANK} || '==' || {W} || '==' || {BLANK}
        WHEN 1 THEN {BLANK} || '===' || {W} || '===' || {BLANK}
        WHEN 2 THEN '[[' || {W} || '|' || {W} || ']] ' || x
        WHEN 3 THEN '[[' || {W} || ']] ' || x
        WHEN 4 THEN x || '{{{{cite book|title=' || {W} || '}}}}'
        WHEN 5 THEN x || '{{{{Cite journal|title=' || {W} || '}}}}'
        WHEN 6 THEN x || '{{{{cite web|url=http://ex.org/' || {W} || '}}}}'
        WHEN 7 THEN x || '{{{{cite news|title=' || {W} || '}}}}'
        WHEN 8 THEN x || '<ref>' || {W} || '</ref>{{{{cn}}}}'
        WHEN 9 THEN x || '[https://ex.org ' || {W} || ']'
        WHEN 10 THEN '[' || array_to_string([{", ".join([W] * 8)}], '|') || ']'
        WHEN 11 THEN {BLANK} || x
        ELSE x END), {NL})
    || CASE doc_id % 3 WHEN 0 THEN {BLANK} || '==References==' || {NL} || 'tail'
                       WHEN 1 THEN {BLANK} || '==External links==' || {NL} || '[http://a.b c]'
                       ELSE '' END"""

ARTICLES = f"articles AS (SELECT doc_id AS page_id, {TITLE} AS title, {TEXT} AS text FROM documents)"
CATEGORIZED = f"""{ARTICLES},
categorized AS (SELECT page_id, title, text ||
    CASE WHEN page_id % 4 = 0 THEN ' [[Category:A-b (c)]] [[:Category:D]]' ELSE '' END AS text
    FROM articles)"""

SCORES = """weights AS (
    SELECT doc_id, {w} FROM documents WHERE doc_id % 97 <> 13),
scores AS (
    SELECT doc_id + 1000000 AS revision_id, {p} FROM weights)""".format(
    w=", ".join(f"((doc_id * {2 * j + 1} + {j}) % 11 + 1)::DOUBLE AS w{j}" for j in range(6)),
    p=", ".join(f'w{j} / (w0 + w1 + w2 + w3 + w4 + w5) AS "{c}"' for j, c in enumerate(fixed.CLASSES)),
)
ROUNDED = ", ".join(f'round("{c}", 9) AS "{c}"' for c in fixed.CLASSES)


def n_matches(pattern: str, text: str = "text", flags: str = "") -> str:
    options = f", 0, '{flags}'" if flags else ""
    return f"len(regexp_extract_all({text}, '{pattern}'{options}))::INT"


def heading(level: int) -> str:
    # Nothing up to the last `links` of a line counts, nor does what starts with References.
    cut = r"regexp_replace(text, '(?m)^.*[Ll]inks', '', 'g')"
    marked = f"replace({cut}, '=References', '=' || chr(1) || 'References')"
    return n_matches(f"={{{level}}}{CL}={{{level}}}", marked)


def heading_v1(level: int) -> str:
    return n_matches(f"={{{level}}}{CL}={{{level}}}")


def citation(source: str, flags: str = "i", gap: str = "") -> str:
    return n_matches(r"\{cite " + source + gap + r"(.*?)\}", flags=flags)


def paragraphs() -> str:
    inside = r"\{\{(?:[^{}]|\{\{.*\}\})*\}\}"
    prose = "text"
    for pattern in (
        r"\n\n+(?:\{\{[^}]*\}\}|\[\[[^\]]*\]\]|={1,7}.*={1,7})\n\n+",
        r"==References==(?s:.*)",
        r"==External [lL]inks==(?s:.*)",
        inside + r"\n+",
        inside + r"\z",
        r"\[\[[^\]]*\]\]\n+",
        r"\[\[[^\]]*\]\]\z",
        r"\n\n+",
    ):
        prose = f"regexp_replace({prose}, '{pattern}', {BLANK}, 'g')"
    return f"(len(list_filter(string_split({prose}, {BLANK}), lambda s: s <> '')) - 1)::INT"


WORDS = "len(string_split(text, ' '))::INT"
INTERNAL = n_matches(rf"\[\[{CL}\]\]|\[\[{CL}\|{CL}\]\]|\[\[{CL}#{CL}\|{CL}\]\]")
EXTERNAL = n_matches(rf'{URL}|\[{URL}\]|\[{URL} {CL}\]<ref name="{CL}">\[{URL}\]')
UNREFERENCED = n_matches(rf"\{{\{{cn\}}\}}|<ref>{CL}</ref>")
CATEGORIES = n_matches(r"\[\[:?Category:[a-zA-Z0-9.,\-!?\(\) ]+\]\]")
IMAGES = n_matches(r"\[" + r"\|".join([CL] * 8) + r"\]")
PARAGRAPHS_V1 = (
    r"(len(string_split(regexp_replace(text, "
    r"'\n\n\{\{.*\}\}\n\n|\n\n\[\[.*\]\]\n\n|\n\n={1,7}.*={1,7}\n\n', '', 'g'), "
    f"{BLANK})) - 1)::INT"
)

COUNTS = {
    "n_words": WORDS,
    "n_internal_links": INTERNAL,
    "n_external_links": EXTERNAL,
    **{f"level{k}": heading(k) for k in fixed.HEADING_LEVELS},
    **{f"{s}_citations": citation(s) for s in fixed.CITATION_SOURCES},
    "n_paragraphs": paragraphs(),
    "n_unreferenced": UNREFERENCED,
    "n_images": IMAGES,
}
COUNTS_V1 = {
    "n_words": WORDS,
    **{f"level{k}": heading_v1(k) for k in fixed.HEADING_LEVELS},
    "book_citations": citation("book"),
    "journal_citations": citation("journal"),
    "n_internal_links": INTERNAL,
    "n_external_links": EXTERNAL,
    "n_paragraphs": PARAGRAPHS_V1,
    "n_unreferenced": UNREFERENCED,
    "n_categories": CATEGORIES,
    "n_images": IMAGES,
}

TAGS = {
    "redirect": "regexp_matches(lower(text), '^#redirect')",
    "disambig": r"regexp_matches(lower(text), '\{\{(disambig|[a-z0-9 |]*disambiguation[|a-z0-9 ]*)\}\}')",
    "template": "regexp_matches(lower(title), '^template:')",
    "category": "regexp_matches(lower(title), '^category:')",
    "file": "regexp_matches(lower(title), '^file:')",
    "wikipedia_related": "regexp_matches(lower(title), '^wikipedia:')",
    "portal": "regexp_matches(lower(title), '^portal:')",
    "help": "regexp_matches(lower(title), '^help:')",
}
IS_ARTICLE = " AND ".join(f"NOT {t}" for t in TAGS.values())
FIRST_TAG = "CASE " + " ".join(f'WHEN "{t}" THEN \'{t}\'' for t in fixed.TAGS) + " END"


def columns(expressions: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{name}"' for name, e in expressions.items())


def over_articles(expressions: dict[str, str]) -> str:
    return f"WITH {ARTICLES} SELECT page_id, {columns(expressions)} FROM articles"


def doubles(names) -> str:
    return ", ".join(f'"{n}"::DOUBLE AS "{n}"' for n in names)


def featured(source: str, where: str, extra: str = "") -> str:
    """CTEs ending in `features`: page_id, title and the features as doubles."""
    averages = (
        "n_internal_links / (n_paragraphs + 1e-8::DOUBLE) AS average_internal_links, "
        "n_external_links / (n_paragraphs + 1e-8::DOUBLE) AS average_external_links"
    )
    return f"""
counted AS (SELECT page_id, title, {columns(COUNTS)}{extra} FROM {source} WHERE {where}),
averaged AS (SELECT *, {averages} FROM counted),
features AS (SELECT page_id, title, {doubles(fixed.FEATURES)}{', ' + doubles(fixed.TAGS) if extra else ''}
    FROM averaged)"""


FEATURES = f"{ARTICLES}, {featured('articles', IS_ARTICLE)}"
TAGGED = f"{ARTICLES}, {featured('articles', 'true', ', ' + columns(TAGS))}"

RAW = f"""raw AS (SELECT doc_id, {TITLE} AS title, '0' AS ns, doc_id::VARCHAR AS id,
    (doc_id + 1000000)::VARCHAR AS "revision.id", '2019-07-01T00:00:00Z' AS "revision.timestamp",
    CASE WHEN doc_id % 5 <> 0 THEN source END AS "revision.contributor.username",
    CASE WHEN doc_id % 5 = 0 THEN '10.0.0.1' END AS "revision.contributor.ip",
    'wikitext' AS "revision.model", 'text/x-wiki' AS "revision.format",
    {TEXT} AS "revision.text", sha1(text) AS "revision.sha1",
    'enwiki-20190701-pages-articles-multistream' || (doc_id % 3 + 1)::VARCHAR || '.xml' AS dump
    FROM documents)"""

SPACE_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]"
)
STRIPPED = (
    rf"regexp_replace(regexp_replace(\"revision.text\", '\A{SPACE_CLASS}+', ''), '{SPACE_CLASS}+\z', '')"
).replace('\\"', '"')


def chunked(group: str) -> str:
    over = f"PARTITION BY {group} " if group else ""
    keys = f"{group}, chunk" if group else "chunk"
    head = f"d.{group}, " if group else ""
    kept = ", ".join(
        f'CASE WHEN complete THEN round("{c}", 9) END AS "{c}"' for c in fixed.CLASSES
    )
    names = ", ".join(f'"{c}"' for c in fixed.CLASSES)
    return f"""
WITH {SCORES},
revisions AS (SELECT doc_id + 1000000 AS revision_id, (doc_id % 3 + 1)::INT AS dump FROM documents),
placed AS (SELECT r.*, {names}, s.revision_id IS NOT NULL AS found,
    (row_number() OVER ({over}ORDER BY r.revision_id) - 1) // 50 AS chunk
    FROM revisions r LEFT JOIN scores s USING (revision_id)),
judged AS (SELECT *, min(found::INT) OVER (PARTITION BY {keys}) = 1 AS complete FROM placed)
SELECT revision_id, {group + ', ' if group else ''}{kept} FROM judged"""


UNESCAPE = (
    "replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
    "'&#039;', ''''), '&#39;', ''''), '&amp;', '&')"
)


def element(tag: str) -> str:
    inner = rf"nullif(regexp_extract(html, '(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>', 1), '')"
    return UNESCAPE.format(inner)


def attribute(tag: str, name: str) -> str:
    value = rf"""nullif(regexp_extract(html, '(?is)<{tag}\s(?:[^>]*?\s)?{name}="([^"]*)"', 1), '')"""
    return UNESCAPE.format(value)


# Centers: mean point of each label, one row per dimension; clusters are numbered in label order.
POINTS = """
points AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS point FROM embeddings),
parts AS (SELECT vec_id, label, unnest(point) AS x, unnest(range(1, len(point) + 1)) AS dim FROM points)"""


def nearest(group: str) -> str:
    """CTEs ending in `nearest`: the closest of the group means; clusters in group order."""
    return f"""{POINTS},
centers AS (SELECT {group} AS part, dim, avg(x) AS c FROM parts GROUP BY ALL),
costs AS (SELECT vec_id, part, sum((x - c) * (x - c)) AS cost
    FROM parts JOIN centers USING (dim) GROUP BY vec_id, part),
numbered AS (SELECT part, (row_number() OVER (ORDER BY part) - 1)::INT AS prediction
    FROM (SELECT DISTINCT part FROM centers)),
nearest AS (SELECT vec_id, prediction, cost FROM costs JOIN numbered USING (part)
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cost, prediction) = 1)"""


NEAREST = nearest("label")


def separated(size: str) -> str:
    """CTEs ending in `parted` and `coordinates`: embeddings moved apart, as `plans.rendered` does."""
    return f"""
moved AS (SELECT vec_id, label % 5 AS part, list_transform(embedding, lambda x, i:
        x::DOUBLE + CASE WHEN (i - 1) % 5 = label % 5 THEN {size} ELSE 0 END) AS point FROM embeddings),
parted AS (SELECT *, min(vec_id) OVER (PARTITION BY part) AS cluster, count(*) OVER (PARTITION BY part) AS n FROM moved),
coordinates AS (SELECT vec_id, part, cluster, n, unnest(point) AS x, unnest(range(len(point)))::INT AS dim FROM parted)"""


PARTED = separated("100.0")
# Squared deviations from the means of the parts.
PART_COST = """(SELECT round(sum((x - c) * (x - c)), 4) FROM
    (SELECT x, avg(x) OVER (PARTITION BY part, dim) AS c FROM coordinates))"""
# The same with every dimension scaled to [0, 1].
SCALED_COST = """(SELECT round(sum((y - c) * (y - c)), 4) FROM
    (SELECT y, avg(y) OVER (PARTITION BY part, dim) AS c FROM
    (SELECT part, dim, (x - min(x) OVER (PARTITION BY dim)) / (max(x) OVER (PARTITION BY dim) - min(x) OVER (PARTITION BY dim)) AS y
    FROM coordinates)))"""
SILHOUETTE = f"""{POINTS},
means AS (SELECT a.vec_id, a.label AS own, b.label AS other,
        sum(list_distance(a.point, b.point) ** 2) AS total, count(*) AS n
    FROM points a, points b GROUP BY a.vec_id, a.label, b.label),
sides AS (SELECT vec_id,
        max(CASE WHEN own = other THEN total / greatest(n - 1, 1) END) AS intra,
        min(CASE WHEN own <> other THEN total / n END) AS nearest,
        max(CASE WHEN own = other THEN n END) AS n
    FROM means GROUP BY vec_id),
judged AS (SELECT *, CASE WHEN n = 1 OR intra = nearest THEN 0.0::DOUBLE
        WHEN intra < nearest THEN 1 - intra / nearest ELSE nearest / intra - 1 END AS silhouette FROM sides)"""

CITATION_LIST = ", ".join(
    f"{{'source': '{s}', 'place': {i}, 'n': {s}_citations::INT}}"
    for i, s in enumerate(fixed.CITATION_SOURCES)
)
MIX = f"""cited AS (SELECT page_id, unnest([{CITATION_LIST}]) AS c FROM features),
mixed AS (SELECT page_id, c.source AS source, c.n AS n,
    row_number() OVER (PARTITION BY page_id ORDER BY c.n DESC, c.place)::INT AS rank,
    100.0::DOUBLE * c.n / nullif(sum(c.n) OVER (PARTITION BY page_id), 0) AS percent FROM cited)"""


def sentence(key: str, table: dict) -> str:
    literal = lambda x: str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return f"CASE {key} " + " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in table.items()) + " END"


PREDICTED = (
    "CASE greatest(" + ", ".join(f'"{c}"' for c in fixed.CLASSES) + ") "
    + " ".join(f"WHEN \"{c}\" THEN '{c}'" for c in fixed.CLASSES) + " END"
)

SCALED = "scaled AS (SELECT page_id, " + ", ".join(
    f"CASE WHEN min({f}) OVER () = max({f}) OVER () THEN 0.5::DOUBLE "
    f"ELSE ({f} - min({f}) OVER ()) / (max({f}) OVER () - min({f}) OVER ()) END AS {f}"
    for f in fixed.FEATURES
) + " FROM features)"


def components(
    source: str, digits: int, key: str = "page_id", point: str = f"[{', '.join(fixed.FEATURES)}]",
    d: int = len(fixed.FEATURES), more: str = "",
) -> str:
    """First two principal components: a covariance matrix squared until one direction is left.

    Each matrix is a list of rows in a single row; the second one lacks the first direction.
    """
    squared = "list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c)))"
    trace = f"list_sum(list_transform(range(1, {d + 1}), lambda i: m[i][i]))"
    widest = f"list_sort(list_transform(range(1, {d + 1}), lambda i: [m[i][i], i]), 'DESC')[1][2]::INT"

    def direction(n: int, matrix: str) -> str:
        return f"""
    powers{n} AS (SELECT 0 AS step, m FROM {matrix} UNION ALL
        SELECT step + 1, list_transform({squared}, lambda r: list_transform(r, lambda x: x / (t * t)))
        FROM (SELECT step, m, {trace} AS t FROM powers{n}) WHERE step < 40),
    lines{n} AS (SELECT m[{widest}] AS r FROM powers{n} WHERE step = 40),
    units{n} AS (SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))) AS u FROM lines{n}),
    axis{n} AS (SELECT list_transform(u, lambda x: x * CASE WHEN
        list_max(u) >= -list_min(u) THEN 1 ELSE -1 END) AS v FROM units{n})"""

    return f"""
    spots AS (SELECT {key}{more}, {point} AS p FROM {source}),
    cells AS (SELECT {key}, unnest(p) AS x, unnest(range(1, {d + 1})) AS i FROM spots),
    centered AS (SELECT {key}, i, x - avg(x) OVER (PARTITION BY i) AS x FROM cells),
    products AS (SELECT a.i AS i, b.i AS j, sum(a.x * b.x) / (count(*) - 1) AS c
        FROM centered a JOIN centered b USING ({key}) GROUP BY a.i, b.i),
    rows AS (SELECT i, list(c ORDER BY j) AS r FROM products GROUP BY i),
    matrix1 AS (SELECT list(r ORDER BY i) AS m FROM rows),{direction(1, "matrix1")},
    strength AS (SELECT m, v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS w
        FROM matrix1, axis1),
    matrix2 AS (SELECT list_transform(range(1, {d + 1}), lambda i: list_transform(range(1, {d + 1}),
        lambda j: m[i][j] - w * v[i] * v[j])) AS m FROM strength),{direction(2, "matrix2")}
    SELECT {key}{more}, round(list_dot_product(p, axis1.v), {digits}) + 0.0::DOUBLE AS pc1,
        round(list_dot_product(p, axis2.v), {digits}) + 0.0::DOUBLE AS pc2
    FROM spots, axis1, axis2"""


ORACLES: dict[str, str] = {
    "n_words": over_articles({"n_words": WORDS}),
    "n_unique_words": over_articles({"words_count": WORDS}),
    "headings": over_articles({f"level{k}": heading(k) for k in fixed.HEADING_LEVELS}),
    "headings_v1": over_articles({f"level{k}": heading_v1(k) for k in fixed.HEADING_LEVELS}),
    "citations": over_articles({f"{s}_citations": citation(s) for s in fixed.CITATION_SOURCES}),
    "citations_cs": over_articles({
        f"{s}_citations": citation(s, flags="") for s in fixed.CITATION_SOURCES
    }),
    "citations_space": over_articles({
        f"{s}_citations": citation(s, gap=" ") for s in ("book", "journal")
    }),
    "internal_links": over_articles({"n_internal_links": INTERNAL}),
    "external_links": over_articles({"n_external_links": EXTERNAL}),
    "paragraphs": over_articles({"n_paragraphs": paragraphs()}),
    "paragraphs_v1": over_articles({"n_paragraphs": PARAGRAPHS_V1}),
    "unreferenced": over_articles({"n_unreferenced": UNREFERENCED}),
    "images": over_articles({"n_images": IMAGES}),
    "first_lines": over_articles({
        "first_lines": f"array_to_string(list_slice(string_split(text, {NL}), 1, 5), {NL})"
    }),
    "categories": f"WITH {CATEGORIZED} SELECT page_id, {CATEGORIES} AS n_categories FROM categorized",
    "link_averages": f"""WITH {ARTICLES}, counted AS (
        SELECT page_id, {INTERNAL} AS n_internal_links, {EXTERNAL} AS n_external_links,
            {paragraphs()} AS n_paragraphs FROM articles)
        SELECT *, n_internal_links / (n_paragraphs + 1e-8::DOUBLE) AS average_internal_links,
            n_external_links / (n_paragraphs + 1e-8::DOUBLE) AS average_external_links FROM counted""",
    "split_digits": """SELECT c_custkey,
        array_to_string(regexp_split_to_array(c_name, '[0-9]+'), '|') AS pieces,
        len(string_split(c_name, '===='))::INT AS n_pieces FROM customer""",
    "level4_pieces": over_articles({"n_pieces": "len(string_split(text, '===='))::INT"}),
    "filter_articles": f"WITH {ARTICLES} SELECT page_id, title FROM articles WHERE {IS_ARTICLE}",
    "tag_articles": f"WITH {ARTICLES} SELECT page_id, title, {columns(TAGS)} FROM articles",
    "article_kind": f"""WITH {ARTICLES}, tagged AS (SELECT page_id, {columns(TAGS)} FROM articles)
        SELECT page_id, {FIRST_TAG} AS kind FROM tagged""",
    "article_columns": f"""WITH {RAW}, {SCORES}
        SELECT "revision.sha1" AS sha1, "revision.timestamp" AS timestamp, title,
            sha1("revision.text") AS text, length("revision.text")::INT AS n_chars, {ROUNDED}
        FROM raw JOIN scores ON revision_id = doc_id + 1000000""",
    "strip_prefix": f"""WITH {RAW} SELECT title, ns, id, "revision.timestamp" AS timestamp,
        "revision.contributor.username" AS "contributor.username",
        "revision.contributor.ip" AS "contributor.ip", "revision.model" AS model,
        "revision.format" AS format, sha1(id) AS sha1, dump FROM raw""",
    "rename_columns": "SELECT vec_id, "
        + ", ".join(f"embedding[{i + 1}]::DOUBLE AS features_{i}" for i in range(4))
        + ", label AS labels FROM embeddings",
    "lower_all": "SELECT lower(p_name) AS p_name, lower(p_brand) AS p_brand, lower(p_type) AS p_type FROM part",
    "normalize_title": f"""WITH {ARTICLES} SELECT page_id, replace(title, ' ', '_') AS url_title,
        title AS display_title FROM articles""",
    "limit_articles": f"SELECT doc_id AS page_id, {TITLE} AS title FROM documents ORDER BY doc_id LIMIT 50",
    "feature_table": f"""WITH {FEATURES}, {SCORES} SELECT features.* EXCLUDE (page_id), {ROUNDED}
        FROM features JOIN scores ON revision_id = page_id + 1000000""",
    "feature_table_v1": f"""WITH {CATEGORIZED}, {SCORES}, counted AS (
        SELECT page_id, title, {columns(COUNTS_V1)} FROM categorized)
        SELECT title, {doubles(fixed.FEATURES_V1)}, {ROUNDED}
        FROM counted JOIN scores ON revision_id = page_id + 1000000""",
    "tagged_feature_table": f"WITH {TAGGED} SELECT * EXCLUDE (page_id) FROM features",
    "feature_totals": f"WITH {FEATURES} SELECT count(*) AS n_rows, "
        + ", ".join(f"sum({f}) AS total_{f}" for f in fixed.FEATURES if not f.startswith("average"))
        + " FROM features",
    "feature_ranges": f"WITH {FEATURES} " + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, min({f}) AS low, max({f}) AS high FROM features" for f in fixed.FEATURES
    ),
    "column_profile": f"WITH {RAW} " + " UNION ALL ".join(
        f"""SELECT DISTINCT '{n}' AS "column", "{c}" AS value FROM raw""" for n, c in (
            ("format", "revision.format"), ("model", "revision.model"), ("ns", "ns"),
            ("contributor.username", "revision.contributor.username"),
            ("contributor.ip", "revision.contributor.ip"))
    ),
    "page_score_join": f"""WITH {SCORES} SELECT doc_id AS page_id, {TITLE} AS title, revision_id, {ROUNDED}
        FROM documents JOIN scores ON revision_id = doc_id + 1000000""",
    "score_left_join": f"""WITH {SCORES} SELECT doc_id AS page_id, {TITLE} AS title,
        doc_id + 1000000 AS revision_id, {ROUNDED}
        FROM documents LEFT JOIN scores ON revision_id = doc_id + 1000000""",
    "chunked_scores": chunked(""),
    "chunked_scores_by_dump": chunked("dump"),
    "revision_at_time": f"""WITH revisions AS (
        SELECT {TITLE} AS title, doc_id * 3 + r AS revision_id, r * (doc_id % 2) AS hours
        FROM documents, range(3) t(r))
        SELECT title, max(revision_id) AS revision_id FROM revisions WHERE hours = 0
        GROUP BY title HAVING count(*) = 1""",
    "union_scores": f"WITH {SCORES} SELECT revision_id, {ROUNDED} FROM scores",
    "weighted_score": f"""WITH {SCORES}, weighted AS (SELECT revision_id, {
        " + ".join(f'{w} * "{c}"' for c, w in fixed.CLASS_WEIGHTS.items())} AS s FROM scores)
        SELECT revision_id, round(s, 9) AS weighted_score, round(s, 9) AS weighted_score_of_map
        FROM weighted""",
    "score_json": f"WITH {SCORES} SELECT revision_id, {ROUNDED} FROM scores",
    "predicted_class": f"WITH {SCORES} SELECT revision_id, {PREDICTED} AS predicted_class FROM scores",
    "reference_mix": f"""WITH {FEATURES}, {MIX}
        SELECT page_id, rank, source, n, round(percent, 9) AS percent FROM mixed""",
    "article_report": f"""WITH {TAGGED}, {SCORES}, {MIX},
        lines AS (SELECT page_id, '{fixed.MIX_TITLE}' || {NL} || string_agg('  > '
            || lpad(coalesce(round_even(percent, 0)::INT::VARCHAR, 'nan'), 4, ' ') || '% '
            || {sentence("source", fixed.CITATION_NAMES)}, {NL} ORDER BY rank) AS mix
            FROM mixed GROUP BY page_id),
        kinds AS (SELECT page_id, title, {FIRST_TAG.replace('" THEN', '" = 1 THEN')} AS kind FROM features),
        classes AS (SELECT revision_id - 1000000 AS page_id, {PREDICTED} AS class FROM scores)
        SELECT page_id, title, kind, {sentence("kind", fixed.TAG_SENTENCES)} AS note,
            CASE WHEN kind IS NULL THEN mix END AS mix,
            CASE WHEN kind IS NULL THEN class END AS predicted_class,
            CASE WHEN kind IS NULL THEN {sentence("class", fixed.CLASS_SENTENCES)} END AS verdict
        FROM kinds JOIN lines USING (page_id) LEFT JOIN classes USING (page_id)""",
    "minmax_scaled": f"WITH {FEATURES}, {SCALED} SELECT page_id, "
        + ", ".join(f"round({f}, 9) AS {f}" for f in fixed.FEATURES) + " FROM scaled",
    "pca_scaled": f"WITH RECURSIVE {FEATURES}, {SCALED}, {components('scaled', 6)}",
    "pca_raw": f"WITH RECURSIVE {FEATURES}, {components('features', -3)}",
    "nearest_center": f"WITH {NEAREST} SELECT vec_id, prediction, round(cost, 6) AS cost FROM nearest",
    "cluster_report": f"""WITH {nearest("label % 3")} SELECT vec_id, prediction,
        {sentence("prediction", fixed.CLUSTER_SENTENCES)} AS cluster_note FROM nearest""",
    "cluster_label": f"""WITH {NEAREST},
        known AS (SELECT vec_id, prediction, quality FROM nearest LEFT JOIN labels ON doc_id = vec_id),
        common AS (SELECT prediction, quality AS cluster_label FROM known WHERE quality IS NOT NULL
            GROUP BY prediction, quality
            QUALIFY row_number() OVER (PARTITION BY prediction ORDER BY count(*) DESC, quality) = 1)
        SELECT vec_id, prediction, quality, cluster_label,
            coalesce(quality, cluster_label) AS label_or_cluster
        FROM known LEFT JOIN common USING (prediction)""",
    "kmeans_predict": f"WITH {PARTED} SELECT vec_id, cluster FROM parted",
    "bisecting_predict": f"WITH {PARTED} SELECT vec_id, cluster FROM parted",
    "kmeans_cost": f"WITH {PARTED} SELECT 5::INT AS k, {PART_COST} AS cost, {PART_COST} AS nearest_cost",
    "cluster_centers": f"""WITH {PARTED} SELECT cluster, n, dim, round(avg(x), 6) AS center, round(avg(x), 6) AS mean
        FROM coordinates GROUP BY cluster, n, dim""",
    "k_sweep": f"""WITH {PARTED} SELECT algorithm, k::INT AS k, k = 5 AS best,
        CASE WHEN k = 5 THEN {SCALED_COST} END AS cost, CASE WHEN k > 5 THEN true END AS no_more
        FROM (VALUES ('kmeans'), ('bisecting')) a(algorithm), range(3, 11) t(k)""",
    "pca_clusters": f"WITH RECURSIVE {separated('100.0 * (label % 5 + 1)')}, "
        + components("parted", 3, "vec_id", "point", 64, ", cluster"),
    "libsvm_kmeans": f"""WITH {PARTED} SELECT DISTINCT part::INT AS lowest, part::INT AS highest, n, {PART_COST} AS cost
        FROM parted""",
    "model_roundtrip": "SELECT vec_id, true AS same FROM embeddings",
    "silhouette_points": f"""WITH {SILHOUETTE} SELECT vec_id, round(intra, 6) AS intra,
        round(nearest, 6) AS nearest, round(silhouette, 6) AS silhouette FROM judged""",
    "silhouette_scale": f"""WITH {SILHOUETTE}
        SELECT count(*) AS n, round(avg(silhouette), 6) AS silhouette FROM judged""",
    "xml_pages": f"""WITH {RAW}, stripped AS (SELECT * EXCLUDE ("revision.text"), nullif({STRIPPED}, '') AS t FROM raw)
        SELECT title, ns, id, "revision.id", "revision.timestamp", "revision.contributor.username",
            "revision.contributor.ip", "revision.sha1", length(t)::INT AS n_chars, sha1(t) AS text_sha1
        FROM stripped""",
    "csv_roundtrip": f"""WITH {RAW} SELECT title, ns, id, "revision.id",
        "revision.contributor.username", "revision.contributor.ip", "revision.sha1",
        length("revision.text")::INT AS n_chars, sha1("revision.text") AS text_sha1 FROM raw""",
    "multi_file_scan": f"""WITH {RAW} SELECT replace(dump, '.', '_') || '_raw.csv' AS file,
        count(*) AS n_pages, sum(length("revision.text"))::BIGINT AS n_chars FROM raw GROUP BY ALL""",
    "features_roundtrip": f"WITH {FEATURES} SELECT * FROM features",
    "features_csv_roundtrip": f"WITH {FEATURES} SELECT * FROM features",
    "text_scan": f"""WITH lines AS (SELECT unnest(string_split(text, {NL})) AS line FROM documents)
        SELECT length(line)::INT AS length, count(*) AS n FROM lines GROUP BY ALL""",
    "libsvm_scan": """SELECT label, embedding[1]::DOUBLE AS first, embedding[64]::DOUBLE AS last,
        round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS squared_norm
        FROM embeddings""",
    "html_first_element": f"SELECT page_id, {element('title')} AS title, {element('h1')} AS h1 FROM pages",
    "html_article_text": over_articles({"text": "text"}),
    "html_first_attr": f"SELECT page_id, {attribute('a', 'href')} AS href FROM pages",
    "html_revision_id": """SELECT doc_id AS page_id,
        CASE WHEN doc_id % 7 <> 0 THEN doc_id + 1000000 END AS revision_id FROM documents""",
}
ORACLES["bucketed_feature_table"] = ORACLES["feature_table"]
ORACLES["merged_totals"] = ORACLES["feature_totals"]
ORACLES["merged_ranges"] = ORACLES["feature_ranges"]
_PROFILED = {
    "format": "revision.format", "model": "revision.model", "ns": "ns", "contributor.username": "revision.contributor.username",
    "contributor.ip": "revision.contributor.ip", "title": "title",
}
ORACLES["sketched_distinct"] = f"WITH {RAW} " + " UNION ALL ".join(
    f"""SELECT '{n}' AS "column", count(*) AS n_rows, count(DISTINCT "{c}") AS n, true AS close FROM raw""" for n, c in _PROFILED.items()
)
ORACLES["sketched_frequent"] = f"WITH {RAW} " + " UNION ALL ".join(
    f"""SELECT '{n}' AS "column", "{_PROFILED[n]}" AS value, count(*) AS n FROM raw WHERE "{_PROFILED[n]}" IS NOT NULL GROUP BY 2"""
    for n in ("format", "model", "ns")
)
