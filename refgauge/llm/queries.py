"""The queries of this folder over whole test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refgauge.llm import (
    byte_bpe,
    content_sort,
    html_blocks,
    jaccard_join,
    line_rules,
    maxent,
    packing,
    quality,
    repair_shards,
    secrets,
    turn_repair,
    warc_shards,
    word_runs,
)
from refgauge.llm.inputs import table
from refgauge.workspace import new_path


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "shards")
    repair_shards.write(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return repair_shards.digests(repair_shards.blocks(spark, path))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), pieces=400_000)


def op3_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extracted(table(spark, sf_dir, "pages"))


def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(table(spark, sf_dir, "documents"), with_text=False)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_components(table(spark, sf_dir, "documents"))


def op6_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.deduplicated(table(spark, sf_dir, "documents"))


def op7_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.learned(docs, table(spark, sf_dir, "labels")))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The .json file holds the vocabulary and merges of the rank file."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.learned_and_scored(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_shards.round_trip(table(spark, sf_dir, "pages"), new_path(spark, "warc"))


def op12_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.digests(word_runs.with_looped_ends(table(spark, sf_dir, "documents")))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.digests(turn_repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_repair_shards": op1_repair_shards,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_blocks": op3_html_blocks,
    "op4_line_rules": op4_line_rules,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_content_sort": op6_content_sort,
    "op7_subword_quality": op7_subword_quality,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_maxent_scores": op9_maxent_scores,
    "op10_secret_scan": op10_secret_scan,
    "op11_warc_shards": op11_warc_shards,
    "op12_repair_runs": op12_repair_runs,
    "op13_turn_repair": op13_turn_repair,
}

CONTENT_SORT = r"""
WITH rows AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""

# The symbols, marks, labels and phrases are those of `line_rules`.
LINE_RULES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents
), words AS (
    SELECT row, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs
), windows AS (
    SELECT row, unnest(range(1, len(w) - 1)) AS pos,
           unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g
    FROM words WHERE len(w) >= 3
), often AS (
    SELECT row, pos FROM windows QUALIFY count(*) OVER (PARTITION BY row, g) > 1
), covered AS (
    SELECT row, count(DISTINCT pos + d) AS n FROM often, range(3) r(d) GROUP BY row
), split AS (
    SELECT row, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM docs
), lines AS (
    SELECT row, line, pos, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n,
           length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
           length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
           len(regexp_extract_all(line, '[!?][!?]+([\x20\x09-\x0D]|$)')) AS shouted,
           len(regexp_extract_all(line, '[\s\p{{Z}}\x0B\x1C-\x1F\x{{85}}][|»›•·>/][\s\p{{Z}}\x0B\x1C-\x1F\x{{85}}]')) + 1 AS pieces,
           len(list_filter(regexp_split_to_array(line, '[\s\p{{Z}}\x0B\x1C-\x1F\x{{85}}]+'), lambda x:
               list_contains({sorted(line_rules.LABELS)}, lower(trim(x, '.,:;!?'))))) AS labels,
           regexp_matches(line, '[.!?…:;。！？]') AS marked, regexp_matches(line, '{line_rules.NOTICES.pattern}') AS notice
    FROM split
), judged AS (
    SELECT *, row_number() OVER (PARTITION BY row, line ORDER BY pos) > 1 AS copy,
           10 * symbols > n OR 10 * shouted >= 3 * n OR (n >= 40 AND NOT marked)
           OR (pieces >= 4 AND n - pieces + 1 <= 4 * pieces) OR (n <= 8 AND 5 * labels >= 4 * n)
           OR (n <= {line_rules.NOTICE_WORDS} AND notice) AS fails
    FROM lines WHERE n > 0
), sums AS (
    SELECT row, count(*) FILTER (copy) AS copies, sum(chars) FILTER (NOT copy AND NOT fails) AS kept FROM judged GROUP BY row
), counts AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(copies, 0) AS n_dup_lines,
           coalesce(covered.n, 0) AS n_repeat_words, coalesce(kept, 0)::BIGINT AS kept_chars
    FROM docs JOIN words USING (row) LEFT JOIN covered USING (row) LEFT JOIN sums USING (row)
), failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT *, NOT base_failed AND 2 * kept_chars >= word_chars AS kept FROM failed
"""

JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
    FROM words
), grams AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION SELECT r.x, p.y FROM reached r JOIN pairs p ON r.y = p.x
)
SELECT doc_id, len(s) AS n_shingles, (SELECT min(y) FROM reached WHERE x = doc_id) AS component_id FROM sets
"""

ORACLES: dict[str, str] = {
    "op4_line_rules": LINE_RULES,
    "op5_jaccard_join": JACCARD_JOIN,
    "op6_content_sort": CONTENT_SORT,
}
