"""Feature tables: one narrow pass over the article texts, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refgauge import fixed
from refgauge.functions import markup
from refgauge.operators.articles import has_column
from refgauge.operators.scoring import page_score_join

DEBUG_ROWS = 50


def counts(text: Column) -> dict[str, Column]:
    """Every count taken from the text alone."""
    out = {"n_words": markup.n_words(text)}
    for level in fixed.HEADING_LEVELS:
        out[f"level{level}"] = markup.heading_count(text, level)
    for source in fixed.CITATION_SOURCES:
        out[f"{source}_citations"] = markup.citation_count(text, source)
    out["n_internal_links"] = markup.n_internal_links(text)
    out["n_external_links"] = markup.n_external_links(text)
    out["n_paragraphs"] = markup.n_paragraphs(text)
    out["n_unreferenced"] = markup.n_unreferenced(text)
    out["n_images"] = markup.n_images(text)
    return out


def link_averages(df: DataFrame) -> DataFrame:
    """Links per paragraph. With one paragraph its count is 0, so these get very large."""
    paragraphs = F.col("n_paragraphs")
    return df.withColumns({
        "average_internal_links": markup.per_paragraph(F.col("n_internal_links"), paragraphs),
        "average_external_links": markup.per_paragraph(F.col("n_external_links"), paragraphs),
    })


def add_features(df: DataFrame) -> DataFrame:
    """All features next to the columns of `df`, nothing dropped."""
    return link_averages(df.withColumns(counts(F.col("text"))))


def feature_table(
    df: DataFrame,
    scores: bool = True,
    keys: Sequence[str] = (),
    project: bool = True,
    debug: bool = False,
) -> DataFrame:
    """Title, features, scores and tags if there are any, as doubles; rows with NULLs dropped.

    A feature is NULL exactly if the text is, so the inputs are tested, before any counting.
    `keys` are carried along as they are. `project=False` and `debug=True` keep all columns
    and rows; `debug` takes a few rows only, the first by title.
    """
    if debug:
        return add_features(df.orderBy("title").limit(DEBUG_ROWS))
    if not project:
        return add_features(df)
    labels = list(fixed.CLASSES) if scores else []
    tags = list(fixed.TAGS) if has_column(df, fixed.TAGS[0]) else []
    whole = present(df, ["title", "text", *labels, *tags])
    numbers = [*fixed.FEATURES, *labels, *tags]
    return add_features(whole).select(
        *keys, "title", *[F.col(c).cast("double").alias(c) for c in numbers]
    )


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without NULL in any of the columns, as plain tests that reach the scan."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns]))


def counts_v1(text: Column) -> dict[str, Column]:
    """The counts of the earlier feature table: simpler headings and paragraphs, categories."""
    out = {"n_words": markup.n_words(text)}
    for level in fixed.HEADING_LEVELS:
        out[f"level{level}"] = markup.heading_count_v1(text, level)
    for source in ("book", "journal"):
        out[f"{source}_citations"] = markup.citation_count(text, source)
    out["n_internal_links"] = markup.n_internal_links(text)
    out["n_external_links"] = markup.n_external_links(text)
    out["n_paragraphs"] = markup.n_paragraphs_v1(text)
    out["n_unreferenced"] = markup.n_unreferenced(text)
    out["n_categories"] = markup.n_categories(text)
    out["n_images"] = markup.n_images(text)
    return out


def feature_table_v1(df: DataFrame, scores: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """The earlier feature table: title, scores if there are any, features."""
    labels = list(fixed.CLASSES) if scores else []
    whole = present(df, ["title", "text", *labels]).withColumns(counts_v1(F.col("text")))
    numbers = [*labels, *fixed.FEATURES_V1]
    return whole.select(*keys, "title", *[F.col(c).cast("double").alias(c) for c in numbers])


def stored_counts(df: DataFrame, scores: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """For tables of counts: what `feature_table` gives for pages."""
    return df.select(*keys, "title", *fixed.FEATURES)


def scored_feature_table(
    pages: DataFrame,
    scores: DataFrame,
    key: str | Sequence[str] = "revision_id",
    keys: Sequence[str] = (),
    table: Callable[..., DataFrame] = feature_table,
) -> DataFrame:
    """A feature table of the pages that have scores.

    Features are counted where the pages are read, and joined with the scores after that:
    a row of numbers goes through the shuffle, the text does not.
    """
    on = [key] if isinstance(key, str) else list(key)
    carried = list(dict.fromkeys([*on, *keys]))
    features = table(pages, scores=False, keys=carried)
    counted = [c for c in features.columns if c not in (*carried, "title")]
    labeled = page_score_join(features, present(scores, fixed.CLASSES), on, on)
    return labeled.select(*keys, "title", *counted, *fixed.CLASSES)
