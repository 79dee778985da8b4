"""Article table: column choice, renames, tags and the article filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refgauge import fixed
from refgauge.functions import pages


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def strip_prefix(df: DataFrame, prefix: str = "revision.", drop: str = "revision.id") -> DataFrame:
    """`revision.x` becomes `x`; `drop` goes first, as a column `id` is there already."""
    names = {c: c[len(prefix):] for c in df.columns if c.startswith(prefix) and c != drop}
    return df.drop(drop).withColumnsRenamed(names)


def article_columns(
    df: DataFrame, scores: bool = False, revision: bool = False, keys: Sequence[str] = ()
) -> DataFrame:
    """Title and text, with hash and time of the revision, or the class scores, if asked for."""
    head = ["sha1", "timestamp"] if revision else []
    return df.select(*keys, *head, "title", "text", *(fixed.CLASSES if scores else ()))


def rename_positions(df: DataFrame, n_features: int) -> DataFrame:
    """Columns named by position become `features_<i>` and, for the last one, `labels`."""
    names = {str(i): f"features_{i}" for i in range(n_features)}
    return df.withColumnsRenamed(names | {str(n_features): "labels"})


def lower_all(df: DataFrame) -> DataFrame:
    return df.select([F.lower(F.col(f"`{c}`")).alias(c) for c in df.columns])


def filter_articles(df: DataFrame) -> DataFrame:
    """Rows of articles only; NULL title or text counts as no article."""
    return df.filter(pages.is_article(F.col("title"), F.col("text")))


def tag_articles(df: DataFrame) -> DataFrame:
    """One boolean column per kind of page that is not an article."""
    return df.withColumns(pages.page_tags(F.col("title"), F.col("text")))


def article_kind(df: DataFrame) -> DataFrame:
    """The first tag that holds in `kind`, NULL for an article."""
    tags = (
        {tag: F.col(tag) for tag in fixed.TAGS}
        if has_column(df, fixed.TAGS[0])
        else pages.page_tags(F.col("title"), F.col("text"))
    )
    return df.withColumn("kind", pages.first_tag(tags))


def limit_articles(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """The first `n` rows by a column; a debugging aid."""
    return df.orderBy(order_by).limit(n)


def string_columns(df: DataFrame) -> DataFrame:
    return df.select([f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
