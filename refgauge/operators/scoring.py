"""Joins of pages with class scores by revision."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refgauge import fixed
from refgauge.functions import scores
from refgauge.operators.positions import with_position


def page_score_join(
    pages: DataFrame, scores: DataFrame, page_key: str | Sequence[str] = "revision_id",
    score_key: str | Sequence[str] = "revision_id",
) -> DataFrame:
    """Pages with the scores of their revision; pages without any are dropped.

    Keys may be lists of columns, such as the file and the revision, if they are named alike.

    Both sides are hashed on the key once. Neither side is forced into a broadcast: the score
    table grows with the pages, so Spark decides by its size, and splits skewed partitions.
    """
    return _join(pages, scores, page_key, score_key, "inner")


def score_left_join(
    pages: DataFrame, scores: DataFrame, page_key: str | Sequence[str] = "revision_id",
    score_key: str | Sequence[str] = "revision_id",
) -> DataFrame:
    """Pages with the scores of their revision, NULL where there are none."""
    return _join(pages, scores, page_key, score_key, "left")


def _join(pages, scores, page_key, score_key, how):
    if page_key == score_key:
        on = [page_key] if isinstance(page_key, str) else list(page_key)
        return pages.join(scores, on, how)
    other = scores.withColumnRenamed(score_key, "_score_key")
    return pages.join(other, F.col(page_key) == F.col("_score_key"), how).drop("_score_key")


def unpack_responses(responses: DataFrame, wiki: str, response: str = "response") -> DataFrame:
    """(revision_id, class scores) of every revision that the score responses speak of."""
    each = responses.select(F.explode(scores.answers(F.col(response), wiki)).alias("revision_id", "answer"))
    found = scores.probabilities(F.col("answer"))
    return each.select(F.col("revision_id").cast("long"), *scores.class_columns(found))


def union_scores(parts: Sequence[DataFrame]) -> DataFrame:
    """Score tables on top of each other, matched by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def chunked_scores(
    revisions: DataFrame,
    scores: DataFrame,
    order_by: Sequence[str] = ("revision_id",),
    dump: str | None = None,
    chunk: int = fixed.SCORE_CHUNK,
) -> DataFrame:
    """Scores looked up for chunks of rows in order: one missing score blanks its whole chunk.

    `dump` names the column of the dump file, within which the chunks start anew. Of several score
    rows of a revision the largest counts, scored before unscored. Pass narrow rows here and join
    texts on afterwards.
    """
    best = F.max(F.struct(*fixed.CLASSES)).alias("_best")
    scores = scores.groupBy("revision_id").agg(best).select("revision_id", "_best.*")
    # Numbered before the join: the ranges are sampled, and a scan is cheap to go through twice.
    placed = score_left_join(with_position(revisions, order_by, within=dump), scores)
    keys = [*([dump] if dump else []), "_chunk"]
    placed = placed.withColumn("_chunk", F.floor(F.col("position") / F.lit(chunk)))
    # A chunk never holds more than `chunk` rows, however the input is distributed.
    every = Window.partitionBy(*keys)
    present = F.col(fixed.CLASSES[0]).isNotNull()
    kept = placed.withColumn("_complete", F.min(present).over(every))
    return kept.select(
        *revisions.columns,
        *[F.when(F.col("_complete"), F.col(c)).alias(c) for c in fixed.CLASSES],
    )


def revision_at_time(
    wanted: DataFrame, revisions: DataFrame, keys: Sequence[str] = ("title", "timestamp")
) -> DataFrame:
    """The revision of a title at an exact time, where there is just one.

    Revisions are counted per key before the join, so a title with many of them stays small.
    """
    single = (
        revisions.groupBy(*keys)
        .agg(F.count("*").alias("_n"), F.max("revision_id").alias("revision_id"))
        .filter(F.col("_n") == 1)
        .drop("_n")
    )
    return wanted.join(single, list(keys), "inner")
