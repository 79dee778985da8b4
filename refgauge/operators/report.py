"""Assessment of every article: what it is, what it cites, how good it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refgauge import fixed
from refgauge.functions import scores


def reference_mix(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Four rows per page: citation sources ranked by count, with their share in percent."""
    return df.select(*keys, F.inline(scores.citation_shares()))


def predicted_class(df: DataFrame) -> DataFrame:
    return df.withColumn("predicted_class", scores.predicted_class())


def cluster_report(df: DataFrame, cluster: str = "prediction") -> DataFrame:
    """What the cluster of a page says about it, for a model of three clusters."""
    return df.withColumn("cluster_note", scores.lookup(F.col(cluster), fixed.CLUSTER_SENTENCES))


def article_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per page of a tagged feature table.

    A page that is no article gets a note on what it is. An article gets the lines of its
    citation mix and the sentence of its class.
    """
    kind = F.coalesce(*[F.when(F.col(t).cast("boolean"), F.lit(t)) for t in fixed.TAGS])
    # Percents are rounded half to even and padded to four places; no citations gives nan.
    percent = lambda x: F.coalesce(F.bround(x["percent"], 0).cast("int").cast("string"), F.lit("nan"))
    lines = F.transform(scores.citation_shares(), lambda x: F.concat(
        F.lit("  > "), F.lpad(percent(x), 4, " "), F.lit("% "),
        scores.lookup(x["source"], fixed.CITATION_NAMES),
    ))
    named = df.withColumns({"kind": kind, "predicted_class": scores.predicted_class()})
    article = F.col("kind").isNull()
    return named.select(
        *keys,
        "title",
        "kind",
        scores.lookup(F.col("kind"), fixed.TAG_SENTENCES).alias("note"),
        F.when(article, F.concat_ws("\n", F.lit(fixed.MIX_TITLE), lines)).alias("mix"),
        F.when(article, F.col("predicted_class")).alias("predicted_class"),
        F.when(article, scores.lookup(F.col("predicted_class"), fixed.CLASS_SENTENCES)).alias("verdict"),
    )
