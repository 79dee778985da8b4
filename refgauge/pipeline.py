"""The whole way: dumps to pages, pages to features, features to clusters, pages to reports.

Each step writes a table that the next one reads, so texts are parsed once and counted once,
and everything after the feature table handles rows of numbers only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refgauge import fixed
from refgauge.functions import pages as page_functions
from refgauge.operators import articles, clustering, features, profile, report, scoring
from refgauge.sources import dumps, tables
from refgauge.workspace import passing

PAGES, SCORES, COUNTED, SCORED, PROFILES = "pages", "scores", "counted", "scored", "profiles"
ON = ("dump", "revision_id")  # a revision may be in the dumps of several dates
RAW_PAGES = ", ".join(f"`{name}` string" for name in (
    "title", "ns", "id", "restrictions", "revision.id", "revision.parentid", "revision.timestamp",
    "revision.contributor.username", "revision.contributor.id", "revision.contributor.ip",
    "revision.comment", "revision.model", "revision.format", "revision.text", "revision.sha1",
))


def dump_pattern(date: str) -> str:
    """Names of the raw tables of all dump files of a date."""
    return f"enwiki-{date}-pages-articles-multistream*{tables.RAW_SUFFIX}"


def process_dumps(
    spark: SparkSession, xml_folder: str, folder: str, scores: DataFrame | None = None
) -> None:
    """Write the pages of all dumps in a folder and, given (revision_id, class scores), theirs.

    Scores are looked up in chunks of pages in the order of the dump. They are kept apart from
    the pages: both have the file and the revision id, and texts need not be moved to meet their
    scores. Both tables have a folder for each dump file. A second run, as after one that broke
    off, replaces those of its dumps; other dumps and dates stay.
    """
    tables.write_raw_pages(dumps.read_pages(spark, xml_folder), f"{folder}/{PAGES}", form="parquet")
    if scores is None:
        return
    listed = spark.read.format("binaryFile").option("pathGlobFilter", dumps.DUMP_FILES).load(xml_folder)
    files = listed.select(tables.raw_name(F.substring_index("path", "/", -1)).alias("file")).distinct()
    revisions = raw_pages(spark, folder).join(files, "file", "left_semi").select(
        "file", F.col("id").cast("long").alias("page"), revision_id().alias("revision_id")
    )
    with passing(spark):
        found = scoring.chunked_scores(revisions, scores, order_by=("page",), dump="file")
        tables.write_by_file(found.select("file", "revision_id", *fixed.CLASSES), f"{folder}/{SCORES}")


def raw_pages(spark: SparkSession, folder: str, pattern: str = "*" + tables.RAW_SUFFIX) -> DataFrame:
    return tables.read_raw_pages(spark, f"{folder}/{PAGES}", RAW_PAGES, pattern, form="parquet")


def page_scores(spark: SparkSession, folder: str, date: str | None = None) -> DataFrame:
    """(dump, revision_id, class scores) of all pages, or of those of a date."""
    pattern = dump_pattern(date) if date else "*" + tables.RAW_SUFFIX
    path = f"{folder}/{SCORES}"
    return spark.read.option("basePath", path).parquet(f"{path}/file={pattern}").withColumnRenamed("file", "dump")


def revision_id():
    return F.col("`revision.id`").cast("long")


def page_texts(spark: SparkSession, folder: str, date: str) -> DataFrame:
    """(dump, revision_id, title, text) of all pages of a date."""
    raw = raw_pages(spark, folder, dump_pattern(date)).withColumnRenamed("file", "dump")
    raw = raw.withColumn("revision_id", revision_id())
    return articles.article_columns(articles.strip_prefix(raw), keys=ON)


def create_features(
    spark: SparkSession,
    folder: str,
    date: str,
    scores: bool = True,
    limit: int | None = None,
    debug: bool = False,
    save: bool = True,
) -> DataFrame:
    """The feature table of all articles of a date, written to the folder unless told otherwise.

    `limit` takes the first articles by revision. `debug` takes a few of them and keeps all columns.
    """
    kept = articles.filter_articles(page_texts(spark, folder, date))
    if debug:
        limit = min(limit or features.DEBUG_ROWS, features.DEBUG_ROWS)
    if limit is not None:
        kept = articles.limit_articles(kept, limit, "revision_id")
    found = page_scores(spark, folder, date) if scores else None
    if debug:
        table = features.add_features(kept)
        table = scoring.page_score_join(table, found, ON, ON) if scores else table
    elif scores:
        table = features.scored_feature_table(kept, found, ON)
    else:
        table = features.feature_table(kept, scores=False)
    if not save:
        return table
    path = tables.features_path(folder, date, limited=limit is not None)
    tables.write_features(table, path)
    return tables.read_features(spark, path)


def store_counts(spark: SparkSession, folder: str, date: str, buckets: int = tables.BUCKETS) -> None:
    """Counts of all articles of a date, and their scores, stored so that they meet without being moved.

    Each table is dealt by dump and revision once, when it is written; texts are not. New scores, as of another model,
    need `store_scores` alone, and no counting.
    """
    kept = articles.filter_articles(page_texts(spark, folder, date))
    counted = features.feature_table(kept, scores=False, keys=ON)
    tables.write_bucketed(counted, f"{folder}/{COUNTED}-{date}", ON, buckets)
    store_scores(page_scores(spark, folder, date), folder, date, buckets)


def store_scores(scores: DataFrame, folder: str, date: str, buckets: int = tables.BUCKETS) -> None:
    """Scores by (dump, revision_id) in the layout of the counts of their date."""
    tables.write_bucketed(scores.select(*ON, *fixed.CLASSES), f"{folder}/{SCORED}-{date}", ON, buckets)


def scored_features(spark: SparkSession, folder: str, date: str, buckets: int = tables.BUCKETS) -> DataFrame:
    """The feature table of a date from what `store_counts` has stored, joined bucket by bucket."""
    stored = [tables.read_bucketed(spark, f"{folder}/{name}-{date}", ON, buckets) for name in (COUNTED, SCORED)]
    return features.scored_feature_table(*stored, ON, table=features.stored_counts)


def profile_dumps(spark: SparkSession, folder: str, date: str, buckets: int = tables.BUCKETS) -> None:
    """Keeps the numbers of the features of each dump of a date, which `store_counts` has stored.

    What there is of other dumps and dates stays, and is not looked at.
    """
    counted = tables.read_bucketed(spark, f"{folder}/{COUNTED}-{date}", ON, buckets)
    parts = profile.part_numbers(counted, "dump", fixed.FEATURES).withColumnRenamed("dump", "file")
    tables.write_by_file(parts, f"{folder}/{PROFILES}")


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each dump of any date, for `profile.merged_totals` and `merged_ranges`."""
    return spark.read.parquet(f"{folder}/{PROFILES}")


def best_k(sweep: DataFrame, algorithm: str = "bisecting") -> int:
    return sweep.filter((F.col("algorithm") == algorithm) & F.col("best")).first()["k"]


def get_clusters(
    table: DataFrame,
    model_path: str,
    k: int | None = None,
    ks: Iterable[int] = clustering.SWEEP,
) -> DataFrame:
    """Cluster a feature table, save the model and return the table with the cluster of each row.

    Without `k`, the one with the highest silhouette is taken.
    """
    names = clustering.model_features(table)
    if k is None:
        k = best_k(clustering.k_sweep(table, names, ks))
    model = clustering.fit_clusters(table, names, clustering.bisecting(k))
    clustering.save_model(model, model_path)
    return predict(table, model)


def predict(table: DataFrame, model: PipelineModel | str) -> DataFrame:
    """The table with the cluster of each row, by a fitted model or one saved under a path."""
    fitted = clustering.load_model(model) if isinstance(model, str) else model
    return fitted.transform(table).drop(clustering.RAW, clustering.SCALED)


def assess(pages: DataFrame, scores: DataFrame, titles: Sequence[str] | None = None) -> DataFrame:
    """Report on every page of (revision_id, title, text), or on those of the given titles.

    Where both tables name the dump, pages meet the scores of their own dump.
    """
    on = [c for c in ON if c in pages.columns and c in scores.columns]
    titled = pages.withColumn("title", page_functions.display_title(F.col("title")))
    if titles is not None:
        wanted = [" ".join(part for part in t.split(" ") if part) for t in titles]
        titled = titled.filter(F.col("title").isin(wanted))
    counted = features.feature_table(
        articles.tag_articles(titled), scores=False, keys=on
    )
    return report.article_report(scoring.score_left_join(counted, scores, on, on), on)
