"""One query per operator: name -> function of (session, folder with the parquet tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refgauge import fixed
from refgauge.functions import html, markup, pages, scores
from refgauge.operators import articles, clustering, features, profile, report, scoring
from refgauge.plans import rendered
from refgauge.sources import dumps, tables
from refgauge.workspace import new_path, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# What identifies a page in feature tables.
KEYS = ("page_id",)
N_DIMENSIONS = 64
RAW_SCHEMA = (
    "title string, ns string, id string, `revision.id` string, `revision.timestamp` string, "
    "`revision.contributor.username` string, `revision.contributor.ip` string, "
    "`revision.model` string, `revision.format` string, `revision.text` string, "
    "`revision.sha1` string"
)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _rounded_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in fixed.CLASSES})


# --- text features -------------------------------------------------------------------------


def _counted(name: str, **columns: Callable) -> None:
    """Register a query of counts over every article, `page_id` first."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = rendered.articles(spark, folder)
        return df.select("page_id", *[c(F.col("text")).alias(n) for n, c in columns.items()])

    QUERIES[name] = run


_counted("n_words", n_words=markup.n_words)
_counted("n_unique_words", words_count=markup.n_words)
_counted("headings", **{
    f"level{k}": lambda t, k=k: markup.heading_count(t, k) for k in fixed.HEADING_LEVELS
})
_counted("headings_v1", **{
    f"level{k}": lambda t, k=k: markup.heading_count_v1(t, k) for k in fixed.HEADING_LEVELS
})
_counted("citations", **{
    f"{s}_citations": lambda t, s=s: markup.citation_count(t, s) for s in fixed.CITATION_SOURCES
})
_counted("citations_cs", **{
    f"{s}_citations": lambda t, s=s: markup.citation_count(t, s, any_case=False)
    for s in fixed.CITATION_SOURCES
})
_counted("citations_space", **{
    f"{s}_citations": lambda t, s=s: markup.citation_count(t, s, space=True)
    for s in ("book", "journal")
})
_counted("internal_links", n_internal_links=markup.n_internal_links)
_counted("external_links", n_external_links=markup.n_external_links)
_counted("paragraphs", n_paragraphs=markup.n_paragraphs)
_counted("paragraphs_v1", n_paragraphs=markup.n_paragraphs_v1)
_counted("unreferenced", n_unreferenced=markup.n_unreferenced)
_counted("images", n_images=markup.n_images)
_counted("first_lines", first_lines=markup.first_lines)


@query
def categories(spark, folder):
    df = rendered.categorized(spark, folder)
    return df.select("page_id", markup.n_categories(F.col("text")).alias("n_categories"))


@query
def link_averages(spark, folder):
    df = rendered.articles(spark, folder)
    text = F.col("text")
    return features.link_averages(df.select(
        "page_id",
        markup.n_internal_links(text).alias("n_internal_links"),
        markup.n_external_links(text).alias("n_external_links"),
        markup.n_paragraphs(text).alias("n_paragraphs"),
    ))


@query
def split_digits(spark, folder):
    customers = rendered.table(spark, folder, "customer")
    return customers.select(
        "c_custkey",
        F.array_join(markup.split_digits(F.col("c_name")), "|").alias("pieces"),
        markup.n_level4_pieces(F.col("c_name")).alias("n_pieces"),
    )


@query
def level4_pieces(spark, folder):
    df = rendered.articles(spark, folder)
    return df.select("page_id", markup.n_level4_pieces(F.col("text")).alias("n_pieces"))


# --- article table -------------------------------------------------------------------------


@query
def filter_articles(spark, folder):
    return articles.filter_articles(rendered.articles(spark, folder)).select("page_id", "title")


@query
def tag_articles(spark, folder):
    return articles.tag_articles(rendered.articles(spark, folder)).drop("text")


@query
def article_kind(spark, folder):
    return articles.article_kind(rendered.articles(spark, folder)).select("page_id", "kind")


@query
def article_columns(spark, folder):
    """Hash, time, title, text and scores of all scored pages; the text as its length and hash."""
    raw = articles.strip_prefix(rendered.raw_pages(spark, folder).withColumns({
        "revision_id": F.col("`revision.id`").cast("long"),
        "n_chars": F.char_length("`revision.text`"),
        "revision.text": F.sha1("`revision.text`"),
    }))
    joined = scoring.page_score_join(raw, rendered.scores(spark, folder))
    chosen = articles.article_columns(joined, scores=True, revision=True, keys=("n_chars",))
    return _rounded_scores(chosen)


@query
def strip_prefix(spark, folder):
    return articles.strip_prefix(rendered.raw_pages(spark, folder, texts=False))


@query
def rename_columns(spark, folder):
    """Four coordinates and a label under position names, renamed."""
    vectors = rendered.table(spark, folder, "embeddings")
    numbered = vectors.select(
        "vec_id",
        *[F.get("embedding", F.lit(i)).cast("double").alias(str(i)) for i in range(4)],
        F.col("label").alias("4"),
    )
    return articles.rename_positions(numbered, 4)


@query
def lower_all(spark, folder):
    return articles.lower_all(articles.string_columns(rendered.table(spark, folder, "part")))


@query
def normalize_title(spark, folder):
    """Titles with untidy spaces, in both written forms."""
    untidy = rendered.titles(spark, folder).select(
        "page_id",
        F.concat(F.lit("  "), F.replace("title", F.lit(" "), F.lit("   ")), F.lit(" ")).alias("title"),
    )
    return untidy.select(
        "page_id",
        pages.url_title(F.col("title")).alias("url_title"),
        pages.display_title(F.col("title")).alias("display_title"),
    )


@query
def limit_articles(spark, folder):
    df = rendered.titles(spark, folder).select("page_id", "title")
    return articles.limit_articles(df, features.DEBUG_ROWS, "page_id")


# --- feature tables ------------------------------------------------------------------------


def _features(spark, folder) -> DataFrame:
    """Unscored feature table of all articles, with their id."""
    kept = articles.filter_articles(rendered.articles(spark, folder))
    return features.feature_table(kept, scores=False, keys=KEYS)


@query
def feature_table(spark, folder):
    kept = articles.filter_articles(rendered.revised(spark, folder))
    return _rounded_scores(features.scored_feature_table(kept, rendered.scores(spark, folder)))


@query
def bucketed_feature_table(spark, folder):
    """The feature table from counts and scores that are stored by revision and joined bucket by bucket."""
    kept = articles.filter_articles(rendered.revised(spark, folder))
    counted = features.feature_table(kept, scores=False, keys=("revision_id",))
    stored = []
    for name, df in (("counted", counted), ("scored", rendered.scores(spark, folder))):
        path = new_path(spark, name)
        tables.write_bucketed(df, path, ["revision_id"], 8)
        stored.append(tables.read_bucketed(spark, path, ["revision_id"], 8))
    return _rounded_scores(features.scored_feature_table(*stored, table=features.stored_counts))


@query
def feature_table_v1(spark, folder):
    df = rendered.categorized(spark, folder).withColumn(
        "revision_id", rendered.revision_of(F.col("page_id"))
    )
    return _rounded_scores(features.scored_feature_table(
        df, rendered.scores(spark, folder), table=features.feature_table_v1
    ))


@query
def tagged_feature_table(spark, folder):
    """Features of all pages, articles or not, with their tags."""
    tagged = articles.tag_articles(rendered.articles(spark, folder))
    return features.feature_table(tagged, scores=False)


@query
def feature_totals(spark, folder):
    counted = [f for f in fixed.FEATURES if not f.startswith("average")]
    return profile.feature_totals(_features(spark, folder), counted)


@query
def feature_ranges(spark, folder):
    return profile.feature_ranges(_features(spark, folder), fixed.FEATURES)


def _parts(spark, folder) -> DataFrame:
    """Numbers of the features of each of three dumps, stored."""
    dumped = _features(spark, folder).withColumn("dump", F.col("page_id") % 3)
    return written(profile.part_numbers(dumped, "dump", fixed.FEATURES), "parts")


@query
def merged_totals(spark, folder):
    """Totals out of what is stored for each dump."""
    counted = [f for f in fixed.FEATURES if not f.startswith("average")]
    return profile.merged_totals(_parts(spark, folder), counted)


@query
def merged_ranges(spark, folder):
    """Ranges out of what is stored for each dump."""
    return profile.merged_ranges(_parts(spark, folder), fixed.FEATURES)


def _sketched(spark, folder) -> tuple[DataFrame, DataFrame]:
    pages = articles.strip_prefix(rendered.raw_pages(spark, folder, texts=False))
    names = [*fixed.PROFILE_COLUMNS, "title"]
    return pages, written(profile.part_sketches(pages, "dump", names), "sketches")


@query
def sketched_distinct(spark, folder):
    """Distinct values of each column, and whether merged sketches of the dumps come within 5 % of them."""
    pages, sketches = _sketched(spark, folder)
    exact = profile.column_profile(pages, [*fixed.PROFILE_COLUMNS, "title"]).filter("value IS NOT NULL")
    exact = exact.groupBy("column").agg(F.count("*").alias("n"))
    close = F.abs(F.col("n_distinct") - F.col("n")) <= 0.05 * F.col("n")
    return profile.merged_distinct(sketches).join(exact, "column").select("column", "n_rows", "n", close.alias("close"))


@query
def sketched_frequent(spark, folder):
    """The values of columns with few of them, and how often each comes, out of merged sketches of the dumps."""
    _, sketches = _sketched(spark, folder)
    return profile.merged_frequent(sketches.filter(F.col("column").isin("format", "model", "ns")))


@query
def column_profile(spark, folder):
    return profile.column_profile(articles.strip_prefix(rendered.raw_pages(spark, folder, texts=False)))


# --- scores --------------------------------------------------------------------------------


@query
def page_score_join(spark, folder):
    df = rendered.titles(spark, folder)
    return _rounded_scores(scoring.page_score_join(df, rendered.scores(spark, folder)))


@query
def score_left_join(spark, folder):
    df = rendered.titles(spark, folder)
    return _rounded_scores(scoring.score_left_join(df, rendered.scores(spark, folder)))


@query
def chunked_scores(spark, folder):
    revisions = rendered.table(spark, folder, "documents").select(
        rendered.revision_of(F.col("doc_id")).alias("revision_id")
    )
    return _rounded_scores(scoring.chunked_scores(revisions, rendered.scores(spark, folder)))


@query
def chunked_scores_by_dump(spark, folder):
    """Chunks that start anew in each dump file."""
    doc = F.col("doc_id")
    revisions = rendered.table(spark, folder, "documents").select(
        rendered.revision_of(doc).alias("revision_id"), (doc % 3 + 1).cast("int").alias("dump")
    )
    found = scoring.chunked_scores(revisions, rendered.scores(spark, folder), dump="dump")
    return _rounded_scores(found)


@query
def revision_at_time(spark, folder):
    """The revision current at 2019-07-01 00:00, of titles with just one at that time."""
    docs = rendered.table(spark, folder, "documents")
    start = F.to_timestamp(F.lit("2019-07-01 00:00:00"))
    doc, r = F.col("doc_id"), F.col("r")
    revisions = docs.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("r")).select(
        rendered.title().alias("title"),
        (start + F.make_dt_interval(hours=(r * (doc % 2)).cast("int"))).alias("timestamp"),
        (doc * 3 + r).alias("revision_id"),
    )
    wanted = docs.select(rendered.title().alias("title"), start.alias("timestamp"))
    return scoring.revision_at_time(wanted, revisions).select("title", "revision_id")


@query
def union_scores(spark, folder):
    """Score tables of two halves, columns in another order, on top of each other."""
    every = rendered.scores(spark, folder)
    even = every.filter(F.col("revision_id") % 2 == 0)
    odd = every.filter(F.col("revision_id") % 2 == 1).select(
        *sorted(fixed.CLASSES), "revision_id"
    )
    return _rounded_scores(scoring.union_scores([even, odd]))


@query
def weighted_score(spark, folder):
    by_class = F.create_map(*[x for c in fixed.CLASSES for x in (F.lit(c), F.col(c))])
    return rendered.scores(spark, folder).select(
        "revision_id",
        F.round(scores.weighted_score(), 9).alias("weighted_score"),
        F.round(scores.weighted_score_of_map(by_class), 9).alias("weighted_score_of_map"),
    )


@query
def score_json(spark, folder):
    responses = rendered.score_responses(spark, folder)
    return _rounded_scores(scoring.unpack_responses(responses, "enwiki"))


@query
def predicted_class(spark, folder):
    return report.predicted_class(rendered.scores(spark, folder)).select(
        "revision_id", "predicted_class"
    )


@query
def reference_mix(spark, folder):
    counted = _features(spark, folder)
    return report.reference_mix(counted, KEYS).select(
        "page_id", "rank", "source", F.col("n").cast("int").alias("n"),
        F.round("percent", 9).alias("percent"),
    )


@query
def article_report(spark, folder):
    tagged = articles.tag_articles(rendered.revised(spark, folder))
    counted = features.feature_table(tagged, scores=False, keys=("page_id", "revision_id"))
    scored = scoring.score_left_join(counted, rendered.scores(spark, folder))
    return report.article_report(scored, KEYS)


# --- scaling, clusters, reduction ----------------------------------------------------------


def _stored_features(spark, folder) -> DataFrame:
    """The feature table from files: fits pass over it many times, over the texts just once."""
    return written(_features(spark, folder), "features")


def _scaled(spark, folder) -> DataFrame:
    return clustering.scaled(_stored_features(spark, folder), fixed.FEATURES).select(
        *KEYS, clustering.RAW, clustering.SCALED
    )


def _points(spark, folder) -> DataFrame:
    """(vec_id, label, point): the embeddings as arrays of doubles."""
    return rendered.table(spark, folder, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("point")
    )


@query
def minmax_scaled(spark, folder):
    value = vector_to_array(clustering.SCALED)
    return _scaled(spark, folder).select("page_id", *[
        F.round(F.get(value, F.lit(i)), 9).alias(name) for i, name in enumerate(fixed.FEATURES)
    ])


def _parted(spark, folder, **options) -> DataFrame:
    """Points in five parts that lie far apart, as stored vectors."""
    points = rendered.separated(spark, folder, **options)
    return written(points.withColumn(clustering.RAW, array_to_vector("point")), "points")


def _named(placed: DataFrame) -> DataFrame:
    """Clusters named by their least member, as numbers of clusters are arbitrary."""
    names = placed.groupBy(clustering.CLUSTER).agg(F.min("vec_id").alias("cluster"))
    return placed.join(names, clustering.CLUSTER)


@query
def kmeans_predict(spark, folder):
    points = _parted(spark, folder)
    placed = clustering.kmeans(5, vectors=clustering.RAW).fit(points).transform(points)
    return _named(placed).select("vec_id", "cluster")


@query
def bisecting_predict(spark, folder):
    points = _parted(spark, folder)
    placed = clustering.bisecting(5, vectors=clustering.RAW).fit(points).transform(points)
    return _named(placed).select("vec_id", "cluster")


@query
def kmeans_cost(spark, folder):
    points = _parted(spark, folder)
    model = clustering.kmeans(5, vectors=clustering.RAW).fit(points)
    cost = clustering.cluster_cost(points, model, clustering.RAW)
    return cost.select("k", F.round("cost", 4).alias("cost"), F.round("nearest_cost", 4).alias("nearest_cost"))


@query
def cluster_centers(spark, folder):
    """Every coordinate of every center, next to the mean of the cluster's rows."""
    points = _parted(spark, folder)
    model = clustering.bisecting(5, vectors=clustering.RAW).fit(points)
    names = _named(model.transform(points)).groupBy(clustering.CLUSTER).agg(F.first("cluster").alias("cluster"))
    centers = clustering.cluster_centers(points, model, clustering.RAW).join(names, clustering.CLUSTER)
    return centers.select(
        "cluster", "n", F.posexplode(F.arrays_zip("center", "mean")).alias("dim", "at")
    ).select("cluster", "n", "dim", F.round("at.center", 6).alias("center"), F.round("at.mean", 6).alias("mean"))


@query
def k_sweep(spark, folder):
    """For each k the k that is best; the cost at five parts, and that more clusters cost no more."""
    points = _parted(spark, folder)
    names = [f"e{i}" for i in range(N_DIMENSIONS)]
    table = points.select(*[F.get("point", F.lit(i)).alias(name) for i, name in enumerate(names)])
    found = clustering.k_sweep(table, names)
    at_five = Window.partitionBy("algorithm")
    five = F.max(F.when(F.col("k") == 5, F.col("cost"))).over(at_five)
    return found.select(
        "algorithm", "k", "best", F.when(F.col("k") == 5, F.round("cost", 4)).alias("cost"),
        F.when(F.col("k") > 5, F.col("cost") <= five).alias("no_more"),
    )


@query
def nearest_center(spark, folder):
    """Each embedding and the closest of the mean points of the labels."""
    points = _points(spark, folder)
    centers = clustering.group_centers(points, "label", "point")
    return clustering.nearest_center(points, centers, "point").select(
        "vec_id", clustering.CLUSTER, F.round("cost", 6).alias("cost")
    )


@query
def cluster_report(spark, folder):
    """Each embedding, the closest of three group centers, and the sentence of that cluster."""
    points = _points(spark, folder)
    centers = clustering.group_centers(points.withColumn("part", F.col("label") % 3), "part", "point")
    placed = clustering.nearest_center(points, centers, "point")
    return report.cluster_report(placed).select("vec_id", clustering.CLUSTER, "cluster_note")


@query
def cluster_label(spark, folder):
    """Rows without a quality label take the most common one of their nearest center."""
    points = _points(spark, folder)
    centers = clustering.group_centers(points, "label", "point")
    placed = clustering.nearest_center(points, centers, "point").select("vec_id", clustering.CLUSTER)
    known = rendered.table(spark, folder, "labels").select(F.col("doc_id").alias("vec_id"), "quality")
    return clustering.cluster_label(placed.join(known, "vec_id", "left"), "quality").select(
        "vec_id", clustering.CLUSTER, "quality", "cluster_label", "label_or_cluster"
    )


@query
def silhouette_points(spark, folder):
    """Silhouette of each embedding for the clusters its label gives."""
    points = clustering.silhouette_points(_points(spark, folder), "point", "label")
    return points.select(
        "vec_id", *[F.round(c, 6).alias(c) for c in ("intra", "nearest", "silhouette")]
    )


@query
def silhouette_scale(spark, folder):
    """Mean silhouette of the embeddings for the clusters their labels give."""
    points = _points(spark, folder).select("label", array_to_vector("point").alias("point"))
    value = clustering.silhouette(points, "point", "label")
    return points.agg(F.count("*").alias("n"), F.lit(round(value, 6)).alias("silhouette"))


def _rounded_points(df: DataFrame, digits: int) -> DataFrame:
    # Adding zero turns a rounded -0.0 into 0.0.
    return df.select("page_id", *[(F.round(c, digits) + F.lit(0.0)).alias(c) for c in ("pc1", "pc2")])


@query
def pca_scaled(spark, folder):
    points = clustering.pca_points(_scaled(spark, folder), clustering.SCALED, KEYS, upright=True)
    return _rounded_points(points, 6)


@query
def pca_raw(spark, folder):
    """Unscaled components reach 1e9, so they are compared to the thousands."""
    points = clustering.pca_points(_scaled(spark, folder), clustering.RAW, KEYS, upright=True)
    return _rounded_points(points, -3)


@query
def pca_clusters(spark, folder):
    """Two components of points in five parts, with their cluster."""
    points = _parted(spark, folder, own=True)
    placed = _named(clustering.bisecting(5, vectors=clustering.RAW).fit(points).transform(points))
    found = clustering.pca_points(placed, clustering.RAW, ("vec_id", "cluster"), upright=True)
    return found.select("vec_id", "cluster", *[(F.round(c, 3) + F.lit(0.0)).alias(c) for c in ("pc1", "pc2")])


# --- sources and sinks ---------------------------------------------------------------------


@query
def xml_pages(spark, folder):
    """Page rows written as an XML dump and read back, text as its length and hash."""
    raw = rendered.raw_pages(spark, folder)
    path = new_path(spark, "dump")
    raw.select(
        "title", "ns", "id",
        F.struct(
            F.col("`revision.id`").alias("id"),
            F.col("`revision.timestamp`").alias("timestamp"),
            F.struct(
                F.col("`revision.contributor.username`").alias("username"),
                F.col("`revision.contributor.ip`").alias("ip"),
            ).alias("contributor"),
            F.col("`revision.model`").alias("model"),
            F.col("`revision.format`").alias("format"),
            F.struct(
                F.col("`revision.text`").alias("_VALUE"),
                F.octet_length("`revision.text`").alias("_bytes"),
            ).alias("text"),
            F.col("`revision.sha1`").alias("sha1"),
        ).alias("revision"),
    ).write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)
    text = F.col("`revision.text`")
    return dumps.read_pages(spark, path).select(
        "title", "ns", "id", "`revision.id`", "`revision.timestamp`",
        "`revision.contributor.username`", "`revision.contributor.ip`",
        "`revision.sha1`",
        F.char_length(text).alias("n_chars"), F.sha1(text).alias("text_sha1"),
    )


def _raw_files(spark, folder) -> str:
    path = new_path(spark, "raw")
    tables.write_raw_pages(rendered.raw_pages(spark, folder), path)
    return path


@query
def csv_roundtrip(spark, folder):
    """Raw pages written as CSV and read back, text as its length and hash."""
    raw = tables.read_raw_pages(spark, _raw_files(spark, folder), RAW_SCHEMA)
    text = F.col("`revision.text`")
    return raw.select(
        "title", "ns", "id", "`revision.id`", "`revision.contributor.username`",
        "`revision.contributor.ip`", "`revision.sha1`",
        F.char_length(text).alias("n_chars"), F.sha1(text).alias("text_sha1"),
    )


@query
def multi_file_scan(spark, folder):
    """Pages per raw file of one date, from the files that fit its name pattern."""
    pattern = "enwiki-20190701-pages-articles-multistream*_raw.csv"
    raw = tables.read_raw_pages(spark, _raw_files(spark, folder), RAW_SCHEMA, pattern)
    return raw.groupBy("file").agg(
        F.count("*").alias("n_pages"), F.sum(F.char_length("`revision.text`")).alias("n_chars")
    )


@query
def features_roundtrip(spark, folder):
    """The feature table, written and read back."""
    path = tables.features_path(new_path(spark, "features"), "20190701")
    tables.write_features(_features(spark, folder), path)
    return tables.read_features(spark, path)


@query
def features_csv_roundtrip(spark, folder):
    """The feature table, written as CSV and read back with its schema."""
    table = _features(spark, folder)
    path = new_path(spark, "features-csv")
    tables.write_csv(table, path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return tables.read_csv(spark, path, schema)


@query
def text_scan(spark, folder):
    """Lines of all documents, written as text and read back: how many of each length."""
    path = new_path(spark, "text")
    rendered.documents(spark, folder).select("text").write.text(path)
    lines = tables.read_lines(spark, path)
    return lines.groupBy(F.char_length("value").alias("length")).agg(F.count("*").alias("n"))


def _libsvm_file(spark, folder) -> str:
    path = new_path(spark, "libsvm")
    points = rendered.table(spark, folder, "embeddings").select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    tables.write_libsvm(points, path)
    return path


@query
def libsvm_scan(spark, folder):
    """Embeddings written as libsvm and read back."""
    read = tables.read_libsvm(spark, _libsvm_file(spark, folder), N_DIMENSIONS)
    point = vector_to_array("features")
    return read.select(
        F.col("label").cast("int").alias("label"),
        F.get(point, F.lit(0)).alias("first"),
        F.get(point, F.lit(N_DIMENSIONS - 1)).alias("last"),
        F.round(clustering.squared_norm(point), 6).alias("squared_norm"),
    )


@query
def libsvm_kmeans(spark, folder):
    """Five clusters of the vectors in a libsvm file, by the part that their label names: size and cost."""
    path = new_path(spark, "libsvm")
    tables.write_libsvm(
        _parted(spark, folder).select(F.col("part").cast("double").alias("label"), clustering.RAW), path
    )
    read = tables.read_libsvm(spark, path, N_DIMENSIONS)
    model = clustering.bisecting(5, vectors="features").fit(read)
    placed = model.transform(read)
    return placed.groupBy(clustering.CLUSTER).agg(
        F.min("label").cast("int").alias("lowest"), F.max("label").cast("int").alias("highest"),
        F.count("*").alias("n"), F.lit(round(float(model.summary.trainingCost), 4)).alias("cost"),
    ).drop(clustering.CLUSTER)


@query
def model_roundtrip(spark, folder):
    """Whether a saved and reloaded pipeline puts each point where the pipeline itself does."""
    table = _parted(spark, folder).select(
        "vec_id", *[F.get("point", F.lit(i)).alias(f"e{i}") for i in range(N_DIMENSIONS)]
    )
    names = table.columns[1:]
    model = clustering.fit_clusters(table, names, clustering.bisecting(5))
    path = new_path(spark, "model")
    clustering.save_model(model, path)
    fresh = model.transform(table).select("vec_id", clustering.CLUSTER)
    loaded = clustering.load_model(path).transform(table).select("vec_id", F.col(clustering.CLUSTER).alias("reloaded"))
    return loaded.join(fresh, "vec_id").select("vec_id", (F.col("reloaded") == F.col(clustering.CLUSTER)).alias("same"))


@query
def html_first_element(spark, folder):
    df = rendered.table(spark, folder, "pages")
    return df.select(
        "page_id",
        *[html.first_element(F.col("html"), t).alias(t) for t in ("title", "h1")],
    )


@query
def html_article_text(spark, folder):
    """Article texts out of edit forms."""
    forms = rendered.edit_pages(spark, folder)
    return forms.select("page_id", html.first_element(F.col("html"), "textarea").alias("text"))


@query
def html_first_attr(spark, folder):
    df = rendered.table(spark, folder, "pages")
    return df.select("page_id", html.first_attribute(F.col("html"), "a", "href").alias("href"))


@query
def html_revision_id(spark, folder):
    """Newest revisions out of history pages."""
    histories = rendered.history_pages(spark, folder)
    return histories.select("page_id", html.revision_id(F.col("html")).alias("revision_id"))
