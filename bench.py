"""Runs the headline queries and prints one line of JSON with their times in seconds."""

from __future__ import annotations

import json
import os
import time

from refgauge.plans.queries import QUERIES
from refgauge.session import local_session

HEADLINE = (
    "filter_articles", "tag_articles", "headings", "citations", "internal_links",
    "external_links", "paragraphs", "feature_table", "feature_table_v1", "feature_totals",
    "page_score_join", "chunked_scores", "revision_at_time", "reference_mix", "article_report",
    "minmax_scaled", "kmeans_predict", "bisecting_predict", "k_sweep", "silhouette_points",
    "cluster_label", "pca_scaled", "xml_pages", "csv_roundtrip", "html_first_element",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores)
    # One untimed run: loading classes and compiling them is not part of any query.
    QUERIES[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
