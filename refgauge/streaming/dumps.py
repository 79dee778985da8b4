"""Each dump file in a folder once, as a stream of files.

Dump files are worked off one after another. Here the stream keeps a record of what it has
done, so a second run takes new files only, and one that was cut short goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from refgauge.operators import articles, features
from refgauge.sources import dumps


def follow_dumps(
    spark: SparkSession, xml_folder: str, out: str, progress: str, files_per_batch: int = 8
) -> StreamingQuery:
    """Append the features of the articles of all new dump files to a Parquet table.

    Every feature is a function of its own row, so the stream keeps no state. `progress` is a
    folder all executors share.
    """
    lines = (
        spark.readStream.options(**dumps.LINES, pathGlobFilter=dumps.DUMP_FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(xml_folder)
    )
    pages = dumps.parsed(lines).withColumn("revision_id", F.col("`revision.id`").cast("long"))
    kept = articles.filter_articles(
        articles.article_columns(articles.strip_prefix(pages), keys=("revision_id",))
    )
    table = features.feature_table(kept, scores=False, keys=("revision_id",))
    return (
        table.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
