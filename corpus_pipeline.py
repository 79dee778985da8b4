"""From raw documents to packed training sequences, stage by stage.

Every stage reads what the one before it wrote, as Parquet in the shared folder, and returns the
columns of `documents`; the last returns the places of token pieces in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refgauge.llm import content_sort, jaccard_join, packing, quality, secrets
from refgauge.llm.inputs import table
from refgauge.llm.queries import vocabulary
from refgauge.workspace import new_path, passing, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learned from these documents' labels accepts."""
    model = quality.learned(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of all documents that are equal but for white space: the longest, then the least id."""
    return content_sort.one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group tied by word five-grams that are equal to 80 % or more: the least id."""
    return jaccard_join.one_of_each(docs, n=5, share=80, most=2000)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the name of its kind in place of each secret."""
    return secrets.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place there."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: The classifier is trained, so SQL cannot give the rows of a run; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, stored; what stages have written before is removed."""
    path = new_path(spark, "packed")
    with passing(spark):
        docs = table(spark, sf_dir, "documents")
        for _, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), "stage")
        packed = STAGES[-1][1](spark, docs, sf_dir)
        packed.write.parquet(path)
    return spark.read.schema(packed.schema).parquet(path)
