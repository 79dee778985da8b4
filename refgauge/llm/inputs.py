"""What the operators of this folder share: input columns, tables of the test folders, workers."""

from __future__ import annotations

import os
import pathlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refgauge.workspace import bounded_batches

#: The characters that separate words and lines: blank, tab, newline, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"


def columns_of(df: DataFrame, *wanted: tuple[str, str]) -> DataFrame:
    """Only the wanted columns as (name, type); further columns, whatever their names, are left out.

    Names are matched exactly, so columns that differ only in case do not clash.
    """
    places = {}
    for place, name in enumerate(df.columns):
        places.setdefault(name, place)
    plain = df.toDF(*(f"c{place}" for place in range(len(df.columns))))
    return plain.select(*(F.col(f"c{places[name]}").cast(kind).alias(name) for name, kind in wanted))


def documents_of(df: DataFrame) -> DataFrame:
    return columns_of(df, ("doc_id", "bigint"), ("text", "string"))


def mapped(docs: DataFrame, make) -> DataFrame:
    """`docs` through mapInArrow with the function `make(places)` gives, all columns by position.

    places: the position of every column name, so that names that differ only in case do not clash.
    """
    names = docs.columns
    own = [f"c{k}" for k in range(len(names))]
    plain = docs.toDF(*own)
    places = {name: k for k, name in reversed(list(enumerate(names)))}
    return plain.mapInArrow(make(places), plain.schema).toDF(*names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> None:
    """Readies a session for the Python workers of this folder.

    Workers of a local session can import the package wherever the session was started. Rows are
    whole texts, so batches of Spark's default 64 MB are made smaller; other settings are kept.
    """
    bounded_batches(spark)
    root = str(pathlib.Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def bit_table(ids: DataFrame, words: int) -> tuple[DataFrame, Column, Column]:
    """A bit for each hash of a doc_id in `ids`, `words` rows of 64 at most; a doc_id's word and mask."""
    hashed = F.xxhash64("doc_id")
    word = F.pmod(F.shiftrightunsigned(hashed, 6), F.lit(words)).alias("__word")
    mask = F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))")
    return ids.groupBy(word).agg(F.bit_or(mask).alias("__bits")), word, mask


def texts_of(docs: DataFrame, ids: DataFrame, words: int = 1 << 17) -> DataFrame:
    """The rows of `ids` (doc_id and more columns) with their texts; no other texts are moved.

    Which documents may be wanted is told by a table of bits that has a fixed size and is broadcast;
    the join after it is exact.
    """
    bits, word, mask = bit_table(ids, words)
    likely = (
        documents_of(docs).filter("doc_id IS NOT NULL").withColumn("__word", word)
        .join(F.broadcast(bits), "__word").filter(F.col("__bits").bitwiseAND(mask) != 0).select("doc_id", "text")
    )
    return likely.join(ids, "doc_id")


def marked(docs: DataFrame, ids: DataFrame, words: int = 1 << 17) -> tuple[DataFrame, Column, list[str]]:
    """`docs` with columns doc_id and text besides its own, whether a row's doc_id may be in `ids`, own names."""
    names = docs.columns
    own = [f"__c{k}" for k in range(len(names))]
    plain = docs.toDF(*own)
    kinds = {"doc_id": "bigint", "text": "string"}
    plain = plain.select("*", *(F.col(own[names.index(c)]).cast(t).alias(c) for c, t in kinds.items() if c in names))
    bits, word, mask = bit_table(ids, words)
    every = plain.join(F.broadcast(bits.withColumnRenamed("__word", "__own")), word == F.col("__own"), "left")
    return every, F.coalesce(F.col("__bits").bitwiseAND(mask) != 0, F.lit(False)), own


def without(
    docs: DataFrame, dropped: DataFrame, on: dict[str, Column] | None = None, words: int = 1 << 17,
    null_ids: bool = False,
) -> DataFrame:
    """The rows of `docs`, all columns, but for those with a doc_id in `dropped`.

    on: further columns of `dropped`, and what a row must have there to go. Only rows that may have to
    go, by a broadcast table of bits of a fixed size, are moved for the exact join. Rows with a null
    doc_id stay; with `null_ids` they go like others.
    """
    on = on or {}
    dropped = dropped if null_ids else dropped.filter("doc_id IS NOT NULL")
    every, hit, own = marked(docs, dropped, words)
    keys = {f"__key{k}": column for k, column in enumerate([F.col("doc_id"), *on.values()])}
    gone = dropped.select(*(F.col(name).alias(f"{key}_gone") for key, name in zip(keys, ["doc_id", *on]))).distinct()
    same = [F.col(key).eqNullSafe(F.col(f"{key}_gone")) for key in keys]
    stay = every.filter(~hit).select(*own)
    unsure = every.filter(hit).withColumns(keys).join(gone, same, "left_anti").select(*own)
    return stay.unionByName(unsure).toDF(*docs.columns)
