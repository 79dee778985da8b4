"""Exact deduplication by sorting contents.

Texts without white space are range-partitioned by splitters that Spark samples from them and
sorted within partitions (spilling to disk), so equal texts stand next to each other. Runs of equal
texts are found by comparing neighbours in full. Splitters are cut after `HEAD` characters and go on
with a hash of the text, so that they stay small and texts with a common beginning can be parted. A
salt behind them lets a large group reach over several partitions; each of its parts is reduced to
one row, and the parts meet again by the text's digest. Texts move once; what follows moves ids,
lengths and digests.

Of equal texts the row with the most code points stays, then the one with the smallest id. Null
texts count as empty, and empty texts are equal to each other. A null id is larger than all others.
Rows that repeat, id included, are all returned; one row of each group is marked kept, if ids repeat
or are null too. Further columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refgauge.llm.inputs import documents_of, marked, without
from refgauge.workspace import written

SALTS = 64
HEAD = 64


def without_space(text: Column) -> Column:
    """The text without blanks, tabs, newlines, vertical tabs, form feeds and returns."""
    for space in (" ", "\n", "\r", "\t", "\x0b", "\x0c"):
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def digest(body: Column) -> Column:
    return F.sha2(F.encode(body, "UTF-8"), 256)


def runs(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """A row a document with its digest, and what its run of equal texts amounts to on the first row.

    `in_run` is null but on the first row of a run. `row` tells rows apart once they are written.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents_of(docs).select(
        "doc_id", F.length(text).alias("n_chars"), without_space(text).alias("body"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    )
    keyed = rows.select("*", F.substring("body", 1, HEAD).alias("head"), F.xxhash64("body").alias("hash"))
    ordered = keyed.repartitionByRange("head", "hash", "salt")
    run = Window.partitionBy("head", "hash", "body", "salt").orderBy(
        F.col("n_chars").desc(), F.col("doc_id").asc_nulls_last()
    )
    return ordered.select(
        "doc_id", "n_chars", digest(F.col("body")).alias("text_sha256"),
        F.when(F.row_number().over(run) == 1, F.count(F.lit(1)).over(run.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("in_run"),
        F.monotonically_increasing_id().alias("row"),
    )


def judged(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, n_chars, keep_id, group_size, kept, text_sha256: one row for each row of `docs`."""
    rows = written(runs(docs, salts), "runs")
    better = F.struct(
        (-F.col("n_chars")).alias("longest"), F.col("doc_id").isNull().alias("last"),
        F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
    )
    groups = (
        rows.filter("in_run IS NOT NULL").groupBy("text_sha256")
        .agg(F.min(better).alias("best"), F.sum("in_run").alias("group_size"))
        .filter("group_size > 1")
    )
    best = F.coalesce("best", better)
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id", "n_chars", best["keep_id"].alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("row") == best["keep_row"]).alias("kept"), "text_sha256",
    )


def deduplicated(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of `docs`."""
    return judged(docs, salts).drop("n_chars")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, all columns.

    Rows are found again by id, length and digest. Where a kept row shares them with others, which
    repeat it, the one whose text is the least stays; they are combined before they are moved.
    """
    length = F.length(F.coalesce("text", F.lit("")))
    on = {"n_chars": length, "text_sha256": digest(without_space(F.coalesce("text", F.lit(""))))}
    found = (
        judged(docs).filter("group_size > 1").groupBy("doc_id", *on)
        .agg(F.max("kept").alias("best"), F.count(F.lit(1)).alias("n")).filter("NOT best OR n > 1")
    )
    found = written(found, "copies")
    others = without(docs, found, on, null_ids=True)
    repeated = found.filter("best")
    every, hit, own = marked(docs, repeated)
    keys = {"__key0": F.col("doc_id"), **{f"__key{k}": column for k, column in enumerate(on.values(), 1)}}
    wanted = repeated.select(*(F.col(c).alias(f"{key}_kept") for key, c in zip(keys, ["doc_id", *on])))
    least = F.struct(F.col("text").isNull(), "text")
    picked = (
        every.filter(hit).withColumns(keys).groupBy(*keys).agg(F.min_by(F.struct(*own), least).alias("first"))
        .join(wanted, [F.col(key).eqNullSafe(F.col(f"{key}_kept")) for key in keys], "left_semi")
        .select(*(F.col(f"first.{c}").alias(c) for c in own))
    )
    return others.union(picked.toDF(*docs.columns))
