"""XML page dumps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refgauge import fixed

# Layout of a <page> element. Fixed values; `_VALUE` is the text of an element with attributes.
PAGE_SCHEMA = """
    title string, ns string, id string, restrictions string,
    redirect struct<_title: string>,
    revision struct<
        id: string, parentid: string, timestamp: string,
        contributor: struct<username: string, id: string, ip: string>,
        comment: string, model: string, format: string,
        text: struct<_VALUE: string>, sha1: string>
"""
OPEN, CLOSE = r"<page(?=[\s>])", "</page>"
LINES = {"lineSep": CLOSE}
PARSING = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
BROKEN = "_broken"
DUMP_FILES = "*.xml*"


def read_pages(
    spark: SparkSession, paths: str | Sequence[str], schema: str = PAGE_SCHEMA, files: str = DUMP_FILES
) -> DataFrame:
    """One row per `<page>` of the dumps, all strings, under dotted names, with its `dump` file.

    A page that is no XML, or that is cut off at the end of its dump, fails the job; see `rejects`.
    """
    return parsed(pieces(spark, paths, files), schema)


def rejects(
    spark: SparkSession, paths: str | Sequence[str], schema: str = PAGE_SCHEMA, files: str = DUMP_FILES
) -> DataFrame:
    """(piece, dump): the raw pieces of the dumps that are no whole pages."""
    rows = _read(pieces(spark, paths, files), schema)
    return rows.filter(_is_broken()).select("piece", "dump")


def sound_pages(
    spark: SparkSession, paths: str | Sequence[str], schema: str = PAGE_SCHEMA, files: str = DUMP_FILES
) -> DataFrame:
    """The pages of `read_pages` without the pieces of `rejects`."""
    rows = _read(pieces(spark, paths, files), schema).filter(~_is_broken())
    return _flat(rows)


def pieces(spark: SparkSession, paths: str | Sequence[str], files: str = DUMP_FILES) -> DataFrame:
    """Dumps as text cut at each `</page>`."""
    lines = spark.read.options(**LINES, pathGlobFilter=files)
    return lines.text([paths] if isinstance(paths, str) else list(paths))


def parsed(lines: DataFrame, schema: str = PAGE_SCHEMA) -> DataFrame:
    """Pages out of text cut at each `</page>`; a broken one fails the job.

    Text is cut so because one task would read a whole file of the XML source, however large,
    while text is split at any block, in bzip2 files as well. Inside a page that tag cannot
    occur: markup in page text is escaped.
    """
    rows = _read(lines, schema)
    told = F.concat(F.lit("broken page in "), F.col("dump"), F.lit(": "), F.substring("piece", 1, 200))
    page = F.when(_is_broken(), F.raise_error(told).cast(rows.schema["page"].dataType)).otherwise(F.col("page"))
    return _flat(rows.withColumn("page", page))


def _read(lines: DataFrame, schema: str) -> DataFrame:
    """(piece, page, cut, dump). `cut`: the piece is the rest of a dump that ends inside a page.

    The rest of a whole dump closes its root element; it and blank ends hold no page.
    """
    piece = F.regexp_extract("value", rf"(?s){OPEN}.*", 0)
    rows = lines.select("value", piece.alias("piece"), F.col("_metadata.file_name").alias("dump")).filter("piece <> ''")
    # An XML reader takes what follows a closed element for nothing, so a cut page stays open.
    checked = T._parse_datatype_string(schema).add(BROKEN, T.StringType())
    options = {**PARSING, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    return rows.select(
        "piece", F.from_xml(F.concat("piece", F.lit(CLOSE)), checked, options).alias("page"),
        F.regexp_like("piece", F.lit(r"</mediawiki\s*>\s*$")).alias("cut"), "dump",
    )


def _is_broken() -> Column:
    return F.col("page").isNull() | F.col(f"page.{BROKEN}").isNotNull() | F.col("cut")


def _flat(rows: DataFrame) -> DataFrame:
    fields = [f for f in rows.schema["page"].dataType if f.name != BROKEN]
    return rows.select(*flat_columns(T.StructType(fields), "page"), "dump")


def flat_columns(schema: T.StructType, root: str) -> list[Column]:
    """Leaf elements as columns named by their path; attributes are left out, blanks are NULL."""
    return [
        F.nullif(F.btrim(F.col(value).cast("string"), F.lit(fixed.SPACES)), F.lit("")).alias(name)
        for name, value in _leaves(schema, root)
    ]


def _leaves(schema: T.StructType, root: str, path: tuple[str, ...] = ()) -> Iterator[tuple[str, str]]:
    for field in schema:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, root, here)
        elif field.name == "_VALUE" or not field.name.startswith("_"):
            name = path if field.name == "_VALUE" else here
            yield ".".join(name), ".".join([root, *(f"`{p}`" for p in here)])
