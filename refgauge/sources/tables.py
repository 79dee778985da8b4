"""Page, feature and model tables in files."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text spans lines, quotes are doubled and spaces are kept. Fixed values.
CSV = {"header": True, "multiLine": True, "escape": '"'}
CSV_OUT = {
    "header": True, "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
RAW_SUFFIX = "_raw.csv"
BUCKETS = 64


def raw_name(dump: Column) -> Column:
    """Name of the raw table of a dump file: dots become underscores."""
    return F.concat(F.replace(dump, F.lit("."), F.lit("_")), F.lit(RAW_SUFFIX))


def write_raw_pages(df: DataFrame, path: str, dump: str = "dump", form: str = "csv") -> None:
    """Raw pages, a folder `file=<raw name>` for each dump file.

    Rows stay in the tasks they are in, so a dump of any size is written by many tasks. CSV is
    for exchange; Parquet can be split when read, and read by column. Files written before are
    replaced, others stay.
    """
    write_by_file(df.withColumn("file", raw_name(F.col(dump))).drop(dump), path, form)


def write_by_file(df: DataFrame, path: str, form: str = "parquet") -> None:
    """A folder for each value of `file`, in place of the one there may be."""
    options = {"partitionOverwriteMode": "dynamic"} | (CSV_OUT if form == "csv" else {})
    df.write.mode("overwrite").partitionBy("file").format(form).options(**options).save(path)


def read_raw_pages(
    spark: SparkSession, path: str, schema: str, pattern: str = "*" + RAW_SUFFIX, form: str = "csv"
) -> DataFrame:
    """Raw pages of all tables whose name fits the pattern, with that name in `file`."""
    return (
        spark.read.format(form)
        .schema(f"{schema}, `file` string")
        .options(basePath=path, **(CSV if form == "csv" else {}))
        .load(f"{path}/file={pattern}")
    )


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Rows dealt by a hash of the keys into a fixed number of files, each sorted by them, in place of earlier ones.

    Tables of equal keys and number of buckets are joined bucket by bucket, without moving rows. The
    number stands in the name of the folder, and should grow with the table.
    """
    spark = df.sparkSession
    place = f"{path}/buckets-{buckets}"
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(place)}")
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").option(
        "path", place).saveAsTable(_table_name(place))


def read_bucketed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """A table of `write_bucketed`, with what Spark has to know of its layout, in any session."""
    place = f"{path}/buckets-{buckets}"
    name = _table_name(place)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(place).schema)
        by = ", ".join(f"`{key}`" for key in keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                  f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def _table_name(place: str) -> str:
    return "bucketed_" + hashlib.sha256(place.encode()).hexdigest()[:24]


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """CSV with text over several lines. The schema is given: no inference pass."""
    return spark.read.schema(schema).options(**CSV).csv(paths if isinstance(paths, str) else list(paths))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**CSV_OUT).csv(path)


def features_path(folder: str, date: str, limited: bool = False) -> str:
    return f"{folder}/enwiki-{date}-features{'-small' if limited else ''}"


def write_features(df: DataFrame, path: str) -> None:
    """Written by the executors; the driver holds no rows."""
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_libsvm(df: DataFrame, path: str) -> None:
    """Columns (label double, features vector)."""
    df.write.format("libsvm").save(path)


def read_libsvm(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """The number of features is given: no pass to find it."""
    return spark.read.format("libsvm").option("numFeatures", n_features).load(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files in `value`."""
    return spark.read.text(path)

