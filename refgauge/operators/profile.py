"""Profiles and totals of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refgauge import fixed


def column_profile(df: DataFrame, columns: Sequence[str] = fixed.PROFILE_COLUMNS) -> DataFrame:
    """Distinct values of each column as rows (column, value), in one pass.

    Values are made distinct before the shuffle and never gathered into one row.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in columns
    ])
    return df.select(F.inline(pairs)).distinct()


def feature_totals(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Row count and the total of each feature, in one row."""
    return df.agg(F.count("*").alias("n_rows"), *[F.sum(c).alias(f"total_{c}") for c in features])


def feature_ranges(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows (feature, low, high) from a single aggregation."""
    ends = df.agg(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.min(c).alias("low"), F.max(c).alias("high"))
        for c in features
    ]).alias("ends"))
    return ends.select(F.inline("ends"))


# Numbers and sketches that are kept for each part of a table, such as a dump file, and merged: a new part is
# looked at alone, and none of the others again.

#: Registers of a sketch of distinct values, as a power of two: a standard error below 1 %.
REGISTERS = 14
#: Values a sketch of frequent ones follows; counts are exact up to three quarters of that many values.
FOLLOWED = 10_000


def part_numbers(df: DataFrame, part: str, features: Sequence[str]) -> DataFrame:
    """A row for each part: its number of rows, and sum, least and greatest value of each feature."""
    ends = {"total": F.sum, "low": F.min, "high": F.max}
    return df.groupBy(part).agg(
        F.count("*").alias("n_rows"), *[f(c).alias(f"{name}_{c}") for c in features for name, f in ends.items()]
    )


def merged_totals(parts: DataFrame, features: Sequence[str]) -> DataFrame:
    """`feature_totals` of all parts together."""
    return parts.agg(F.sum("n_rows").alias("n_rows"), *[F.sum(f"total_{c}").alias(f"total_{c}") for c in features])


def merged_ranges(parts: DataFrame, features: Sequence[str]) -> DataFrame:
    """`feature_ranges` of all parts together."""
    ends = parts.agg(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.min(f"low_{c}").alias("low"), F.max(f"high_{c}").alias("high"))
        for c in features
    ]).alias("ends"))
    return ends.select(F.inline("ends"))


def part_sketches(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """Rows (part, column, n_rows, distinct_values, frequent_values): sketches of bounded size, whatever the column holds.

    NULLs are counted as rows and otherwise left out.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ])
    return df.select(part, F.inline(pairs)).groupBy(part, "column").agg(
        F.count("*").alias("n_rows"), F.hll_sketch_agg("value", REGISTERS).alias("distinct_values"),
        F.expr(f"approx_top_k_accumulate(value, {FOLLOWED}) FILTER (WHERE value IS NOT NULL)").alias("frequent_values"),
    )


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """Rows (column, n_rows, n_distinct) of all parts together; the last within a few percent."""
    return sketches.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("n_distinct")
    )


def merged_frequent(sketches: DataFrame, k: int = 10) -> DataFrame:
    """Rows (column, value, n): the `k` most frequent values of each column over all parts."""
    top = sketches.groupBy("column").agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent_values, {FOLLOWED}), {k})").alias("top"))
    return top.select("column", F.inline("top")).select("column", F.col("item").alias("value"), F.col("count").alias("n"))
