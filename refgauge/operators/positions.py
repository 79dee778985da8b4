"""Row numbers over a whole table without moving it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refgauge.workspace import written

# monotonically_increasing_id puts the partition above this many bits.
_ROW_BITS = 33


def with_position(
    df: DataFrame,
    order_by: Sequence[str],
    within: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """`df` with `position`: 0-based place by `order_by`, from 0 again for each `within`.

    Rows are range-partitioned and sorted, and numbered within their partition. That table is
    written once, as the ranges come from a sample and must not change between the jobs. What comes
    before a partition is a running sum over one row per partition (and `within` value, such as a
    dump file), joined back by Spark's choice. Ties go by where a row was read, so a key, or a row
    with its copies, that fills a third of the table is split over partitions and not put into one
    task. Pass narrow rows of a scan: they are written.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = [within] if within else []
    read = df.withColumn("_read", F.monotonically_increasing_id())
    order = [F.col(c) for c in (*group, *order_by, "_read")]
    ranged = (
        read.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = written(ranged, "positions").withColumns({
        "_part": F.shiftright("_at", _ROW_BITS),
        "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })
    sizes = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    # A range holds several groups only where they meet, so a group has one row a range at most.
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    shifts = sizes.select(
        F.col("_part").alias("_of"), (before - F.col("_first")).alias("_shift"),
        *[F.col(g).alias("_group") for g in group],
    )
    same = F.col("_part") == F.col("_of")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col("_group"))
    return (
        placed.join(shifts, same)
        .withColumn("position", F.col("_row") + F.col("_shift"))
        .select(*df.columns, "position")
    )
