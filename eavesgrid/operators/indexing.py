"""Consecutive row numbers over a total order, without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, position in the partition below


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> tuple[DataFrame, int]:
    """``df`` with a 0-based position in the given total order, and the row count.

    Rows are range-partitioned and sorted in place, then written once to the checkpoint folder: the partition
    bounds are sampled, so positions must not be computed from two runs.  The offsets table has one row per
    partition.
    """
    bits = F.monotonically_increasing_id()
    ordered = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part_no", F.shiftright(bits, _LOCAL_BITS))
        .withColumn("part_pos", bits.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    )
    counts = ordered.groupBy("part_no").agg(F.count(F.lit(1)).alias("part_rows")).collect()
    offsets, total = [], 0
    for row in sorted(counts, key=lambda r: r["part_no"]):
        offsets.append((row["part_no"], total))
        total += row["part_rows"]
    spark = df.sparkSession
    table = F.broadcast(spark.createDataFrame(offsets, "part_no long, part_offset long"))
    indexed = (
        ordered.join(table, "part_no")
        .withColumn(name, F.col("part_pos") + F.col("part_offset"))
        .drop("part_no", "part_pos", "part_offset")
    )
    return indexed, total
