"""Positions in a total order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starrung.workspace import Workspace


def _offsets(sizes: DataFrame, part: str) -> DataFrame:
    """Sum of ``__w`` over all earlier partitions, as ``__offset`` of each."""
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.groupBy(part).agg(F.sum("__w").alias("__w")).select(
        F.col(part).alias("__of"), F.coalesce(F.sum("__w").over(earlier), F.lit(0)).alias("__offset"))


def _with_position(ws: Workspace, df: DataFrame, order: Sequence[str], total: str) -> DataFrame:
    """The number of earlier rows: place within a sorted range, written once, plus the ranges before it."""
    spot = F.monotonically_increasing_id()
    placed = ws.table(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__spot", spot), "ordered")
    # The id has the partition above bit 33 and the row's place in it below.
    part = F.shiftright("__spot", 33)
    offsets = _offsets(placed.select(part.alias("__part"), F.lit(1).cast("bigint").alias("__w")), "__part")
    # One offset row per partition: bounded by the number of shuffle partitions.
    return (
        placed.join(F.broadcast(offsets), part == F.col("__of"))
        .withColumn(total, F.col("__offset") + F.col("__spot").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__spot", "__of", "__offset")
    )


def with_running_total(
    ws: Workspace, df: DataFrame, order: Sequence[str], total: str = "before", weight: Column | None = None
) -> DataFrame:
    """Add the sum of ``weight`` (default 1) over all rows that come earlier in ``order``.

    Rows are range-partitioned and written with their partition number; the
    per-partition sums, one row each, give the offset at which a partition
    starts. ``order`` must tell rows apart, so that ranges are balanced.
    """
    if weight is None:
        return _with_position(ws, df, order, total)
    placed = ws.table(
        df.withColumn("__w", weight)
        .repartitionByRange(*order)
        .withColumn("__part", F.spark_partition_id()),
        "ordered",
    )
    offsets = _offsets(placed, "__part")
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # One offset row per partition: bounded by the number of shuffle partitions.
    return (
        placed.withColumn("__inside", F.coalesce(F.sum("__w").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), F.col("__part") == F.col("__of"))
        .withColumn(total, F.col("__offset") + F.col("__inside"))
        .drop("__w", "__part", "__of", "__offset", "__inside")
    )
