"""Exact consecutive numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kotonoha.plans.layout import cut_lineage


# monotonically_increasing_id keeps the row's place inside its partition in the
# lower 33 bits.
PLACE_MASK = (1 << 33) - 1


def range_slices(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    slice_col: str = "_slice",
) -> DataFrame:
    """Sort rows by (group, order) over range partitions and fix the result.

    Range bounds are sampled, so the placement is checkpointed before anything
    is derived from it. A group that holds a third of all rows is simply cut
    into many slices.
    """
    keys = [*group_cols, *order_cols]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(slice_col, F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(PLACE_MASK))
    )
    return cut_lineage(placed)


def number_rows(
    df: DataFrame,
    order_cols: Sequence[str],
    *,
    group_cols: Sequence[str] = (),
    output: str = "row_id",
    start: int = 0,
) -> DataFrame:
    """``row_number() + start - 1`` per group (or over all rows), skew-proof.

    Rows are numbered inside their range slice; a slice that continues a group
    adds the rows of the group's earlier slices. Only such continuing slices
    need an offset, at most one per partition, so the joined side is bounded by
    the number of partitions.
    """
    sliced = range_slices(df, group_cols, order_cols)
    counts = sliced.groupBy(*group_cols, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    # One row per (group, slice): groups inside one slice give a single row, so
    # a hot group contributes at most one row per partition here.
    earlier = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        counts.withColumn("_offset", F.sum("_n").over(earlier))
        .where(F.col("_offset").isNotNull())
        .drop("_n")
    )
    if group_cols:
        inside = Window.partitionBy(*group_cols, "_slice").orderBy(*order_cols)
        numbered = sliced.withColumn("_local", F.row_number().over(inside))
        on = F.col("_slice") == F.col("_o_slice")
        for c in group_cols:
            on = on & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
        renamed = offsets.select(
            "_offset",
            F.col("_slice").alias("_o_slice"),
            *[F.col(c).alias(f"_o_{c}") for c in group_cols],
        )
        joined = numbered.join(F.broadcast(renamed), on, "left")
    else:
        numbered = sliced.withColumn("_local", F.col("_place") + 1)
        joined = numbered.join(F.broadcast(offsets), "_slice", "left")
    number = F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0)) + F.lit(start - 1)
    return joined.select(*df.columns, number.cast("long").alias(output))
