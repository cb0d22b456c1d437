"""Row numbers over a whole table and neighbours over hot groups, without one big task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.session import cut_lineage


def numbered(df: DataFrame, order: list[str], out: str = "id", after: Column | int = 0) -> DataFrame:
    """Dense numbers after *after* in the order of *order*.

    Rows are range-partitioned and sorted; each partition counts itself and starts after
    the ones before it. The checkpoint fixes the numbers should a task run again. The
    offset table has one row per partition, so broadcasting it is bounded.
    """
    ranged = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn(
            "_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("long"), 33)
        )
    )
    ranged = cut_lineage(ranged)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    start = F.lit(after) if isinstance(after, int) else after
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + F.col("_pos") + 1 + start)
        .drop("_part", "_pos", "_before")
    )


def next_in_group(
    df: DataFrame, group: list[str], order: list[str], value: str, slice_by: Column, out: str
) -> DataFrame:
    """Value of the following row of the group, with hot groups cut into slices.

    *slice_by* must not decrease along *order* (a day of the ordering time, say). The
    window runs inside (group, slice); the last row of a slice takes the first value of
    the group's next slice, from a table with one row per slice.
    """
    sliced = df.withColumn("_slice", slice_by)
    inner = Window.partitionBy(*group, "_slice").orderBy(*order)
    within = sliced.withColumn("_in", F.lead(F.struct(value)).over(inner))
    heads = sliced.groupBy(*group, "_slice").agg(
        F.min_by(F.struct(value), F.struct(*order)).alias("_head")
    )
    follow = heads.select(
        *group,
        "_slice",
        F.lead("_head").over(Window.partitionBy(*group).orderBy("_slice")).alias("_next_head"),
    )
    return (
        within.join(follow, [*group, "_slice"])
        .withColumn(out, F.coalesce("_in", "_next_head")[value])
        .drop("_slice", "_in", "_next_head")
    )
