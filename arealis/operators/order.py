"""Places in a sorted order without bringing a group, or the table, into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.scratch import stored


def keyed_join(df: DataFrame, small: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """Join on the group's columns; without any, the one row of ``small`` goes to every row."""
    return df.join(small, by, how) if by else df.crossJoin(F.broadcast(small))


def running_totals(df: DataFrame, by: list[str], order: list[str], weight: str) -> DataFrame:
    """Adds before: the sum of ``weight`` over the rows of the same group that come earlier in ``order``.

    Rows are sorted over ranges, each range adds up its own rows, and the
    ranges' totals, one row each, make the offsets. Equal rows of a group and
    order come in any sequence.
    """
    keys = [*by, *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = stored(ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ordered")
    earlier = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered.groupBy("_range").agg(F.sum(weight).alias("_total"))
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(ranges), F.lit(0)).alias("_offset"))
    placed = ordered.withColumn("_local", F.coalesce(F.sum(weight).over(earlier), F.lit(0))).join(F.broadcast(offsets), "_range")
    placed = placed.withColumn("before", F.col("_local") + F.col("_offset")).drop("_range", "_at", "_local", "_offset")
    if not by:
        return placed
    starts = placed.groupBy(*by).agg(F.min("before").alias("_start"))
    return placed.join(starts, by).withColumn("before", F.col("before") - F.col("_start")).drop("_start")
