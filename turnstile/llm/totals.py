"""Running totals over a whole table without a window in a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.staging import partitions, staged

PART = "_range_part"
ROW_BITS = 33  # of monotonically_increasing_id: the row in its partition; above them the partition


def with_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df plus name, the number of rows that come earlier in order.

    Rows move once, however wide: each range is written sorted, with its rows' numbers, and read
    back; what the ranges before it hold is one row a range. Ties in order are cut at will.
    """
    placed = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    placed = staged(placed.withColumn(PART, F.monotonically_increasing_id()), "ranges")
    part, row = F.shiftright(PART, ROW_BITS), F.col(PART).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"))
    out = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return out.withColumn(name, F.col("_n") + row).drop(PART, "_part", "_n")


def with_totals_before(df: DataFrame, group: list[str], order: list[str | Column], sums: dict[str, str], part: Column | None = None) -> DataFrame:
    """df plus, for each (new name: column) of sums, the total of that column over all rows of the
    same group that come earlier in order.

    The rows are range-partitioned by group and order, so a group of any size is spread; each
    part is summed once, the parts of a group are added up (one row a part and group), and the
    running total inside a part starts from there. The parts are staged first, so that a retried
    task finds the same rows in them. Group columns hold no nulls; ties in order are cut at will.

    part: a column that rises with order and deals a group's rows evenly, such as the first digits
    of a hash that they are ordered by. It takes the place of the ranges: rows move once and
    nothing is staged.
    """
    spark = df.sparkSession
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    if part is None:
        placed = df.repartitionByRange(partitions(spark), *[F.col(g) for g in group], *keys)
        placed = staged(placed.withColumn(PART, F.spark_partition_id()), "ranges")
    else:
        placed = df.withColumn(PART, part)
    at = ["_" + name for name in sums]
    per_part = placed.groupBy(*group, PART).agg(*[F.sum(c).alias(a) for a, c in zip(at, sums.values(), strict=True)])
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(*group, PART, *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(a) for a in at])
    inside = Window.partitionBy(*group, PART).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(starts, [*group, PART])
    for (name, column), a in zip(sums.items(), at, strict=True):
        out = out.withColumn(name, F.col(a) + F.coalesce(F.sum(column).over(inside), F.lit(0)))
    return out.drop(PART, *at)
