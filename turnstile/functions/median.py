"""Exact interpolated median of one column, in one row; no row for empty input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions.money import stored

def _half_sum(both: Column, name: str) -> Column:
    return F.round(both * F.lit("0.5").cast("decimal(1,1)"), 2).alias(name)


def _ranks(n: Column) -> tuple[Column, Column]:
    """The two middle ranks of n values, one rank twice where n is odd."""
    return F.floor((n + 1) / 2).cast("long"), (F.floor(n / 2) + 1).cast("long")


def median_few(df: DataFrame, value: str, name: str) -> DataFrame:
    """For inputs with a proven small bound, such as one row per day of one year."""
    n = F.size("a")
    low, high = (F.element_at("a", r.cast("int")) for r in _ranks(n))
    held = df.agg(F.sort_array(F.collect_list(stored(F.col(value)))).alias("a"))
    return held.filter(n > 0).select(_half_sum(low + high, name))


def median_many(df: DataFrame, value: str, name: str) -> DataFrame:
    """For inputs of any size and amounts of any width.

    Spark's exact percentile gathers every distinct value in one task. Here equal
    values are counted first (combined map-side, shuffled once, the exchange reused
    by both steps). They are dealt by ranges of the value, and each range reports its
    ends and its count. What then meets in one task is one row a range, and the values
    of the range with the two middle ranks: one partition of a sort of distinct values.

    A range is known by its ends, not by its partition, so it does not matter whether
    a retried or coalesced stage would cut elsewhere.
    """
    # Never NULL to the optimizer either: a filter it infers for one step only would
    # make that step's plan differ and so recompute what could be reused.
    counted = (
        df.filter(F.col(value).isNotNull())
        .select(F.coalesce(stored(F.col(value)), stored(F.lit(0))).alias("v"))
        .groupBy("v")
        .agg(F.count("*").alias("c"))
    )
    found = _middle_range(counted)
    # The count is named so that the filter stays above it, where its exchange is reused.
    held = counted.filter(F.when(F.col("c") > 0, F.col("v")).between(found["lo"], found["hi"]))
    upto = F.sum("c").over(Window.partitionBy(F.lit(0)).orderBy("v")) + found["start"]
    last = held.select("v", "c", upto.alias("upto"), found["n"].alias("n"))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") >= rank, F.col("v")))

    low, high = _ranks(F.col("n"))
    both = last.agg(at(low).alias("low"), at(high).alias("high")).filter("low is not null")
    return both.select(_half_sum(F.col("low") + F.col("high"), name))


def _middle_range(counted: DataFrame) -> Column:
    """Ends of the one or two neighbouring ranges that hold the middle ranks, as a scalar subquery:
    (lo, hi, start, n), where ``start`` counts the rows below lo. NULLs for no rows."""
    dealt = counted.repartitionByRange("v").withColumn("range", F.spark_partition_id())
    ranges = dealt.groupBy("range").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("c").alias("c"))
    every = Window.partitionBy(F.lit(0))
    upto = F.sum("c").over(every.orderBy("lo"))
    ranked = ranges.select("lo", "hi", "c", upto.alias("upto"), F.sum("c").over(every).alias("n"))
    low, high = _ranks(F.col("n"))
    start = F.col("upto") - F.col("c")
    held = ranked.filter((F.col("upto") >= low) & (start < high))
    ends = held.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(start).alias("start"), F.max("n").alias("n"))
    return ends.select(F.struct("*").alias("found")).scalar()
