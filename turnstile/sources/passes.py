"""Work on many orders in passes over ranges of order ids.

Each pass is a job of its own whose shuffle files go when it is done, so the disk holds those of
a few orders at a time. Small inputs take one pass, which is the plan as it would be without.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.session import shuffles_go, work_folder

# Orders of a pass, and the number of passes above which they grow instead: where a table is not
# in the order of its ids, every pass scans all of it.
ORDERS_PER_PASS = 1_000_000
MOST_PASSES = 12

#: The condition on an id column that picks the rows of a pass.
Part = Callable[[str], Column]


def _between(low: int | None, high: int | None) -> Part:
    """Ids above low and up to high; the first pass has the missing ids, too."""

    def part(column: str) -> Column:
        c = F.col(column)
        if low is None:
            return (c <= high) | c.isNull()
        return (c > low) if high is None else (c > low) & (c <= high)

    return part


def passes(ids: DataFrame, column: str = "id") -> list[Part]:
    """Ranges that together hold every id once, those that ids lacks as well; some are alike in size."""
    found = None
    with shuffles_go(ids.sparkSession):
        wanted = min(MOST_PASSES, math.ceil(ids.count() / ORDERS_PER_PASS))
        if wanted > 1:
            shares = [k / wanted for k in range(1, wanted)]
            found = ids.agg(F.percentile_approx(column, shares, 1000).alias("cuts")).first().cuts
    cuts = sorted(set(found or []))
    if not cuts:
        return [lambda _: F.lit(True)]
    return [_between(low, high) for low, high in zip([None, *cuts], [*cuts, None], strict=True)]


def kept(spark: SparkSession, frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of all frames, written to the work folder one frame after the other and read back.

    They must have the same columns. Packed tightly: keys are hashes, which only an entropy coder
    makes smaller."""
    folder, paths, schema = f"{work_folder(spark)}/kept-{uuid.uuid4().hex}", [], None
    for df in frames:
        paths.append(f"{folder}/{len(paths)}")
        schema = schema or df.schema
        with shuffles_go(spark):
            df.select(*schema.names).write.option("compression", "zstd").parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths)


def in_passes(ids: DataFrame, work: Callable[[Part], DataFrame]) -> DataFrame:
    """The rows of work on each pass; not computed yet where one pass does."""
    parts = passes(ids)
    return work(parts[0]) if len(parts) == 1 else kept(ids.sparkSession, map(work, parts))
