"""Merge a batch into a table: insert new keys, refresh changed rows, keep the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _match(left: str, right: str, keys: Sequence[str], null_safe: bool) -> Column:
    """Key equality between two aliased sides."""
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return reduce(
        lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    )


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks; a key with a NULL part always counts as new."""
    return lacking(source, target, keys).select(*target.columns)


def lacking(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left side whose key the right side lacks.

    An anti join can split a hot key on its left side only, so the right side is cut
    to distinct keys first. That combines map-side and keeps the join's partitioning.
    """
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Target after the merge. A matched row takes the tracked columns when any differs.

    Two joins instead of one full outer join: against a small batch both become
    broadcast joins (Spark checks the size) and the large target is not shuffled.
    The source is first reduced to one row per key, so a key that fills a third of
    the batch is combined before it moves and cannot multiply target rows. A row
    equal to the stored one changes nothing, however often it comes; more than one
    source row for a matched key stops the job, as a merge must, when any of them
    would change it.
    """
    names = target.columns
    new = F.struct(*tracked)
    batch = source.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min(new).alias("_new"), F.max(new).alias("_last")
    )
    old = F.struct(*[F.col(f"t.{c}").alias(c) for c in tracked])
    same = old.eqNullSafe(F.col("s._new")) & old.eqNullSafe(F.col("s._last"))
    clash = F.raise_error(F.lit(f"merge matched more than one source row on {list(keys)}"))
    clash = clash.cast(batch.schema["_new"].dataType)
    joined = (
        target.alias("t")
        .join(batch.alias("s"), _match("t", "s", keys, null_safe), "left")
        .select("t.*", "s._n", F.when((F.col("s._n") > 1) & ~same, clash).otherwise(F.col("s._new")).alias("_new"))
    )
    kept = joined.select(
        *[
            F.when(F.col("_n").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c)
            if c in tracked
            else F.col(c)
            for c in names
        ]
    )
    # Keys of the target that the batch touches: few, whatever the target's size.
    match = _match("t", "s", keys, null_safe)
    keyed = source.select(*keys).distinct().alias("s")
    touched = target.select(*keys).alias("t").join(keyed, match, "left_semi").distinct()
    added = source.alias("s").join(touched.alias("t"), match, "left_anti")
    return kept.unionByName(added.select(*names))


def duplicates(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


class TableAssertion(Exception):
    """A load left a table in a state it must never be in."""


def verdict(offenders: DataFrame) -> DataFrame:
    """One row: how many offenders, and whether the table passes."""
    return offenders.agg(F.count("*").alias("offenders")).withColumn(
        "passed", F.col("offenders") == 0
    )


def enforce(offenders: DataFrame, message: str) -> None:
    """Stop the run when anything offends; one row is enough to know."""
    if offenders.limit(1).count():
        raise TableAssertion(message)
