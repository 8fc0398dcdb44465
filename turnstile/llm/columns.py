"""Small helpers shared by the operators: words, sizes, and Arrow batches with columns added."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
ROWS = 512  # rows handled at once inside a task


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(column: str) -> Column:
    """Number of words between blanks and control characters 9 to 13; null has none."""
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of df but those that a result column of the same name (in any case) replaces."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def in_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def with_arrow_columns(
    df: DataFrame,
    inputs: list[str],
    fields: list[T.StructField],
    start: Callable[[], Callable[..., list[pa.Array]]],
    keep: list[str] | None = None,
) -> DataFrame:
    """df plus computed columns. start() runs once a task and returns a function from the input
    columns of a batch to the new columns. keep: the columns carried along (all); a column
    with the name of a new one is replaced."""
    kept = [c for c in without(df, [f.name for f in fields]) if keep is None or c in keep]
    extra = [c for c in inputs if c not in kept]
    source = df.select(*[F.col(f"`{c}`") for c in kept + extra])
    order = source.columns
    at = [order.index(c) for c in inputs]
    schema = T.StructType([source.schema[c] for c in kept] + fields)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                new = work(*[part.column(i) for i in at])
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *new], names=names)

    return source.mapInArrow(run, schema)
