"""Sharding along a Hilbert curve over quantised metadata; DataFrame functions only."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.columns import text_or_empty, without
from turnstile.llm.totals import with_rank, with_totals_before

BINS = 4096


def _scale(df: DataFrame, dims: list[str]) -> list[Column]:
    """Each dimension as a number of the same order: logarithms of numbers, six bytes of a string
    after what its smallest and largest value have in common."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = {d: F.col(d) if isinstance(kinds[d], (T.NumericType, T.StringType)) else F.col(d).cast("string") for d in dims}
    ends = df.agg(*[f(values[d]).alias(f"{n}_{i}") for i, d in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = []
    for i, d in enumerate(dims):
        lo, hi = ends[f"lo_{i}"], ends[f"hi_{i}"]
        if isinstance(kinds[d], T.NumericType):
            out.append(F.log1p(values[d].cast("double") - F.lit(float(lo or 0))))
        else:
            same = len(os.path.commonprefix([(lo or "").encode(), (hi or "").encode()]))
            six = F.hex(F.substring(F.encode(values[d], "UTF-8"), same + 1, 6))
            out.append(F.conv(F.rpad(six, 12, "0"), 16, 10).cast("double"))
    return out


def quantised(df: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """df plus _cell_0, _cell_1, ...: 0 to 2**bits - 1 for each dimension, equal in rows as far as
    its values allow. Nulls come lowest. Counts over all rows in BINS steps set the bounds; they
    are joined back as tables of at most BINS + 1 rows."""
    numbers = _scale(df, dims)
    out = df.withColumns({f"_v_{i}": v for i, v in enumerate(numbers)})
    ends = out.agg(*[f(f"_v_{i}").alias(f"{n}_{i}") for i in range(len(dims)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    steps = {}
    for i in range(len(dims)):
        lo, hi = float(ends[f"lo_{i}"] or 0), float(ends[f"hi_{i}"] or 0)
        width = (hi - lo) or 1.0
        steps[f"_bin_{i}"] = F.coalesce(F.floor((F.col(f"_v_{i}") - lo) / width * (BINS - 1)).cast("int"), F.lit(-1))
    out = out.withColumns(steps).drop(*[f"_v_{i}" for i in range(len(dims))])
    for i in range(len(dims)):
        counts = out.groupBy(f"_bin_{i}").count().collect()  # at most BINS + 1 rows
        total, seen, cells = sum(r["count"] for r in counts), 0, []
        for r in sorted(counts, key=lambda r: r[0]):
            middle = seen + r["count"] / 2
            cells.append((r[0], min(2**bits - 1, int(middle / total * 2**bits))))
            seen += r["count"]
        table = df.sparkSession.createDataFrame(cells, f"_bin_{i} int, _cell_{i} int")
        out = out.join(F.broadcast(table), f"_bin_{i}").drop(f"_bin_{i}")
    return out


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve: reflect and swap axes from the highest bit down, Gray-code, and
    interleave the bits."""
    n, top = len(cells), 1 << (bits - 1)

    def turn(x: Column, k: Column) -> Column:
        q = F.lit(top).bitwiseAND(F.lit(-1))  # int
        q = F.call_function("shiftright", q, (k / n).cast("int"))
        i = (k % n).cast("int")
        first, own, low = x[0], F.element_at(x, i + 1), q - 1
        is_set = own.bitwiseAND(q) != 0
        swap = F.when(is_set, F.lit(0)).otherwise(first.bitwiseXOR(own).bitwiseAND(low))
        head = first.bitwiseXOR(F.when(is_set, low).otherwise(swap))
        return F.transform(x, lambda v, j: F.when(j == 0, head).when(j == i, v.bitwiseXOR(swap)).otherwise(v))

    turned = F.aggregate(F.sequence(F.lit(0), F.lit(n * (bits - 1) - 1)), F.array(*[c.cast("int") for c in cells]), turn)

    def gray(x: Column) -> Column:
        return F.transform(x, lambda v, j: F.aggregate(F.slice(x, 1, j + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))

    def mask(last: Column) -> Column:
        flips = [F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)) for b in range(1, bits)]
        out = F.lit(0)
        for f in flips:
            out = out.bitwiseXOR(f)
        return out

    def interleave(x: Column, t: Column) -> Column:
        out = F.lit(0).cast("long")
        for b in range(bits - 1, -1, -1):
            for i in range(n):
                bit = F.shiftright(x[i].bitwiseXOR(t), b).bitwiseAND(F.lit(1))
                out = out * 2 + bit
        return out

    # one-element transforms name the intermediate arrays, so that each is computed once
    named = F.transform(F.array(turned), gray)
    masked = F.transform(named, lambda x: F.struct(x.alias("x"), mask(F.element_at(x, n)).alias("t")))
    return F.transform(masked, lambda s: interleave(s["x"], s["t"]))[0]


def hilbert_shards(
    df: DataFrame,
    shards: int,
    dims: tuple[str, ...] = ("lang", "source", "n_chars"),
    law: str = "rows",
    bits: int = 6,
    text: str = "text",
    tie: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of df with size, text_crc32, hilbert, law, shard, slot and grown_shard.

    The dimensions are quantised to 2**bits cells, the rows sorted by their place on the Hilbert
    curve, and the sorted run cut into shards: near each other in all dimensions means the same
    shard, so minima and maxima of a file prune on any of them. law "rows" cuts so that counts
    differ by one at most, "bytes" so that sizes (UTF-8 bytes plus 1) are near equal. Inside a
    place, rows follow size, checksum of the text and the tie column, so equal texts stay
    together up to a cut. slot numbers a shard's rows from 0. grown_shard is null: with one more
    shard every cut moves.

    Null dimension: lowest cell. Null text: size 1, checksum 0. Equal rows: cut at will. An empty
    table gives none. Input columns with the name of a result are replaced. keep: columns
    carried along (all).
    """
    if law not in ("rows", "bytes"):
        raise ValueError("law is rows or bytes")
    new = ["size", "text_crc32", "hilbert", "law", "shard", "slot", "grown_shard"]
    kept = [c for c in without(df, new) if keep is None or c in keep]
    narrow = df.select(*{c: None for c in [*kept, *dims, text, tie]})
    sized = quantised(narrow, list(dims), bits).withColumns(
        {
            "size": F.octet_length(text_or_empty(text)).cast("long") + 1,
            "text_crc32": F.crc32(text_or_empty(text)),
            "hilbert": hilbert_index([F.col(f"_cell_{i}") for i in range(len(dims))], bits),
            "_one": F.lit(1).cast("long"),
        }
    )
    sized = sized.select(*{c: None for c in [*kept, tie]}, "size", "text_crc32", "hilbert", "_one")
    order = ["hilbert", "size", "text_crc32", tie]
    if law == "rows":
        placed = with_rank(sized, order, "_rank")
        n = placed.count()
        cut = F.expr(f"CAST(_rank * {shards} div {max(n, 1)} AS INT)")
        first = F.expr(f"(CAST(shard AS BIGINT) * {n} + {shards - 1}) div {shards}")
        out = placed.withColumn("shard", cut).withColumn("slot", F.col("_rank") - first)
    else:
        placed = with_totals_before(sized, [], order, {"_rank": "_one", "_before": "size"})
        every = placed.agg(F.sum("size").alias("bytes")).first()
        cut = F.expr(f"CAST((_before + size div 2) * {shards} div {max(every['bytes'] or 1, 1)} AS INT)")
        out = placed.withColumn("shard", cut)
        firsts = out.groupBy("shard").agg(F.min("_rank").alias("_first"))  # one row a shard
        out = out.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("_rank") - F.col("_first"))
    return out.withColumns({"law": F.lit(law), "grown_shard": F.lit(None).cast("int")}).select(*kept, *new)
