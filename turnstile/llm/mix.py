"""Mixing sources to target weights by a time-varying curriculum; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.columns import without, word_count
from turnstile.llm.staging import partitions, staged
from turnstile.llm.totals import with_totals_before

#: A schedule is the weight of a source over training time, as values at equally spaced times
#: from start to end, linear between them. Sources take these in turn: falling, level, rising.
RAMPS = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int], most: int) -> DataFrame:
    """sizes (source, source_size) plus rank, weight and target.

    Sources by code point, nulls last, take the weights in turn and share share[0] / share[1] of
    all words. A target stops at most times its source's size, and what is left over is shared
    by weight again until none is above: target = min(most * size, level * weight). Sorted by
    the level at which each source stops, level k is the one that spends the budget if the first
    k sources have stopped; the level that holds is the largest of them.
    """
    up, down = share
    ranked = with_totals_before(
        sizes.withColumns({"_null": F.col("source").isNull().cast("int"), "_one": F.lit(1).cast("long")}),
        [],
        [F.col("_null").asc(), F.col("source").asc()],
        {"rank": "_one"},
    ).drop("_null", "_one")
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("_stop", F.lit(most) * F.col("source_size") / F.col("weight"))
    filled = staged(
        with_totals_before(ranked, [], ["_stop", "rank"], {"_size_before": "source_size", "_weight_before": "weight"}), "sources"
    )
    every = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    size, weight = every["size"] or 0, every["weight"] or 0
    # as one division of whole numbers: (up / down * size - most * size_before) / weight_left
    spare = F.lit(up * size) - F.lit(down * most) * F.col("_size_before")
    left = F.lit(weight) - F.col("_weight_before")
    best = filled.agg(F.max(F.struct((spare / left).alias("level"), spare.alias("spare"), left.alias("left"))).alias("b")).first()["b"]
    spent, over = (best["spare"], best["left"]) if best else (0, 1)
    even = F.lit(spent) * F.col("weight") / F.lit(down * over)
    target = F.least((F.lit(most) * F.col("source_size")).cast("double"), even)
    return filled.select("source", "source_size", "rank", "weight", target.alias("target"))


def place_in_time(done: Column, ramp: Sequence[float]) -> Column:
    """Training time, 0 to 1, at which a source with this schedule has spent the part done of its
    words: the inverse of the schedule's integral, a square root in each linear piece."""
    steps = len(ramp) - 1
    areas = [(a + b) / 2 / steps for a, b in zip(ramp, ramp[1:], strict=False)]
    total, before, out = sum(areas), 0.0, None
    for k, area in enumerate(areas):
        a, b = ramp[k], ramp[k + 1]
        need = done * total - before  # = (a x + (b - a) x x / 2) / steps, x from 0 to 1 in the piece
        slope = b - a
        x = need * steps / a if slope == 0 else (F.sqrt(F.greatest(F.lit(a * a) + need * (2 * slope * steps), F.lit(0.0))) - a) / slope
        piece = (F.lit(float(k)) + F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))) / steps
        last = k == steps - 1
        condition = done * total <= before + area
        out = F.when(condition, piece) if out is None else (out.otherwise(piece) if last else out.when(condition, piece))
        before += area
    return out if steps > 1 else out.otherwise(F.lit(1.0))


def mixed(
    df: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    ramps: Sequence[Sequence[float]] = RAMPS,
    whole: bool = False,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    seed: str = "",
    carry: bool = True,
) -> DataFrame:
    """df plus size, source_size, target, taken, copies, position and again_position.

    The words of a source stand in an order drawn from its documents' ids, and again after their
    end; the mix takes the first floor(target) of them. So each source gives its target to the
    word, and no document is taken more than most (2) times. A document's position is the
    training time at which the source's schedule has spent half of its words: range_sorted()
    puts the mix in that order. whole: a document is taken whole where at least half of its
    words are within the target, so that texts stay whole; a source then misses its target by
    half a document at most. carry=False drops the text once it is counted.

    Null text: no words, never taken. Null source: a source of its own, last. Null id: ordered
    first. Repeated rows count apart. An empty table gives none. Input columns with the name of
    a result are replaced.
    """
    if most != 2:
        raise ValueError("documents are taken twice at most")
    new = ["size", "source_size", "target", "taken", "copies", "position", "again_position"]
    kept = without(df, new)
    sized = df.select(*kept, word_count(text).alias("size"))
    sized = sized if carry else sized.drop(text)
    totals = staged(sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size")), "sizes")
    targets = source_targets(totals, weights, share, most).withColumnRenamed("source", "_source")
    keyed = sized.join(targets, F.col(source).eqNullSafe(F.col("_source"))).drop("_source", "weight")
    shuffled = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)))
    keyed = keyed.withColumn("_order", shuffled)
    run = with_totals_before(keyed, ["rank"], ["_order", key], {"_before": "size"}, F.substring("_order", 1, 3))
    budget = F.floor("target")
    if whole:
        middle = F.col("_before") * 2 + F.col("size")
        takes = [(F.lit(2) * budget > middle + F.lit(2) * F.col("source_size") * k) & (F.col("size") > 0) for k in (0, 1)]
        copies = takes[0].cast("int") + takes[1].cast("int")
        taken = copies * F.col("size")
    else:
        parts = [
            F.least(F.greatest(budget - F.col("_before") - F.col("source_size") * k, F.lit(0)), F.col("size")) for k in (0, 1)
        ]
        taken = parts[0] + parts[1]
        copies = sum(((p > 0).cast("int") for p in parts[1:]), (parts[0] > 0).cast("int"))
    out = run.withColumns({"taken": taken.cast("long"), "copies": copies})

    def position(k: int) -> Column:
        done = (F.col("_before") + F.col("size") / 2 + F.col("source_size") * k) / F.col("target")
        done = F.least(done, F.lit(1.0))
        time = None
        for i, ramp in enumerate(ramps):
            here = F.col("rank") % len(ramps) == i
            time = F.when(here, place_in_time(done, ramp)) if time is None else time.when(here, place_in_time(done, ramp))
        return F.when(F.col("copies") > k, time)

    return out.withColumns({"position": position(0), "again_position": position(1)}).select(*[c for c in kept if carry or c != text], *new)


def range_sorted(mix: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each taken copy, in training order over the whole table."""
    rows = mix.withColumn("position", F.explode(F.array("position", "again_position"))).drop("again_position")
    rows = rows.filter(F.col("position").isNotNull())
    order = [F.col("position"), F.col(key)]
    return rows.repartitionByRange(partitions(mix.sparkSession), *order).sortWithinPartitions(*order)
