"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.staging import staged


def components(links: DataFrame) -> DataFrame:
    """(id, component): for each id in links (a, b) the smallest id that links lead to.

    Alternating stars: a node's larger neighbours are hung on its smallest neighbour, then its
    smaller ones; the number of links never grows, and when nothing changes each id hangs on the
    smallest of its component. A hub's links are one hot key of a join with one row a key, which
    adaptive execution splits.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = staged(edges, "links")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()  # the same in any order of rows
        if mark == before or not mark[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        before = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(smallest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(hung.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "links")
