"""Filter interaction audit: what each filter removes, in every order of the filters."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.columns import WORD, text_or_empty
from turnstile.llm.staging import staged

#: From a text and its words to whether the filter removes the document.
Failure = Callable[[Column, Column], Column]

FILTERS: dict[str, Failure] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
    "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
    "D": lambda text, words: text.rlike(r"[#$%&*|]"),
}
REPEAT = "E"
COPIES_A_TASK = 4096  # of one text; more are dealt to several tasks


def _rows(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(doc_id, part, hash, text) of all rows."""
    body = text_or_empty(text)
    lang = F.coalesce(F.col(part).cast("string"), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), lang.alias("part"), F.xxhash64(body).alias("hash"), body.alias("text"))


def own_failures(rows: DataFrame, filters: dict[str, Failure]) -> DataFrame:
    """(doc_id, part, hash, mask): which filters a text fails by itself, a bit each, in one pass."""
    words = rows.withColumn("_words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    mask = F.lit(0)
    for place, fails in enumerate(filters.values()):
        mask = mask + F.when(fails(F.col("text"), F.col("_words")), 1 << place).otherwise(0)
    return words.select("doc_id", "part", "hash", mask.alias("mask"))


def later_copies(rows: DataFrame, hashed: DataFrame) -> DataFrame:
    """(doc_id, part, hash) of the rows whose very text a smaller doc_id has too.

    A left-semi join on hash, text and smaller id. Only texts whose hash occurs again take part; the
    side of the smaller ids holds one row a text, its smallest id; and copies of one text are dealt to
    as many tasks as their number asks for, each with its own row of that side."""
    again = hashed.groupBy("hash").agg(F.count("*").alias("times"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    again = again.select("hash", F.ceil(F.col("times") / COPIES_A_TASK).cast("int").alias("shares"))
    copies = staged(rows.join(again, "hash"), "copies")
    first = copies.groupBy("hash", "text", "shares").agg(F.min("doc_id").alias("first"))
    first = first.select("hash", "text", "first", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    dealt = copies.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.col("shares").cast("long")).cast("int")).alias("d")
    same = [F.col(f"d.{c}") == F.col(f"f.{c}") for c in ("hash", "share", "text")]
    return dealt.join(first.alias("f"), [*same, F.col("f.first") < F.col("d.doc_id")], "left_semi").select("doc_id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame, filters: dict[str, Failure] = FILTERS, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, docs, good, toxic): documents for each combination of failed filters.

    Bit i of mask is filter i; the bit after the last is that of repeats. See audit."""
    rows = _rows(docs, key, text, part)
    own = staged(own_failures(rows, filters), "failures")
    repeat = later_copies(rows, own).select("doc_id", "part", "hash", F.lit(1 << len(filters)).alias("mask"), F.lit(0).cast("long").alias("docs"))
    failed = own.withColumn("docs", F.lit(1).cast("long")).unionByName(repeat)
    failed = failed.groupBy("doc_id", "part", "hash").agg(F.bit_or("mask").alias("mask"), F.sum("docs").alias("docs"))
    is_one = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("int"))
    known = labels.groupBy(F.col("doc_id").alias("_labelled")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    judged = failed.join(known, F.col("doc_id") == F.col("_labelled"), "left")
    marked = lambda name: F.sum(F.col("docs") * F.coalesce(F.col(name), F.lit(0))).alias(name)
    return judged.groupBy("part", "mask").agg(F.sum("docs").alias("docs"), marked("good"), marked("toxic"))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Failure] = FILTERS, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """For each part, order of the filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    Each text is read for its own failures once and, where its hash occurs again, for its copies;
    failures are one bit each, joined by id, and counted by combination of bits. The orders are applied
    to these counts (2 ** filters of them a part at most), never to documents. A filter's share over all
    orders needs no orders: of a document that fails k filters each removes it in one order of k.

    docs: a text's filters by letter, then REPEAT: the same text has a smaller id anywhere in the table.
    labels: doc_id, quality, toxic; of several rows of an id any 1 counts; other columns are not read.
    Null or empty text: one text without words. Null part: that of the empty string. Null id: no label,
    and neither a repeat nor what others repeat. Rows of one id do not repeat one another; rows equal in
    id, part and text are counted each. Empty table: no rows.
    """
    letters = [*filters, REPEAT]
    orders = ["".join(p) for p in permutations(letters)]
    counts = combinations(docs, labels, filters, key, text, part)
    steps = counts.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in orders])))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))

    def bits(of: Column) -> Column:
        mask = F.lit(0)
        for place, letter in enumerate(letters):
            mask = mask + F.when(of.contains(letter), 1 << place).otherwise(0)
        return mask

    order, step = F.col("filter_order"), F.col("step")
    steps = steps.withColumn("_bit", bits(F.substr(order, step, F.lit(1)))).withColumn("_before", bits(F.substr(order, F.lit(1), step - 1)))
    fails = F.col("mask").bitwiseAND(F.col("_bit")) != 0
    reached = F.col("mask").bitwiseAND(F.col("_before")) == 0

    def total(condition: Column, value: str | Column = "docs") -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("long")))

    of_all = F.col("docs") * (F.lit(factorial(len(letters))).cast("long") / F.bit_count("mask")).cast("long")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & reached).alias("kept"),
        total(fails & reached).alias("removed"),
        total(fails & ~reached).alias("redundant"),
        total(F.col("mask") == F.col("_bit")).alias("unique_fails"),
        total(fails & reached, "good").alias("good_lost"),
        total(fails & reached, "toxic").alias("toxic_lost"),
        total(fails, of_all).alias("shapley"),
    )
