"""Document fingerprints by one-permutation MinHash; DataFrame functions only."""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.columns import text_or_empty
from turnstile.llm.staging import partitions

#: Bins, bits kept of each, and words in a shingle. A bin is the first byte of a shingle's hash.
BINS, BITS, WORDS = 256, 4, 5
PER_LONG = 64 // BITS
BLANKS = " \t\n\x0b\x0c\r"
_SHIFT = 56
_LOW = (1 << _SHIFT) - 1
_PRIME = 257  # the first prime above BINS


def _probes() -> list[tuple[int, int]]:
    """For each bin the a and b of its probes (a t + b) mod 257, t = 0, 1, ..., drawn from one seed."""
    draw = random.Random(19)
    return [(draw.randrange(1, _PRIME), draw.randrange(_PRIME)) for _ in range(BINS)]


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """df plus out: the packed fingerprint of the text, an array of 16 longs with 4 bits a bin; null if the
    text has no words.

    Each shingle of five words in lower case (A-Z) is hashed once. The first byte is its bin, and
    a bin keeps the smallest rest: the hashes are sorted with one sentinel a bin, and the first
    of each bin stays. An empty bin takes the value of the first filled bin among its own probes
    of a 2-universal hash, a permutation of all bins, so two texts with the same filled bins
    borrow alike and the estimate stays unbiased. The lowest bits of the values are packed.
    A text of fewer than five words is one shingle.
    """
    words, hashes, bins, filled = (f"_{out}_{n}" for n in ("words", "hashes", "bins", "filled"))
    low = F.translate(text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    inner = F.btrim(low, F.lit(BLANKS))
    parts = F.when(inner != "", F.split(inner, "[\\x20\\x09-\\x0D]+"))
    df = df.withColumn(words, F.transform(parts, lambda w: F.xxhash64(w)))
    n = F.size(words)
    shingle = lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(WORDS)])
    all_hashes = F.when(n >= WORDS, F.transform(F.sequence(F.lit(0), n - WORDS), shingle)).when(n > 0, F.array(F.xxhash64(words)))
    sentinels = F.array(*[F.lit(((b - BINS // 2) << _SHIFT) | _LOW) for b in range(BINS)])
    df = df.withColumn(hashes, F.sort_array(F.concat(all_hashes, sentinels))).drop(words)
    h = F.col(hashes)
    first = F.filter(h, lambda x, i: (i == 0) | (F.shiftright(x, _SHIFT) != F.shiftright(F.get(h, i - 1), _SHIFT)))
    df = df.withColumn(bins, first).drop(hashes)
    df = df.withColumn(bins, F.transform(bins, lambda x: F.when(x.bitwiseAND(F.lit(_LOW)) != _LOW, x)))
    table = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _probes()])

    def fill(x: Column, p: Column) -> Column:
        return F.coalesce(x, *[F.get(F.col(bins), (p["a"] * t + p["b"]) % _PRIME) for t in range(_PRIME)])

    df = df.withColumn(filled, F.zip_with(bins, table, fill)).drop(bins)
    pack = lambda x: F.aggregate(
        F.slice(F.col(filled), x * PER_LONG + 1, PER_LONG),
        F.lit(0).cast("long"),
        lambda a, v: F.shiftleft(a, BITS).bitwiseOR(v.bitwiseAND(F.lit((1 << BITS) - 1))),
    )
    packed = F.when(F.col(filled).isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), pack))
    return df.withColumn(out, packed).drop(filled)


def as_hex(packed: str) -> Column:
    """The fingerprint as 256 hexadecimal digits, one a bin; empty for a text without words."""
    return F.coalesce(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""), F.lit(""))


def likeness(a: str, b: str) -> Column:
    """Estimate of the Jaccard similarity, 0 to 1. Different values agree in their low bits one time in
    16, which is taken off. Two texts without words are alike, one of them is like no other."""
    ones = 0x1111111111111111
    equal = F.lit(0)
    for i in range(BINS // PER_LONG):
        x = F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(ones))
        equal = equal + (F.lit(PER_LONG) - F.bit_count(x))
    chance = 1 / (1 << BITS)
    corrected = F.greatest(F.lit(0.0), (equal / F.lit(BINS) - chance) / (1 - chance))
    return F.when(F.col(a).isNull() & F.col(b).isNull(), 1.0).when(F.col(a).isNull() | F.col(b).isNull(), 0.0).otherwise(corrected)


def with_next(df: DataFrame, key: str, value: str, also: Callable[[DataFrame], DataFrame], names: dict[str, str]) -> DataFrame:
    """df plus, for each (new name: column) of names, the column of the next row by descending key; after
    the last row comes the first.

    Rows go once to buckets between approximate quantiles of the key, as many as shuffle
    partitions, and the first row of each bucket goes to the bucket before it too, so that a
    window in a bucket finds every successor. Which bucket a row is in never changes the result.
    also(rows) adds columns after the shuffle. Ties of the key follow the value; null keys come
    last.
    """
    n = partitions(df.sparkSession)
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []), reverse=True)
    # bucket 0 holds the largest keys: the number of cuts at or above the key
    bucket = F.when(F.col(key).isNull(), len(cuts)).otherwise(_count_at_least(F.col(key), cuts))
    placed = df.withColumn("_bucket", bucket)
    tops = placed.groupBy("_bucket").agg(F.max(key).alias("_top")).orderBy("_bucket").collect()  # one row a bucket
    before = [(r["_bucket"], r["_top"], tops[i - 1]["_bucket"]) for i, r in enumerate(tops)]  # the first follows the last
    heads = df.sparkSession.createDataFrame(before, f"_bucket int, _top {dict(df.dtypes)[key]}, _before int")
    first = placed.join(F.broadcast(heads), "_bucket").filter(F.col(key).eqNullSafe(F.col("_top")))
    first = first.groupBy("_before").agg(F.min(value).alias(value))  # a tie goes to the smallest value, as below
    copies = first.select(F.lit(None).cast(dict(df.dtypes)[key]).alias(key), value, F.col("_before").alias("_bucket"), F.lit(True).alias("_copy"))
    rows = placed.select(key, value, "_bucket", F.lit(False).alias("_copy")).unionByName(copies)
    rows = also(rows.repartition(n, "_bucket"))
    following = Window.partitionBy("_bucket").orderBy("_copy", F.col(key).desc_nulls_last(), value)
    return rows.select("*", *[F.lead(c).over(following).alias(name) for name, c in names.items()]).filter(~F.col("_copy")).drop("_bucket", "_copy")


def _count_at_least(key: Column, cuts: list) -> Column:
    """How many of the falling cuts are at least the key, by halving."""
    if not cuts:
        return F.lit(0)
    size = 1 << (len(cuts)).bit_length()
    table = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(size >> k) for k in range(size.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(table, at + s - 1) >= key, at + s).otherwise(at))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next for each row.

    The edited text is the text with its last floor(n_chars / 3) code points replaced by the first as
    many, or all, of the next document's by descending key. Null text: empty, without words. A
    table of one row is its own next. Repeated rows follow each other. Other columns are left out.
    """
    docs = df.select(F.col(key), text_or_empty(text).alias("_text"))
    docs = with_next(docs, key, "_text", lambda d: with_fingerprint(d, "_text", "_own"), {"_next": "_text", "_after": "_own"})
    n = F.char_length("_text")
    k = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - k), F.substring(F.col("_next"), F.lit(1), k))
    docs = docs.withColumn("_edited", edited)
    docs = with_fingerprint(docs, "_edited", "_other")
    return docs.select(
        key,
        n.cast("long").alias("n_chars"),
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        as_hex("_own").alias("fingerprint"),
        as_hex("_other").alias("edited_fingerprint"),
        likeness("_own", "_other").alias("near_edited"),
        likeness("_own", "_after").alias("near_next"),
    )
