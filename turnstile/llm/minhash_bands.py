"""MinHash near-duplicates: many universal hash minima, bands, verified signatures, exact links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.columns import in_bytes, text_or_empty
from turnstile.llm.components import components
from turnstile.llm.staging import partitions, staged
from turnstile.llm.totals import with_totals_before

WORDS = 4
PERCENT = 80  # least share of the union that two linked sets have in common
BANDS, ROWS = 36, 4  # minima of a set: one key for each band of so many
HASHES = BANDS * ROWS
#: Equal minima below which a pair is not looked at in full. Sets with 80 % in common share 115 of
#: 144 on average, and fewer than 84 once in 40 million cases.
LEAST_EQUAL = 84
BLOCK = 256  # weight of a block: a set weighs 1, and 1 more for each WEIGHT shingles
WEIGHT = 2048
OVERLAP = 32  # weight that consecutive blocks of a canopy have in common
AT_ONCE = 1 << 15  # shingles whose minima are taken at once

_random = np.random.Generator(np.random.PCG64(12))
_FACTORS = _random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2)
_PLACES = _random.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes | None) -> np.ndarray:
    """A text's set of shingles as sorted 64-bit hashes: four words in lower case (A-Z); with fewer words all
    of them as one; none without words."""
    words = text.lower().split() if text else []
    n = len(words)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < WORDS:
        return _mixed((h * _PLACES[:n]).sum(keepdims=True) + np.uint64(n)) if n else h
    return np.unique(_mixed(sum(h[k : n - WORDS + 1 + k] * _PLACES[k] for k in range(WORDS))))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, none empty, its least value under each function x -> a * x + b (mod 2**64)."""
    out = np.full((len(sets), HASHES), np.uint64(2**64 - 1))
    begin = 0
    while begin < len(sets):
        end, total = begin + 1, len(sets[begin])
        while end < len(sets) and total + len(sets[end]) <= AT_ONCE:
            total += len(sets[end])
            end += 1
        joined = sets[begin] if end == begin + 1 else np.concatenate(sets[begin:end])
        for s in range(0, len(joined), AT_ONCE):  # more than one slice for a long set only
            part = joined[s : s + AT_ONCE]
            starts = np.cumsum([0, *map(len, sets[begin : end - 1])]) if end > begin + 1 else [0]
            for i in range(HASHES):
                least = np.minimum.reduceat(part * _FACTORS[i] + _TERMS[i], starts)
                np.minimum(out[begin:end, i], least, out=out[begin:end, i])
        begin = end
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a set's minima."""
    parts = least.reshape(len(least), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        key = _mixed(key * _ODD + parts[:, :, k])
    return key.view(np.int64)


def signatures(least: np.ndarray) -> np.ndarray:
    """A byte of each minimum."""
    return (_mixed(least) >> np.uint64(56)).astype(np.uint8)


def _text_and_node(text: str) -> tuple[Column, Column]:
    body = text_or_empty(text)
    return body.alias("text"), F.xxhash64(body).alias("node")


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, node, n_shingles, keys, signature) of all rows; node names the text. A task gives keys and
    signature with the first row of a text only, and none for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            nodes, texts = batch.column(1).to_pylist(), in_bytes(batch.column(2))
            sets, at = [], []
            for i, (node, value) in enumerate(zip(nodes, texts, strict=True)):
                if node not in seen:
                    s = shingles(value)
                    seen[node] = len(s)
                    if len(s):
                        sets.append(s)
                        at.append(i)
            keys: list = [None] * len(nodes)
            signs: list = [None] * len(nodes)
            if sets:
                least = minima(sets)
                for i, k, s in zip(at, band_keys(least), signatures(least), strict=True):
                    keys[i], signs[i] = k, s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([seen[n] for n in nodes], pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                names=["doc_id", "node", "n_shingles", "keys", "signature"],
            )

    body, node = _text_and_node(text)
    source = docs.select(F.col(key).alias("doc_id"), node, body)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, node long, n_shingles long, keys array<long>, signature binary")


def pairs(signs: np.ndarray, sizes: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places i < j with different numbers in apart whose signatures and sizes allow a link, likest first."""
    out_i, out_j, out_equal = [], [], []
    for s in range(0, len(signs), 64):
        equal = (signs[s : s + 64, None, :] == signs[None, :, :]).sum(2)
        less = np.minimum(sizes[s : s + 64, None], sizes[None, :])
        more = np.maximum(sizes[s : s + 64, None], sizes[None, :])
        ok = (equal >= LEAST_EQUAL) & (100 * less >= PERCENT * more) & (apart[s : s + 64, None] != apart[None, :])
        i, j = np.nonzero(ok)
        keep = i + s < j
        out_i.append(i[keep] + s)
        out_j.append(j[keep])
        out_equal.append(equal[i[keep], j[keep]])
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(-np.concatenate(out_equal), kind="stable")
    return np.concatenate(out_i)[order], np.concatenate(out_j)[order]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets, sorted and without repeats, have enough in common."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _forest(rows: list[tuple]) -> Iterator[tuple[int, int]]:
    """Links that hold together what all links among the rows (component, node, n, signature, text) do.

    Pairs that the links found so far join, or that are in one component from before, are not looked at;
    every other pair that signatures allow is confirmed on the full sets."""
    rows = list({r[1]: r for r in rows}.values())  # a text that several rows have counts once
    signs = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), HASHES)
    _, apart = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
    root = list(range(len(rows)))
    sets: dict[int, np.ndarray] = {}

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict[int, int] = {}
    for i, c in enumerate(apart.tolist()):
        root[i] = first.setdefault(c, i)
    for i, j in zip(*(c.tolist() for c in pairs(signs, np.array([r[2] for r in rows], np.int64), apart)), strict=True):
        x, y = top(i), top(j)
        if x != y:
            for k in (i, j):
                if k not in sets:
                    sets[k] = shingles(rows[k][4])
            if linked(sets[i], sets[j]):
                root[max(x, y)] = min(x, y)
                yield rows[i][1], rows[j][1]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): links among the rows of each group; its rows come one after the other."""
    current, rows = None, []

    def found() -> pa.RecordBatch:
        edges = list(_forest(rows))
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        columns = [c.to_pylist() if k != 6 else in_bytes(c) for k, c in enumerate(batch.columns)]
        for a, b, *row in zip(*columns, strict=True):
            if rows and (a, b) != current:
                yield found()
                rows = []
            current = (a, b)
            rows.append(tuple(row))
    if rows:
        yield found()


def _among(rows: DataFrame) -> DataFrame:
    """Links among the rows (a, b, component, node, n, signature, text) of each (a, b)."""
    rows = rows.select("a", "b", "component", "node", "n", "signature", "text")
    dealt = rows.repartition(partitions(rows.sparkSession), "a", "b").sortWithinPartitions("a", "b")
    return dealt.mapInArrow(_links, "a long, b long")


def _block(canopy: Column, weight: Column) -> Column:
    return F.xxhash64(canopy, F.floor(weight / BLOCK))


def _weighed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows plus weight: that of all rows before it in its canopy."""
    rows = rows.withColumn("_own", 1 + F.floor(F.col("n") / WEIGHT))
    return staged(with_totals_before(rows, ["canopy"], order, {"weight": "_own"}).drop("_own"), "weighed")


def _in_canopies(shared: DataFrame) -> DataFrame:
    """(node, n, canopy, weight) of all sets that share a key; weight: of those before it in its canopy.

    A key's least set leads it; a set follows the least of its leaders, and goes to the canopy of that
    one's. So the many sets that share frequent keys meet in few canopies; there, like sizes are neighbours."""
    led = staged(shared.groupBy("node", "n").agg(F.min("leader").alias("leader")), "led")
    above = led.select(F.col("node").alias("leader"), F.col("leader").alias("canopy"))
    return _weighed(led.join(above, "leader").select("node", "n", "canopy"), ["n", "node"])


def _with_texts(docs: DataFrame, key: str, text: str, table: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, signature, text) of the wanted nodes, each read off the row of its smallest id."""
    body, node = _text_and_node(text)
    held = table.join(wanted.select("node"), "node", "left_semi")
    first = held.groupBy("node").agg(F.min("doc_id").alias("_first"))
    rows = docs.select(F.col(key).alias("doc_id"), node, body).alias("d").join(first.alias("f"), (F.col("d.node") == F.col("f.node")) & F.col("d.doc_id").eqNullSafe(F.col("f._first")))
    texts = rows.select("d.node", "d.text").groupBy("node").agg(F.first("text").alias("text"))
    signs = held.filter("signature IS NOT NULL").groupBy("node").agg(F.first("signature").alias("signature"))
    return staged(texts.join(signs, "node"), "texts")


def _across(shared: DataFrame, placed: DataFrame) -> DataFrame:
    """(a, b, node, n, component): the sets of each two blocks that must meet. placed: node, n, canopy, component.

    Only sets with a key that two components share take part. In new blocks, sets of one component are neighbours,
    and blocks wholly in the component that most blocks of a key are in do not meet over it."""
    at = shared.select("band", "node").join(placed, "node")
    mixed = at.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("band")
    at = staged(at.join(mixed, "band"), "active")
    blocks = _weighed(at.select("node", "n", "canopy", "component").distinct(), ["component", "n", "node"])
    blocks = staged(blocks.select("node", "n", "component", _block(F.col("canopy"), F.col("weight")).alias("block")), "blocks")
    where = at.select("band", "node").join(blocks, "node").groupBy("band", "block")
    where = staged(where.agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most")), "where")
    main = where.filter("lo = hi").groupBy("band", "lo").agg(F.count("*").alias("blocks"))
    main = main.groupBy("band").agg(F.max_by("lo", F.struct("blocks", "lo")).alias("main"))
    where = where.join(main, "band", "left")
    other = where.filter("main IS NULL OR lo < hi OR lo != main")
    other = other.select("band", *[F.col(c).alias(c + "_o") for c in ("block", "lo", "hi", "least", "most")])
    near = (100 * F.col("most") >= PERCENT * F.col("least_o")) & (100 * F.col("most_o") >= PERCENT * F.col("least"))
    apart = (F.col("lo") < F.col("hi")) | (F.col("lo_o") < F.col("hi_o")) | (F.col("lo") != F.col("lo_o"))
    met = where.join(other, "band").filter(near & apart)
    met = met.select(F.least("block", "block_o").alias("a"), F.greatest("block", "block_o").alias("b")).distinct()
    sides = met.withColumn("block", F.explode(F.array_distinct(F.array("a", "b"))))
    return sides.join(blocks, "block").select("a", "b", "node", "n", "component")


def links(docs: DataFrame, table: DataFrame, key: str, text: str) -> DataFrame:
    """(a, b): links between texts that join the same texts as all links do.

    Texts that share a band's key meet first inside blocks of their canopy, together with the canopy's first
    text and the beginning of the next block, so that a large group of near copies becomes one component;
    then the texts that share keys but not yet a component meet, block by block."""
    postings = table.filter("keys IS NOT NULL").select("node", F.col("n_shingles").alias("n"), F.explode("keys").alias("band"))
    leaders = postings.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("_last")).filter("leader < _last").drop("_last")
    shared = staged(postings.join(leaders, "band"), "shared")
    canopies = _in_canopies(shared)
    texts = _with_texts(docs, key, text, table, canopies)

    weight, canopy = F.col("weight"), F.col("canopy")
    early = (weight >= BLOCK) & (weight % BLOCK < OVERLAP)
    inside = canopies.withColumn("a", F.explode(F.when(early, F.array(_block(canopy, weight), _block(canopy, weight - BLOCK))).otherwise(F.array(_block(canopy, weight)))))
    heads = inside.select("canopy", "a").distinct().join(canopies.select(F.col("node").alias("canopy"), "n"), "canopy")
    inside = inside.select("a", "node", "n").union(heads.select("a", F.col("canopy").alias("node"), "n"))
    inside = inside.join(texts, "node").withColumns({"b": F.col("a"), "component": F.col("node")})
    within = staged(_among(inside), "within")

    known = components(within)
    placed = canopies.join(known, F.col("node") == F.col("id"), "left")
    placed = staged(placed.select("node", "n", "canopy", F.coalesce("component", "node").alias("component")), "placed")
    return within.union(_among(_across(shared, placed).join(texts, "node")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row.

    Documents with 100 * intersection >= 80 * union of their sets of four-word shingles are linked,
    component_id is the smallest id that links lead to, and kept tells whether that is the row's own.
    A set's 144 minima under functions a * x + b make 36 keys of 4; two linked sets share no key once
    in 170 million cases (0.5904 ** 36) or rarer. What shares a key is compared by signature, and what passes is
    confirmed on the full sets, so no link is wrong but by equal 64-bit hashes. Copies of one
    text are one node throughout. Ids are of any type with an order.

    Null text or no words: an empty set, a component of its own. Null id: takes the component of its
    text, links others as any row does, is the smallest of none, and is kept where no row with an id is
    in the component. Repeated rows get the same answer. Other columns are left out. Empty table: no rows.
    """
    table = staged(signed(docs, key, text), "signed")
    first = table.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    found = staged(links(docs, table, key, text), "found")
    joined = staged(first.join(components(found), F.col("node") == F.col("id")).select("node", "first", "component"), "joined")
    least = joined.groupBy("component").agg(F.min("first").alias("_root"))
    roots = joined.join(least, "component").select("node", "_root")
    roots = first.join(roots, "node", "left").select("node", F.coalesce("_root", "first").alias("_root"))
    out = table.join(roots, "node", "left").select("doc_id", "n_shingles", F.coalesce("_root", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
