"""N-gram Jaccard join: a blocked sparse matrix product of documents by n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.columns import in_bytes
from turnstile.llm.components import components
from turnstile.llm.staging import partitions, staged
from turnstile.llm.totals import with_totals_before

WORDS = 5
PERCENT = 80  # least share of the union that two linked sets have in common
BLOCK = 512  # documents in a block of the product
SLICE = 8192  # n-grams in a slice of the product
FLUSH = 2_000_000  # n-grams that a task gathers before it deals them to buckets

# odd multipliers, one for each place in a shingle, from the golden ratio's digits by repeated squaring
_MIX = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(WORDS)], np.uint64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of x."""
    for shift, factor in ((30, _MIX[1]), (27, _MIX[2])):
        x = (x ^ (x >> np.uint64(shift))) * factor
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None) -> np.ndarray:
    """The set of a text's shingles as sorted 64-bit hashes: five words in lower case (A-Z); with fewer
    words all of them as one; none without words."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < WORDS:
        return _scrambled((h * _MIX[:n]).sum(keepdims=True) + np.uint64(n))
    s = h[: n - WORDS + 1] * _MIX[0]
    for k in range(1, WORDS):
        s = s + h[k : n - WORDS + 1 + k] * _MIX[k]
    return np.unique(_scrambled(s))


def set_ids(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, node): node names the set, equal for equal sets; null for an empty one."""

    def run(batches):
        for batch in batches:
            sizes, nodes = [], []
            for value in in_bytes(batch.column(1)):
                s = shingles(value)
                sizes.append(len(s))
                nodes.append(_node(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())], names=["doc_id", "n_shingles", "node"])

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_shingles long, node long")


def _node(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _binary(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array([a.tobytes()], pa.binary()) for a in arrays]


_BLOB = "bucket int, nodes binary, sizes binary, counts binary, grams binary, dfs binary"
_NAMES = [c.split()[0] for c in _BLOB.split(", ")]


def _dealt(where: np.ndarray, owner: np.ndarray, grams: np.ndarray, dfs: np.ndarray | None, nodes: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries (owner, gram) as one row a bucket; owner is the entry's place in nodes and in rising order
    within a bucket."""
    order = np.argsort(where, kind="stable")
    where, owner, grams = where[order], owner[order], grams[order]
    cuts = np.flatnonzero(np.diff(where)) + 1
    for s, e in zip([0, *cuts], [*cuts, len(where)], strict=True):
        if e > s:
            firsts = np.concatenate([[0], np.flatnonzero(np.diff(owner[s:e])) + 1])
            mine = owner[s:e][firsts]
            counts = np.diff([*firsts, e - s]).astype(np.uint32)
            df = dfs[order][s:e] if dfs is not None else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([int(where[s])], pa.int32()), *_binary(nodes[mine], sizes[mine], counts, grams[s:e], df)], names=_NAMES)


def _incidence(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """The matrix, packed: for each bucket of n-grams the sets that have some, and which."""

    def run(batches):
        nodes: list[int] = []
        sets: list[np.ndarray] = []
        seen: set[int] = set()
        total = 0

        def flush():
            sizes = np.array([len(s) for s in sets], np.uint32)
            grams = np.concatenate(sets)
            where = ((grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint32)
            where = where.astype(np.uint16) if buckets <= 1 << 16 else where
            yield from _dealt(where, np.repeat(np.arange(len(sets), dtype=np.int32), sizes), grams, None, np.array(nodes, np.int64), sizes)

        for batch in batches:
            for value in in_bytes(batch.column(0)):
                s = shingles(value)
                if len(s) and (node := _node(s)) not in seen:  # copies in the task are seen once
                    seen.add(node)
                    nodes.append(node)
                    sets.append(s)
                    total += len(s)
                    if total >= FLUSH:
                        yield from flush()
                        nodes, sets, seen, total = [], [], set(), 0
        if sets:
            yield from flush()

    return docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, _BLOB)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(nodes, sizes, owners, grams, dfs) of each bucket, whose rows come one after the other."""
    kinds = (np.int64, np.uint32, np.uint32, np.uint64, np.uint32)
    current, rows = None, []

    def joined():
        nodes, sizes, counts, grams, dfs = (np.concatenate([np.frombuffer(r[i], k) for r in rows]) for i, k in enumerate(kinds))
        return nodes, sizes, np.repeat(np.arange(len(nodes), dtype=np.int64), counts), grams, dfs

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for bucket, *row in zip(*columns, strict=True):
            if rows and bucket != current:
                yield joined()
                rows = []
            current = bucket
            rows.append(row)
    if rows:
        yield joined()


def _shared(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Of a bucket's n-grams those in two sets or more, with their counts of sets, dealt by set."""
    for nodes, sizes, owner, grams, _ in _by_bucket(batches):
        _, first = np.unique(nodes, return_index=True)
        fresh = np.zeros(len(nodes), bool)
        fresh[first] = True  # a set that several tasks have seen counts once
        keep = fresh[owner]
        owner, grams = owner[keep], grams[keep]
        order = np.argsort(grams)
        ends = np.flatnonzero(np.append(np.diff(grams[order]) != 0, True))
        counts = np.diff(np.concatenate([[-1], ends]))
        df = np.empty(len(grams), np.uint32)
        df[order] = np.repeat(counts, counts)
        keep = df > 1
        if keep.any():
            where = ((nodes.view(np.uint64) >> np.uint64(32)) % np.uint64(groups)).astype(np.int32)
            yield from _dealt(where[owner[keep]], owner[keep], grams[keep], df[keep], nodes, sizes)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, grams, prefix) of the sets whose prefix holds shared n-grams.

    N-grams in order of rarity: those of one set only first, then by count and hash. Two linked
    sets have in common at least need = ceil(0.8 n) of the n of each, hence one of its first
    n - need + 1."""
    for nodes, sizes, owner, grams, dfs in _by_bucket(batches):
        kept, which = np.unique(nodes, return_inverse=True)
        owner = which[owner]
        n = np.zeros(len(kept), np.int64)
        n[which] = sizes
        order = np.lexsort((grams, dfs, owner))
        owner, grams = owner[order], grams[order]
        shared = np.bincount(owner, minlength=len(kept))
        starts = np.cumsum(shared) - shared
        length = n - (PERCENT * n + 99) // 100 + 1 - (n - shared)
        rows = [(int(kept[k]), int(n[k]), np.sort(grams[s : s + m]).tobytes(), grams[s : s + p].view(np.int64).tolist()) for k in np.flatnonzero(length > 0) for s, m, p in [(starts[k], shared[k], length[k])]]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)],
                names=["node", "n", "grams", "prefix"],
            )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """(node, n, grams, prefix) of all sets that may have a partner."""
    buckets = partitions(docs.sparkSession)
    matrix = _incidence(docs, text, buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    shared = matrix.mapInArrow(lambda it: _shared(it, buckets), _BLOB).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return staged(shared.mapInArrow(_prefixes, "node long, n long, grams binary, prefix array<long>"), "sets")


def _blocks(sets: DataFrame, postings: DataFrame) -> DataFrame:
    """(node, n, canopy, block): sets that share prefix n-grams in blocks of BLOCK, like with like.

    Each n-gram's smallest set is its leader, and votes for it with the number of its sets; a set
    follows the leader with most votes, and goes to the canopy of the leader's leader. So the
    many sets that share frequent n-grams meet in few canopies. Inside a canopy, blocks follow
    the size of the sets."""
    leaders = postings.groupBy("gram").agg(F.min("node").alias("leader"), F.count("*").alias("votes"))
    votes = postings.join(leaders, "gram").groupBy("node", "n", "leader").agg(F.sum("votes").alias("votes"))
    led = staged(votes.groupBy("node", "n").agg(F.max_by("leader", F.struct("votes", "leader")).alias("leader")), "led")
    above = led.select(F.col("node").alias("leader"), F.col("leader").alias("canopy"))
    chosen = led.join(above, "leader").select("node", "n", "canopy", F.lit(1).cast("long").alias("_one"))
    ranked = with_totals_before(chosen, ["canopy"], ["n", "node"], {"rank": "_one"})
    return ranked.select("node", "n", F.xxhash64("canopy", F.floor(F.col("rank") / BLOCK)).alias("block"))


def overlaps(a: list[np.ndarray], b: list[np.ndarray], na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Which sets of a link with which of b: their product, slice of n-grams by slice.

    Pairs of sizes that rule a link out are discarded at once; after each slice so are those that
    what is left can't bring up to the bound 180 overlap >= 80 (n + m), and the product ends when
    none is left."""
    least = np.minimum(na[:, None], nb[None, :])
    most = np.maximum(na[:, None], nb[None, :])
    alive = 100 * least >= PERCENT * most
    bound = PERCENT * (na[:, None] + nb[None, :])
    counts = np.zeros(alive.shape, np.int64)
    sizes_a, sizes_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    grams, number, times = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    here = times[number] > 1
    column = (np.cumsum(times > 1) - 1)[number]
    row = np.concatenate([np.repeat(np.arange(len(a)), sizes_a), np.repeat(np.arange(len(b)) + len(a), sizes_b)])
    row, column = row[here], column[here]
    left = np.bincount(row, minlength=len(a) + len(b))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, total, SLICE):
        alive &= (100 + PERCENT) * (counts + np.minimum(left[: len(a), None], left[None, len(a) :])) >= bound
        if not alive.any():
            break
        s, e = np.searchsorted(column, [start, start + SLICE])
        part = np.zeros((len(a) + len(b), min(SLICE, total - start)), np.float32)
        part[row[s:e], column[s:e] - start] = 1
        counts += (part[: len(a)] @ part[len(a) :].T).astype(np.int64)
        left = left - np.bincount(row[s:e], minlength=len(left))
    return alive & ((100 + PERCENT) * counts >= bound)


def _forest(linked: np.ndarray, names_a: np.ndarray, names_b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links (node, root) that hold together what the pairs of linked do, at most one a node."""
    n = len(names_a)
    label = np.arange(n + len(names_b))
    i, j = np.nonzero(linked)
    j = j + n
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    names = np.concatenate([names_a, names_b])
    for k in np.flatnonzero(label != np.arange(len(label))):
        yield int(names[k]), int(names[label[k]])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each pair of blocks, whose sets come one after the other."""
    current, rows = None, []
    out: list[tuple[int, int]] = []

    def multiply():
        a, b = current
        first = [r for r in rows if r[0] == a]
        second = first if a == b else [r for r in rows if r[0] == b]
        sets = [[np.frombuffer(r[3], np.uint64) for r in side] for side in (first, second)]
        sizes = [np.array([r[2] for r in side], np.int64) for side in (first, second)]
        linked = overlaps(*sets, *sizes)
        if a == b:
            linked = np.triu(linked, 1)
        names = [np.array([r[1] for r in side], np.int64) for side in (first, second)]
        out.extend((x, y) for x, y in _forest(linked, *names) if x != y)

    for batch in batches:
        for a, b, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if rows and (a, b) != current:
                multiply()
                rows = []
            current = (a, b)
            rows.append(row)
    if rows:
        multiply()
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def links(sets: DataFrame) -> DataFrame:
    """(a, b): links between sets that join the same sets as all pairs do, found block by block.

    Only pairs of blocks that share a prefix n-gram and whose sizes allow a link are multiplied;
    a task holds two blocks at once."""
    spark = sets.sparkSession
    postings = sets.select("node", "n", F.explode("prefix").alias("gram"))
    common = postings.groupBy("gram").count().filter("count > 1").select("gram")
    postings = staged(postings.join(common, "gram"), "postings")
    blocks = staged(_blocks(sets, postings), "blocks")
    where = postings.select("gram", "node").join(blocks, "node").groupBy("gram", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    other = where.select("gram", *[F.col(c).alias(c + "_b") for c in ("block", "lo", "hi")])
    near = (100 * F.col("hi") >= PERCENT * F.col("lo_b")) & (100 * F.col("hi_b") >= PERCENT * F.col("lo"))
    pairs = where.join(other, "gram").filter((F.col("block") < F.col("block_b")) & near).select("block", "block_b").distinct()
    pairs = pairs.union(blocks.select("block", F.col("block").alias("block_b")).distinct())
    pairs = pairs.select(F.col("block").alias("a"), F.col("block_b").alias("b"))
    wanted = pairs.select("a", "b", F.col("a").alias("block")).union(pairs.filter("a != b").select("a", "b", F.col("b").alias("block")))
    members = blocks.join(sets.select("node", "grams"), "node")
    rows = wanted.join(members, "block").select("a", "b", "block", "node", "n", "grams")
    rows = rows.repartition(partitions(spark), "a", "b").sortWithinPartitions("a", "b", "block")
    return rows.mapInArrow(_products, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id for each row.

    Documents with 100 * intersection >= 80 * union of their sets of five-word shingles are linked,
    and component_id is the smallest id that links lead to. Equal sets are one node of the graph,
    and components are found on nodes before ids are looked at, so a text holds others together
    whatever the ids of its rows. Ids are of any type with an order.
    The incidence of nodes and n-grams is dealt out by n-gram, in packed rows; n-grams of one
    node only go, the rest come back by node with their counts, and nodes whose rarest n-grams
    (the prefix that a partner must touch) are theirs alone are done. What remains is multiplied
    in blocks, exactly. Hashes have 64 bits.

    Null text or no words: an empty set, a component of its own. Null id: takes the component of
    its text, links others as any row does, and is the smallest of none. Repeated rows get the same answer. Other columns are
    left out.
    """
    table = staged(set_ids(docs, key, text), "set-ids")
    first = table.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"))
    found = staged(links(candidates(docs, text)), "found")
    linked = staged(first.join(components(found), F.col("node") == F.col("id")).select("node", "first", "component"), "linked")
    least = linked.groupBy("component").agg(F.min("first").alias("_root"))
    roots = first.join(linked.join(least, "component").select("node", "_root"), "node", "left").select("node", F.coalesce("_root", "first").alias("_root"))
    return table.join(roots, "node", "left").select("doc_id", "n_shingles", F.coalesce("_root", "doc_id").alias("component_id"))
