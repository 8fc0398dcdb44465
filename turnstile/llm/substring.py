"""Substring deduplication by suffix automata of reference shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.columns import in_bytes, with_arrow_columns, without
from turnstile.llm.staging import partitions, staged

WINDOW = 50  # words that must match
GRAM = 8  # words of an anchor
SHARD_WORDS = 40_000  # words in one automaton
SEGMENT = 1 << 22  # windows of a text looked at together
FILTER_BITS = 26  # size of the filter of wanted pieces, as a power of two

_FACTORS = np.array([pow(0xD1342543DE82EF95, 2 * k + 1, 1 << 64) for k in range(GRAM)], np.uint64)
_BASE = 0x2545F4914F6CDD1D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _FACTORS[1]
    return x ^ (x >> np.uint64(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of width values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def pieces(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, piece, start, windows): the windows of a text in runs that share an anchor.

    A window's anchor is the group of GRAM words in it with the smallest hash, so equal windows have
    equal anchors wherever they stand. A run of windows around one anchor is a piece; its number
    is a hash of its words, start its first word."""
    n = len(words)
    if n < WINDOW:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    gram = np.zeros(n - GRAM + 1, np.uint64)
    for k in range(GRAM):
        gram += h[k : n - GRAM + 1 + k] * _FACTORS[k]
    gram = _mixed(gram)
    out = []
    low = np.uint64((1 << 24) - 1)
    for at in range(0, n - WINDOW + 1, SEGMENT):
        end = min(at + SEGMENT, n - WINDOW + 1)  # windows at .. end
        part = gram[at : end + WINDOW - GRAM]
        key = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        least = (_sliding_min(key, WINDOW - GRAM + 1) & low).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
        out.append((part[least[first]], first + at, np.diff(np.append(first, len(least)))))
    anchor, start, windows = (np.concatenate(c) for c in zip(*out, strict=True))
    # words of a piece as a polynomial, shifted to its start
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(_BASE, n))])
    content = (prefix[start + windows + WINDOW - 1] - prefix[start]) * _powers(_BASE_INVERSE, n)[start]
    return anchor.view(np.int64), _mixed(content + windows.astype(np.uint64)).view(np.int64), start, windows


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def _all_pieces(docs: DataFrame) -> DataFrame:
    """(doc_id, anchor, piece, start, windows) of all texts."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                found = [pieces(_words(v)) for v in in_bytes(part.column(1))]
                counts = [len(f[0]) for f in found]
                owner = pa.array(np.repeat(np.arange(len(found)), counts))
                columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([part.column(0).take(owner), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["doc_id", "anchor", "piece", "start", "windows"])

    return docs.mapInArrow(run, "doc_id bigint, anchor bigint, piece bigint, start int, windows int")


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, piece, doc_id, words) of the wanted pieces of documents, and of a few others.

    A filter of fixed size, one bit for each hash of a wanted (document, anchor, piece), goes to all
    tasks; what passes it by chance does no harm."""
    spark = docs.sparkSession
    mask = (1 << FILTER_BITS) - 1
    folded = F.col("anchor").bitwiseXOR(F.shiftright("piece", 7))
    bit = F.col("doc_id").bitwiseXOR(folded).bitwiseAND(F.lit(mask))
    held = wanted.select(bit.alias("bit")).select(F.shiftright("bit", 5).alias("at"), F.expr("shiftleft(1L, cast(bit & 31 as int))").alias("b"))
    rows = held.groupBy("at").agg(F.bit_or("b").alias("b")).toPandas()  # at most 2 ** (FILTER_BITS - 5)
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    bits[rows["at"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).astype(np.uint32)
    sent = spark.sparkContext.broadcast(bits)

    def run(batches):
        filled = sent.value
        for batch in batches:
            out = []
            for doc, value in zip(batch.column(0).to_pylist(), in_bytes(batch.column(1)), strict=True):
                words = _words(value)
                anchor, piece, start, windows = pieces(words)
                if len(anchor):
                    place = (np.int64(doc) ^ anchor ^ (piece >> 7)) & mask
                    for k in np.flatnonzero((filled[place >> 5] >> (place & 31).astype(np.uint32)) & np.uint32(1)).tolist():
                        s = int(start[k])
                        out.append((int(anchor[k]), int(piece[k]), doc, b" ".join(words[s : s + int(windows[k]) + WINDOW - 1])))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "piece", "doc_id", "words"])

    return docs.mapInArrow(run, "anchor bigint, piece bigint, doc_id bigint, words binary")


class SuffixAutomaton:
    """All substrings of the texts added, which come by rising document; each state knows the first
    document that any of its strings ends in."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [None]

    def add(self, words: list[bytes], doc: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for w in words:
            known = nxt[last].get(w)
            if known is not None and length[known] == length[last] + 1:
                last = known
                continue
            if known is None:
                new = len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                first.append(doc)
            p = last
            if known is None:
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = new
                    p = link[p]
                if p < 0:
                    last = new
                    continue
            q = nxt[p][w]
            if length[q] == length[p] + 1:
                target = q
            else:
                target = len(nxt)
                nxt.append(nxt[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                first.append(first[q])
                link[q] = target
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = target
                    p = link[p]
            if known is None:
                link[new] = target
                last = new
            else:
                last = target

    def firsts(self, words: list[bytes]) -> list:
        """Matching statistics at the threshold: for each window of words the first document that has it, or
        None."""
        nxt, link, length = self.next, self.link, self.length
        v = l = 0  # noqa: E741
        out = []
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                l = length[v]  # noqa: E741
            if w in nxt[v]:
                v = nxt[v][w]
                l += 1  # noqa: E741
            while v and length[link[v]] >= WINDOW:
                v = link[v]
                l = length[v]  # noqa: E741
            if i >= WINDOW - 1:
                out.append(self.first[v] if l >= WINDOW else None)
        return out


def shard_firsts(group: list[tuple[int, int, int, bytes]]) -> Iterator[tuple[int, int, list[int]]]:
    """(anchor, piece, first document of each window) for pieces (anchor, piece, document, words) that hold all
    that may match each other.

    The pieces make reference shards by rising document, each of about SHARD_WORDS words, and one
    automaton at a time is built. The first shard that has a window has its first document, so a
    piece goes past a shard only for windows not found before."""
    group = sorted(group, key=lambda g: (g[2], g[0], g[1]))
    found: list[list | None] = [None] * len(group)
    begin = 0
    while begin < len(group):
        automaton, end, size = SuffixAutomaton(), begin, 0
        while end < len(group) and (size < SHARD_WORDS or end == begin):
            words = group[end][3].split()
            automaton.add(words, group[end][2])
            size += len(words)
            end += 1
        for k in range(begin, len(group)):
            if found[k] is None or None in found[k]:
                firsts = automaton.firsts(group[k][3].split())
                found[k] = firsts if found[k] is None else [a if a is not None else b for a, b in zip(found[k], firsts, strict=True)]
        for k in range(begin, end):
            yield group[k][0], group[k][1], found[k]
            found[k] = []
        begin = end


_RUNS = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "piece", "from", "many", "first")])


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows with the same first document, for pieces that come anchor by anchor."""
    group: list[tuple] = []
    size = 0

    def rows():
        out = []
        for anchor, piece, firsts in shard_firsts(group):
            start = 0
            for i in range(1, len(firsts) + 1):
                if i == len(firsts) or firsts[i] != firsts[start]:
                    out.append((anchor, piece, start, i - start, firsts[start]))
                    start = i
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=_RUNS.names)

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if size >= SHARD_WORDS and row[0] != group[-1][0]:
                yield rows()
                group, size = [], 0
            group.append(row)
            size += row[3].count(b" ") + 1
    if group:
        yield rows()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): for documents (doc_id, text) the words that windows also in a document with a smaller
    id cover, as [start, end) pairs that may overlap.

    Pieces by anchor, combined before they move: most anchors are in one document and done. Where
    all documents have the same words around an anchor, the smallest has them first. Where they
    differ, one copy of each piece is fetched and the anchor's shard, an automaton over these,
    tells each window's first document; windows with different anchors can't match, so anchors
    are dealt out to tasks rather than the automata broadcast to all."""
    spark = docs.sparkSession
    known = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    placed = staged(_all_pieces(known), "pieces")
    kinds = placed.groupBy("anchor", "piece").agg(F.min(F.struct("doc_id", "windows")).alias("f"), F.max("doc_id").alias("last"))
    kinds = staged(kinds.select("anchor", "piece", F.col("f.doc_id").alias("first"), F.col("f.windows").cast("long").alias("windows"), "last"), "kinds")
    anchors = kinds.groupBy("anchor").agg(F.min("first").alias("_lo"), F.max("last").alias("_hi"), F.count("*").alias("many"))
    shared = staged(kinds.join(anchors.filter("_lo < _hi").select("anchor", "many"), "anchor"), "shared")
    alone = shared.filter("many = 1").select("anchor", "piece", F.lit(0).cast("long").alias("from"), F.col("windows").alias("many"), "first")
    mixed = shared.filter("many > 1").select("anchor", "piece", F.col("first").alias("doc_id"))
    copies = _fetch(known, mixed).join(mixed, ["anchor", "piece", "doc_id"], "left_semi").dropDuplicates(["anchor", "piece"])
    dealt = copies.select("anchor", "piece", "doc_id", "words").repartition(partitions(spark), "anchor").sortWithinPartitions("anchor")
    runs = staged(alone.unionByName(dealt.mapInArrow(_resolved, _RUNS)), "runs")
    hits = placed.join(runs, ["anchor", "piece"]).filter(F.col("first") < F.col("doc_id"))
    start = F.col("start") + F.col("from")
    spans = hits.select("doc_id", F.struct(start.cast("int").alias("s"), (start + F.col("many") + WINDOW - 1).cast("int").alias("e")).alias("span"))
    return spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans"))


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """df plus kept_text, n_words, n_removed and kept_sha256.

    Words are what blanks and control characters 9 to 13 separate. A word goes if a window of 50
    words covers it whose words also stand in a row in a document with a smaller id, as the texts
    came in; the others are joined by blanks.

    Null text: no words. Null id: keeps all and is no reference. Rows of one id should have one
    text; where they differ, each loses the places that any of them would. Input columns with the
    name of a result are replaced, all others are carried along.
    """
    new = ["kept_text", "n_words", "n_removed", "kept_sha256"]
    base = df.select(*[F.col(f"`{c}`") for c in without(df, [*new, "spans"])])
    spans = repeated_spans(base.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    joined = base.join(spans.withColumnRenamed("doc_id", "_spans_of"), F.col(key) == F.col("_spans_of"), "left").drop("_spans_of")

    def start():
        def work(texts, spans):
            out = []
            for value, places in zip(in_bytes(texts), spans.to_pylist(), strict=True):
                words = _words(value)
                kept = words
                if places:
                    keep = bytearray(b"\1") * len(words)
                    for p in places:
                        s, e = p["s"], min(p["e"], len(words))
                        keep[s:e] = bytes(max(0, e - s))
                    kept = [w for w, k in zip(words, keep, strict=True) if k]
                whole = b" ".join(kept)
                out.append((whole.decode(), len(words), len(words) - len(kept), hashlib.sha256(whole).hexdigest()))
            return [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]

        return work

    fields = [T.StructField(n, k) for n, k in zip(new, (T.StringType(), T.LongType(), T.LongType(), T.StringType()), strict=True)]
    return with_arrow_columns(joined, [text, "spans"], fields, start, keep=base.columns)
