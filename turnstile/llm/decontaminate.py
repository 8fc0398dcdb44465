"""Benchmark decontamination: a prefix-filtered containment join of item windows and documents."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.columns import in_bytes, with_arrow_columns, without
from turnstile.llm.staging import staged

#: Bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] stay, A-Z become a-z, the rest separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def folded_words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def item_windows(items: DataFrame, size: int, text: str, key: str, blocks: int = 1) -> DataFrame:
    """(item, window, block): each run of size consecutive words of an item, or all its words if
    it has fewer; window holds the words with blanks between."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), in_bytes(batch.column(1))
            out: list[tuple[str, str]] = []
            for item, value in zip(ids, texts, strict=True):
                words = folded_words(value)
                for s in range(max(1, len(words) - size + 1) if words else 0):
                    out.append((item, b" ".join(words[s : s + size]).decode("utf-8", "surrogateescape")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string())], names=["item", "window"]
            )

    source = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "item string, window string").distinct()


def _word_counts(docs: DataFrame, text: str, words: frozenset[bytes]) -> dict[bytes, int]:
    """Number of documents that hold each of the given words; at most one row a word comes back."""

    def run(batches):
        found: Counter[bytes] = Counter()
        for batch in batches:
            for value in in_bytes(batch.column(0)):
                found.update(words.intersection(folded_words(value)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found.keys()), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
        )

    counted = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "word binary, n bigint")
    return {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _prefix_table(rows: list, docs: DataFrame, text: str) -> dict:
    """Rarest word of each window -> (place of the word, the window's words, its items).

    A window counts only if all its words are there, so the necessary prefix of its words in
    order of rarity is the first one."""
    windows: dict[bytes, list[str]] = defaultdict(list)
    for r in rows:
        windows[r["window"].encode("utf-8", "surrogateescape")].append(r["item"])
    split = {w: w.split() for w in windows}
    seen = _word_counts(docs, text, frozenset(x for ws in split.values() for x in ws))
    table: dict[bytes, list] = defaultdict(list)
    for w, ws in split.items():
        at = min(range(len(ws)), key=lambda i: (seen.get(ws[i], 0), ws[i], i))
        if ws[at] in seen:  # else no document has it
            table[ws[at]].append((at, ws, windows[w]))
    return dict(table)


def contained_windows(
    docs: DataFrame, items: DataFrame, size: int = 10, text: str = "text", item_text: str = "text", item_key: str = "item_id", block_windows: int = 100_000
) -> DataFrame:
    """docs plus n_words, hit_spans (start, end, start, end, ... of words covered by any occurrence
    of an item's window) and items (those with windows that occur, sorted).

    Windows go out in blocks of at most block_windows, each small enough to broadcast; each block
    is held against all documents. In a block every window is filed under its rarest word by
    document counts over the whole corpus. A document's words are looked up there; where one is
    found, the window would have to start so many words earlier (inside the document), and its
    words are compared one by one.

    Null or empty text: no words. Items without words have no window; a null id counts as an empty
    one. Repeated items share windows. Empty tables give no hits. Input columns with the name of
    a result are replaced; all others are carried along.
    """
    spark = docs.sparkSession
    windows = staged(item_windows(items, size, item_text, item_key), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    block = F.pmod(F.xxhash64("window"), F.lit(blocks))
    out = docs
    for b in range(blocks):
        table = spark.sparkContext.broadcast(_prefix_table(windows.filter(block == b).collect(), docs, text))
        first = b == 0

        def start(table=table, first=first):
            filed = table.value
            prefixes = filed.keys()

            def work(texts, spans=None, found=None):
                counts, all_spans, all_items = [], [], []
                for i, value in enumerate(in_bytes(texts)):
                    words = folded_words(value)
                    n = len(words)
                    mask, items = bytearray(n), set()
                    if not first:
                        old = spans[i].as_py()
                        for s, e in zip(old[::2], old[1::2], strict=True):
                            mask[s:e] = b"\1" * (e - s)
                        items.update(found[i].as_py())
                    if not prefixes.isdisjoint(words):
                        for p, word in enumerate(words):
                            for at, window, owners in filed.get(word, ()):
                                s = p - at
                                e = s + len(window)
                                if s >= 0 and e <= n and words[s:e] == window:
                                    mask[s:e] = b"\1" * (e - s)
                                    items.update(owners)
                    edges, inside = [], 0
                    if items:
                        for p, m in enumerate(mask):
                            if m != inside:
                                edges.append(p)
                                inside = m
                        if inside:
                            edges.append(n)
                    counts.append(n)
                    all_spans.append(edges)
                    all_items.append(sorted(items))
                return [pa.array(counts, pa.int64()), pa.array(all_spans, pa.list_(pa.int32())), pa.array(all_items, pa.list_(pa.string()))]

            return work

        inputs = [text] if first else [text, "hit_spans", "items"]
        out = with_arrow_columns(out, inputs, FIELDS, start)
        if b + 1 < blocks:
            out = staged(out, "block")  # so that one task holds one block
    return out


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """contained_windows() plus n_hit, n_items, items_sha256 (of the sorted ids, comma between) and
    contaminated."""
    new = ["n_hit", "n_items", "items_sha256", "contaminated"]
    found = contained_windows(docs.select(*[F.col(f"`{c}`") for c in without(docs, new)]), items, **options)
    spans = F.col("hit_spans")
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: x - a)  # end - (start - (end - ...))
    ids = F.array_join("items", ",")
    return found.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(ids.cast("binary"), 256)}).withColumn(
        "contaminated", F.col("n_hit") > 0
    )
