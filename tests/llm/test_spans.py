"""Decontamination and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tests_llm_words import lower, words
from turnstile.llm import queries, substring
from turnstile.llm.decontaminate import contamination

SCHEMA = "doc_id long, text string"
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = FOLDED.findall(lower(text))
        for s in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[s : s + size])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = FOLDED.findall(lower(text))
        hit, found = set(), set()
        for length in {len(k) for k in windows}:
            for s in range(len(w) - length + 1):
                owners = windows.get(tuple(w[s : s + length]))
                if owners:
                    hit.update(range(s, s + length))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def test_op5_against_brute_force(spark, sf, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = rows_of(queries.op5_decontaminate(spark, sf))
    assert got == contaminated([(r.doc_id, r.text) for r in documents], items)
    assert any(r[-1] for r in got)


def test_short_items_and_blocks(spark, odd_rows):
    docs = [*odd_rows, (20, "The quick, BROWN fox jumps over: the lazy dog and then some more"), (21, "x yes y Yes"), (22, "de la ñandú é")]
    items = [(1, "yes"), (2, "quick brown fox jumps over the lazy dog and then some"), (3, None), (None, "ñandú"), (4, ""), (5, "a b"), (6, "w w w"), (7, "yes")]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("N_Hit", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (100, 2):
        assert rows_of(contamination(df, bench, block_windows=block)) == contaminated(docs, items)
    assert not any(r.contaminated for r in contamination(df, bench.limit(0)).collect())
    assert contamination(df.limit(0), bench).collect() == []


def without_repeats(rows):
    first, out = {}, []
    split = [(i, words(t)) for i, t in rows]
    for i, w in sorted((r for r in split if r[0] is not None), key=lambda r: r[0]):
        for s in range(len(w) - 49):
            first.setdefault(tuple(w[s : s + 50]), i)
    for i, w in split:
        gone = set()
        if i is not None:
            for s in range(len(w) - 49):
                if first[tuple(w[s : s + 50])] < i:
                    gone.update(range(s, s + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def removed(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_op7_against_brute_force(spark, sf, documents):
    got = removed(queries.op7_substring_dedup(spark, sf))
    assert got == without_repeats([(r.doc_id, r.text) for r in documents])
    assert any(r[2] for r in got)


def test_shifted_passages_in_small_shards(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", 900)
    monkeypatch.setattr(substring, "SEGMENT", 64)
    draw = random.Random(3)
    base = [draw.choice("abcdefgh") + str(draw.randrange(30)) for _ in range(400)]
    rows = list(odd_rows) + [(900, "w " * 70)]
    for i in range(80):
        a = draw.randrange(300)
        w = [str(draw.randrange(9)) for _ in range(draw.randrange(40))] + base[a : a + draw.randrange(30, 200)] + [f"x{draw.randrange(3)}"] * draw.randrange(80) + base[a + 20 : a + 75]
        if draw.random() < 0.3:
            w[draw.randrange(len(w))] = "edit"
        rows.append((10 + i * 3, " ".join(w)))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("spans", F.lit(0))
    assert removed(substring.without_repeats(df)) == without_repeats(rows)
    assert substring.without_repeats(df.limit(0)).collect() == []
