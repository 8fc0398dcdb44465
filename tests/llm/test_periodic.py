"""Periodic runs against comparing every word with the one each period on."""

import hashlib
import random
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests_llm_words import words
from turnstile.llm import periodic, queries

SCHEMA = "doc_id long, text string"


def brute(w, least=0):
    """(start, length, period) of all runs of at least so many words."""
    out, w = {}, np.array([hash(x) for x in w])
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[0], w[:-q] == w[q:], [0]]).astype(np.int8)
        turns = np.diff(same)
        for s, e in zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist(), strict=True):
            if e - s >= q:
                out.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in out.items() if n >= least)


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(i, w):
    h = zlib.crc32(str(i).encode())
    if i is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(i, text):
    w = planted(i, words(text))
    found = brute(w, 12)
    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (i, len(found), s, n, q, 1000 * n // q if found else None, sha("".join("%d,%d,%d\n" % r for r in found)), sha(collapsed(w, found)))


def test_op13_against_all_periods(spark, sf, documents):
    rows = [(r.doc_id, r.text) for r in documents]
    assert sorted(map(tuple, queries.op13_periodic_runs(spark, sf).collect())) == sorted(expected(*r) for r in rows)


def test_op13_on_odd_rows(spark, odd_rows, tmp_path):
    rows = [*odd_rows, (37, "a b c d e f g h i j k l m n o p q r s t u v"), (40, " "), (48, None)]  # ids that take a period
    assert all(zlib.crc32(str(i).encode()) % 10 == 0 for i in (37, 40, 48))
    spark.createDataFrame(rows, SCHEMA).withColumn("runs", F.lit("clash")).withColumn("_H", F.lit("clash")).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    small = [r for r in rows if len(r[1] or "") < 1000]
    assert sorted(map(str, (tuple(r) for r in got if r.doc_id != 6))) == sorted(str(expected(*r)) for r in small)
    assert [tuple(r)[1:6] for r in got if r.doc_id == 6] == [(1, 0, 30_000, 1, 30_000_000)]
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert queries.op13_periodic_runs(spark, str(tmp_path)).collect() == []


def drawn(draw, n):
    """Few letters, whole periods, Fibonacci words, repeats in repeats, and rows of one word among others."""
    kind, out = draw.randrange(5), []
    if kind == 0:
        return [draw.randrange(draw.randint(2, 4)) for _ in range(n)]
    if kind == 1:
        block = [draw.randrange(50) for _ in range(draw.randint(1, 60))]
        return [block[i % len(block)] for i in range(n)]
    if kind == 2:
        out, more = [0], [0, 1]
        while len(more) < n:
            out, more = more, more + out
        return more[:n]
    while len(out) < n:
        block = [draw.randrange(4) for _ in range(draw.randint(1, 30))] if kind == 3 else [draw.randrange(3)] * draw.randint(1, 20) + [draw.randrange(5)]
        out += block * draw.randint(1, 5)
        if draw.random() < 0.3:
            out += out[-draw.randint(1, min(len(out), 80)) :]
    return out[:n]


def test_runs_of_all_kinds():
    draw = random.Random(13)
    for _ in range(600):
        w = drawn(draw, draw.randint(0, 300))
        got = periodic.runs(np.array([xxhash.xxh3_64_intdigest(b"%d" % x) for x in w], np.uint64))
        assert list(zip(*(c.tolist() for c in got), strict=True)) == brute(w), w


def test_synchronising_set_sees_its_context_only():
    """Chosen places depend on 2 * scale words, and any scale places in a row hold one where no short period reigns."""
    draw = np.random.default_rng(3)
    scale = 8
    for letters in (2, 3, 100):
        w = draw.integers(0, letters, 3000)
        text = periodic._names(np.array([xxhash.xxh3_64_intdigest(b"%d" % x) for x in w], np.uint64))
        windows = [tuple(w[i : i + scale]) for i in range(len(w) - scale + 1)]
        reigns = np.array([any(x[:-p] == x[p:] for p in range(1, scale // 3 + 1)) for x in windows])
        places = periodic.synchronising(text[3], scale, reigns)
        chosen = set(places.tolist())
        by_context = {}
        for i in range(len(w) - 2 * scale + 1):
            assert by_context.setdefault(tuple(w[i : i + 2 * scale]), i in chosen) == (i in chosen)
        assert len(places) < len(w) * 4 / scale
        for i in range(0, len(w) - 3 * scale):
            region = tuple(w[i : i + 3 * scale - 1])
            if not any(region[:-p] == region[p:] for p in range(1, scale // 3 + 1)):
                assert chosen & set(range(i, i + scale))


def test_texts_in_groups(spark, monkeypatch):
    """Runs stop where a text ends, whatever texts are handled together."""
    rows = [(i, t) for i, t in enumerate([*["x y " * 10] * 30, "", "z " * 3000, *["x y " * 5] * 30])]
    df = spark.createDataFrame(rows, SCHEMA)
    for at_once in (1, 50, 200_000):
        monkeypatch.setattr(periodic, "AT_ONCE", at_once)
        out = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.with_runs(df).collect()}
        assert out == {i: brute(words(t), 12) if i != 31 else [(0, 3000, 1)] for i, t in rows}
