"""MinHash near-duplicates against all pairs of sets."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_words import lower, roots, words
from turnstile.llm import minhash_bands as M
from turnstile.llm import queries

SCHEMA = "doc_id long, text string"


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    where, common = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for ids in where.values():
        for k, a in enumerate(ids):
            common.update((a, b) for b in ids[k + 1 :])
    found = roots(sets, [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)])
    return {i: (len(s), found[i], i == found[i]) for i, s in sets.items()}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_op12_against_all_pairs(spark, sf, documents):
    assert answer(queries.op12_minhash_bands(spark, sf)) == brute([(r.doc_id, r.text) for r in documents])


def changed(draw, base, most):
    w = list(base)
    for _ in range(draw.randrange(most + 1)):
        w[draw.randrange(len(w))] = f"x{draw.randrange(9)}"
    return w


@pytest.mark.parametrize("block", [8, 256])
def test_near_copies_around_the_bound(spark, monkeypatch, block):
    """A chain, a star and a crowd of near copies, and texts that share a passage, in blocks of few and of many."""
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "OVERLAP", block // 4)
    draw = random.Random(12)
    letters = [f"w{i}" for i in range(400)]
    crowd, hub = draw.choices(letters, k=120), draw.choices(letters, k=100)
    texts = [changed(draw, crowd, 6) for _ in range(90)]
    texts += [changed(draw, hub, 3) for _ in range(40)]
    chain = draw.choices(letters, k=300)
    texts += [chain[4 * i : 4 * i + 90] for i in range(40)]
    passage = draw.choices(letters, k=80)
    texts += [passage + draw.choices(letters, k=draw.randint(5, 60)) for _ in range(60)]
    texts += [draw.choices(letters, k=draw.randint(1, 5)) for _ in range(30)]
    draw.shuffle(texts)
    rows = [(i * 7 % 1000, " ".join(t)) for i, t in enumerate(texts)]
    assert answer(M.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_minima_and_signatures():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 1 << 63, n, np.uint64)) for n in (1, 5, M.AT_ONCE + 100, 3, 200)]
    least = M.minima(sets)
    for s, row in zip(sets, least, strict=True):
        for i in (0, 17, M.HASHES - 1):
            a, b = int(M._FACTORS[i]), int(M._TERMS[i])
            assert int(row[i]) == min((a * x + b) % 2**64 for x in map(int, s))
    base = np.unique(draw.integers(0, 1 << 63, 2000, np.uint64))
    for part in (0.5, 0.8, 0.95):  # of the union in common
        rest = np.unique(draw.integers(0, 1 << 63, 2000, np.uint64))
        both = int(len(base) * 2 * part / (1 + part))
        a, b = base, np.concatenate([base[:both], rest[: len(base) - both]])
        signs = M.signatures(M.minima([a, b]))
        assert abs((signs[0] == signs[1]).mean() - part) < 0.15
    keys = M.band_keys(least)
    assert keys.shape == (5, M.BANDS) and len(np.unique(keys)) == keys.size


def test_odd_rows(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, SCHEMA).withColumn("NODE", F.lit("clash")).withColumn("component", F.lit("clash"))
    out = M.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in out) == sorted(
        [("1", 1, "1", True), ("1", 1, "1", True), ("2", 0, "2", True), ("None", 1, "1", False), ("3", 0, "3", True), ("4", 0, "4", True), ("5", 1, "1", False), ("6", 1, "6", True), ("7", 1, "7", True), ("None", 0, "None", True)]
    )
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_links_through_rows_without_id(spark):
    """Two texts that only a row without id links, beside one that nothing links."""
    base = [f"w{i}" for i in range(110)]
    rows = [(1, " ".join(base[:90])), (None, " ".join(base[7:97])), (2, " ".join(base[14:104])), (None, "a b c d e"), (None, "a b c d e")]
    out = M.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == [("1", "1", True), ("2", "1", False), ("None", "1", False), ("None", "None", True), ("None", "None", True)]


def test_a_large_group_meets_in_few_pairs_of_blocks(spark, monkeypatch):
    """Once a crowd of near copies is one component, none of its blocks meet one another again."""
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "OVERLAP", 4)
    seen = []
    across = M._across
    monkeypatch.setattr(M, "_across", lambda *a: seen.append(across(*a)) or seen[-1])
    draw = random.Random(5)
    base = [f"w{draw.randrange(500)}" for _ in range(150)]
    rows = [(i, " ".join(changed(draw, base, 2))) for i in range(320)]
    out = M.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component_id for r in out} == {0}
    assert seen[0].select("a", "b").distinct().count() <= 20
