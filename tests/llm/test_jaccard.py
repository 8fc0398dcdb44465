import random
from collections import Counter, defaultdict

import numpy as np

from tests_llm_words import roots, shingles
from turnstile.llm import jaccard, queries
from turnstile.llm.components import components

SCHEMA = "doc_id long, text string"


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    where, common = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for ids in where.values():
        for k, a in enumerate(ids):
            common.update((a, b) for b in ids[k + 1 :])
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    found = roots(sets, links)
    return {i: (len(s), found[i]) for i, s in sets.items()}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_op4_against_all_pairs(spark, sf, documents):
    assert answer(queries.op4_ngram_jaccard(spark, sf)) == brute([(r.doc_id, r.text) for r in documents])


def test_near_copies_around_the_bound(spark, monkeypatch):
    """Copies of one text with more and more words changed; small blocks, so that many pairs of blocks meet."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "FLUSH", 500)
    draw = random.Random(4)
    base = [f"w{draw.randrange(60)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base if i % 3 else base[: 60 + i % 50])
        for _ in range(draw.randrange(6)):
            w[draw.randrange(len(w))] = f"x{draw.randrange(9)}"
        rows.append((i * 7 % 1000, " ".join(w)))
    assert answer(jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_overlaps_in_slices(monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE", 7)
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 60, draw.integers(1, 60))).astype(np.uint64) for _ in range(40)]
    n = np.array([len(s) for s in sets])
    got = jaccard.overlaps(sets, sets, n, n)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (100 * both >= 80 * (len(a) + len(b) - both))


def test_components_of_chains_and_hubs(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 160)] + [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)]
    want = roots({i for p in links for i in p}, links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: c for i, c in want.items() if i in got} and all(want[i] == i and sum(c == i for c in want.values()) == 1 for i in want if i not in got)


def test_odd_rows(spark, odd_rows):
    out = jaccard.near_duplicates(spark.createDataFrame(odd_rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in out) == sorted(
        [("1", "1"), ("1", "1"), ("2", "2"), ("None", "1"), ("3", "3"), ("4", "4"), ("5", "1"), ("6", "6"), ("7", "7"), ("None", "None")]
    )
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_links_through_rows_without_id(spark):
    """Documents that only a row without id, or a chain of such rows, links; and pairs beside such rows."""
    draw = random.Random(6)
    rows, want = [], {}
    for g in range(40):
        base = [f"g{g}w{i}" for i in range(104)]
        first, last = 4 * g + 1, 4 * g + 2
        at = [draw.randrange(8) + k * 20 for k in range(5)]
        if g % 2:  # first - null - null - last, windows of 90 words: 82 of 90 shingles in common, then 78 and fewer
            parts = [(first, base[:90]), (None, base[5:95]), (None, base[10:100]), (last, base[14:104])]
        else:  # all linked to all
            parts = [(first, base[: 90 + at[0]]), (None, base[1 : 91 + at[0]]), (last, base[: 92 + at[0]])]
        draw.shuffle(parts)
        rows += [(i, " ".join(w)) for i, w in parts]
        want |= {first: first, last: first}
    draw.shuffle(rows)
    out = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == want
    assert Counter(r.component_id for r in out) == Counter({4 * g + 1: 4 if g % 2 else 3 for g in range(40)})
