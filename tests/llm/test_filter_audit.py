"""The filter audit against applying every order of filters to every document."""

import random
from collections import Counter
from itertools import permutations

import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from tests_llm_words import words
from turnstile.llm import answers, filter_audit, queries

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality long, toxic long"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}  # a row without id has no label
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    failed = []
    for i, t, lang in docs:
        t = t or ""
        w = words(t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > smallest[t],
        }
        failed.append((i, lang or "", {k for k, v in fails.items() if v}))
    out = Counter({(lang, "".join(p), k, m): 0 for lang in {x[1] for x in failed} for p in permutations("ABCDE") for k in range(1, 6) for m in MEASURES})
    for i, lang, fails in failed:
        for p in permutations("ABCDE"):
            gone = False
            for k, letter in enumerate(p, 1):
                at = (lang, "".join(p), k)
                here = letter in fails and not gone
                out[(*at, "redundant")] += letter in fails and gone
                out[(*at, "unique_fails")] += fails == {letter}
                out[(*at, "removed")] += here
                out[(*at, "good_lost")] += here and i in good
                out[(*at, "toxic_lost")] += here and i in toxic
                gone = gone or here
                out[(*at, "kept")] += not gone
    for lang, p, k in {key[:3] for key in out}:
        out[lang, p, k, "shapley"] = sum(out[lang, q, j, "removed"] for q in map("".join, permutations("ABCDE")) for j in range(1, 6) if q[j - 1] == p[k - 1])
    return dict(out)


def answer(df):
    return {(r.part, r.filter_order, r.step, m): r[m] for r in df.collect() for m in MEASURES}


def test_op11_equals_sql(spark, sf):
    assert differences(spark, duck(sf), queries.op11_filter_audit, answers.AUDIT, sf)[0] is None


@pytest.mark.parametrize("a_task", [2, 4096])
def test_against_every_order(spark, monkeypatch, a_task):
    """Copies of one text in many tasks, texts around each bound, and labels of several rows."""
    monkeypatch.setattr(filter_audit, "COPIES_A_TASK", a_task)
    draw = random.Random(11)
    texts = [None, "", " ", "a b", "#", "A" * 3 + "b" * 97, "A" * 4 + "b" * 96, "é" * 96 + "A" * 3 + "é", " ".join(map(str, range(199))), " ".join(map(str, range(200))), "w " * 200, " ".join(f"w{i % 100}" for i in range(200)), " ".join(f"w{i % 99}" for i in range(200)), "x\x1fy|" * 300]
    rows = [(i, draw.choice(texts), draw.choice(["en", "de", "", None])) for i in draw.sample(range(1000), 150)]
    rows += [(2000 + i, "the same", "en") for i in range(40)] + [(1999, "the same", "de")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i, _, _ in rows if draw.random() < 0.6 for _ in range(draw.randint(1, 2))]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).withColumn("MASK", F.lit("clash")).withColumn("part", F.lit("clash"))
    labelled = spark.createDataFrame(labels, LABELS).withColumn("docs", F.lit(7))
    assert answer(filter_audit.audit(docs, labelled)) == brute(rows, labels)


def test_odd_rows(spark, odd_rows):
    rows = [(i, t, None) for i, t in odd_rows]
    labels = [(1, 1, 0), (None, 1, 1)]
    out = answer(filter_audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)))
    assert out == brute(rows, labels) and out["", "EABCD", 1, "removed"] == 1  # of 2 (null) and 3 (empty) the later one
    empty = spark.createDataFrame([], DOCS)
    assert filter_audit.audit(empty, spark.createDataFrame([], LABELS)).collect() == []
    assert filter_audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)).count() == 600
