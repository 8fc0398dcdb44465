import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests_llm_words import words
from turnstile.llm import queries, totals
from turnstile.llm.mix import RAMPS, mixed, place_in_time, range_sorted
from turnstile.llm.shard import hilbert_index, hilbert_shards


def test_hilbert_curve_visits_neighbours(spark):
    grid = spark.range(8**3).select(*[(F.floor(F.col("id") / 8**i) % 8).cast("int").alias(c) for i, c in enumerate("abc")])
    rows = sorted((r.h, (r.a, r.b, r.c)) for r in grid.withColumn("h", hilbert_index([F.col(c) for c in "abc"], 3)).collect())
    assert [h for h, _ in rows] == list(range(512))
    assert all(sum(abs(p - q) for p, q in zip(x, y)) == 1 for (_, x), (_, y) in zip(rows, rows[1:]))


def test_op1_covers_all_documents(spark, sf, documents):
    text = {r.doc_id: r.text.encode() for r in documents}
    out = queries.op1_hilbert_shards(spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(text)
    counts = Counter(r.shard for r in out)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    assert all(r["size"] == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id]) and r.law == "rows" for r in out)
    in_order = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in in_order] == sorted(r.hilbert for r in out)


def test_shards_by_bytes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = hilbert_shards(docs, 4, law="bytes", keep=["doc_id"]).collect()
    sizes, longest = Counter(), max(r["size"] for r in out)
    for r in out:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * longest
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


def test_shards_of_odd_rows(spark, odd_rows):
    rows = [(i, t, None if k % 2 else "en", None, None) for k, (i, t) in enumerate(odd_rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema).withColumn("Size", F.lit("clash"))
    out = hilbert_shards(df, 3).collect()
    assert len(out) == len(rows) and all(isinstance(r["size"], int) for r in out)
    assert hilbert_shards(spark.createDataFrame([], schema), 3).collect() == []


@pytest.mark.parametrize("ramp", [*RAMPS, (0.0, 2.0), (3.0, 0.0), (1.0,) * 2])
def test_place_in_time_inverts_the_integral(spark, ramp):
    steps = len(ramp) - 1

    def spent(t):
        area = lambda a, b, x: a * x + (b - a) * x * x / 2
        return sum(area(ramp[k], ramp[k + 1], min(max(t * steps - k, 0), 1)) for k in range(steps))

    done = [i / 20 for i in range(21)]
    got = spark.createDataFrame([(d,) for d in done], "d double").select(place_in_time(F.col("d"), ramp).alias("t")).collect()
    for d, r in zip(done, got):
        assert spent(r.t) / spent(1) == pytest.approx(d, abs=1e-9)


def water_filled(sizes, weights, total):
    """Targets by sharing again and again."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        level = (total - sum(target[s] for s in sizes if s not in open_)) / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else level * weights[s]
        open_ -= over or open_
    return target


def test_op3_meets_its_targets(spark, sf, documents):
    out = {r.doc_id: r for r in queries.op3_curriculum_mix(spark, sf).collect()}
    by = defaultdict(list)
    for r in documents:
        assert out[r.doc_id]["size"] == len(words(r.text))
        by[r.source].append(out[r.doc_id])
    sizes = {s: sum(r["size"] for r in rows) for s, rows in by.items()}
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(by))}
    want = water_filled(sizes, weights, 1.5 * sum(sizes.values()))
    for s, rows in by.items():
        assert {r.source_size for r in rows} == {sizes[s]}
        assert rows[0].target == pytest.approx(want[s]) and sum(r.taken for r in rows) == int(rows[0].target)
        assert all(r.taken <= 2 * r["size"] for r in rows)
    again = {r.doc_id: r for r in queries.op3_curriculum_mix(spark, sf).collect()}
    assert again == out


def test_mix_of_odd_rows(spark, odd_rows):
    rows = [(i, t, ("s", None)[k % 2]) for k, (i, t) in enumerate(odd_rows)]
    schema = "doc_id long, text string, source string"
    df = spark.createDataFrame(rows, schema).withColumn("TARGET", F.lit(1))
    out = mixed(df).collect()
    assert len(out) == len(rows) and sum(r.taken for r in out) <= 1.5 * sum(r["size"] for r in out)
    whole = mixed(df, whole=True)
    order = [r.position for r in range_sorted(whole).collect()]
    assert order == sorted(order) and len(order) == sum(r.copies for r in whole.collect())
    assert mixed(spark.createDataFrame([], schema)).collect() == []


def moves_of_text(df):
    """Exchanges in df's plan whose rows hold the text."""
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return sum("text#" in columns for columns in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan))


def test_texts_move_and_are_staged_as_seldom_as_can_be(spark, sf, monkeypatch):
    """Each copy of the texts is disk: shards need one move and the written ranges, the mix one move and its sort."""
    docs, written, staged = spark.read.parquet(f"{sf}/documents.parquet"), [], totals.staged
    monkeypatch.setattr(totals, "staged", lambda df, label: written.append("text" in df.columns and moves_of_text(df)) or staged(df, label))
    out = hilbert_shards(docs, 8)
    assert (sum(written), moves_of_text(out)) == (1, 0)
    written.clear()
    mix = mixed(docs, whole=True)
    assert not any(written) and (moves_of_text(mix), moves_of_text(range_sorted(mix))) == (1, 2)


def test_ranks_of_ties_and_nulls(spark):
    rows = [(None if i % 7 == 0 else i % 5, i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(6)
    out = sorted((r.rank, r.a, r.b) for r in totals.with_rank(df, ["a", "b"], "rank").collect())
    assert out == [(k, a, b) for k, (a, b) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))]
    assert sorted(r.rank for r in totals.with_rank(df, ["a"], "rank").collect()) == list(range(200))
