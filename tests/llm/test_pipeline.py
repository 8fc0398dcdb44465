"""The pipeline's stages, each against plain Python on its own input."""

import random
from collections import Counter

import corpus_pipeline as pipeline
from test_jaccard import brute
from test_spans import contaminated
from turnstile.llm.mix import mixed
from turnstile.llm.staging import release, staged


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns = docs.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        docs = staged(stage(spark, docs, sf))
        seen[name] = (before, docs.collect())
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = lambda rows: Counter(r.doc_id for r in rows)

    before, after = seen["language id"]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}  # all are in one of the languages

    before, after = seen["near copies"]
    groups = brute([(r.doc_id, r.text) for r in before])
    assert ids(after) == Counter({c for _, c in groups.values()}) and len(after) < len(before)

    before, after = seen["benchmark free"]
    clean = {r[0] for r in contaminated([(r.doc_id, r.text) for r in before], items) if not r[-1]}
    assert ids(after) == Counter(clean) and len(after) < len(before)

    before, after = seen["mix sources"]
    frame = spark.createDataFrame(before)
    assert ids(after) == Counter({r.doc_id: r.copies for r in mixed(frame, whole=True).collect() if r.copies})

    before, after = seen["shard"]
    assert ids(before) == ids(after) and len({r.shard for r in after}) == 8


def test_run_and_odd_tables(spark, sf, tmp_path):
    rows = [(1, "abc abc", None, None, None), (2, None, None, None, 0), (3, "", "en", "s", 0), (4, "the cat sat", "en", "s", 11), (4, "the cat sat", "en", "s", 11), (None, "un chat", "fr", None, 7), (5, "!!", "en", "s", 2)]
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {1, 4, None}
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []
    release(spark)


def test_language_stage_drops_other_languages_and_letter_junk(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    draw = random.Random(3)

    def words(letters):
        return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 10))) for _ in range(200))

    scripts = ["".join(map(chr, range(a, b))) for a, b in ((0x430, 0x450), (0x3B1, 0x3CA), (0x4E00, 0x5200), (0x61, 0x7B), (0x61, 0x67))]
    odd = [words(s) for s in scripts for _ in range(20)]
    odd.append("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.")
    odd.append("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.")
    odd.append("aaaa " * 200)
    clean = ["All human beings are born free and equal in dignity and rights.", "the cat sat"]
    rows = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate([*odd, *clean])]
    kept = pipeline.language_id(spark, docs.union(spark.createDataFrame(rows, docs.schema)), sf).filter("doc_id < 0").collect()
    assert sorted(r.text for r in kept) == sorted(clean)


def test_near_copies_keeps_rows_without_id_and_texts_of_one_id(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    texts = {n: " ".join(f"{n}{i}" for i in range(90)) for n in "abcd"}
    near = texts["b"].replace("b89", "x")
    rows = [
        (None, texts["a"], "en", None, 1),  # without id, unique: stays
        (None, texts["b"], "en", "s", 1),  # a copy of document 2: goes
        (2, near, "en", "s", 1),
        (7, texts["c"], "en", "s", 1),  # one id, two texts: both stay
        (7, texts["d"], "en", "s", 1),
        (7, texts["d"], "en", "s", 1),  # a repeated row: one stays
        (8, texts["d"], "en", "s", 1),
        (None, texts["a"], None, "en", 1),  # a copy with other columns: the same one stays at every run
    ]
    want = sorted([("None", texts["a"]), ("2", near), ("7", texts["c"]), ("7", texts["d"])])
    runs = [pipeline.near_copies(spark, spark.createDataFrame(r, schema), sf).collect() for r in (rows, rows[::-1])]
    assert sorted((str(r.doc_id), r.text) for r in runs[0]) == want
    assert set(runs[0]) == set(runs[1]) and len(runs[1]) == len(want)
