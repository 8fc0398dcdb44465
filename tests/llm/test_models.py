"""Language ID, suffix-tree scores and fingerprints."""

import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests_llm_words import lower, shingles, words
from turnstile.llm import language, minhash, queries, suffix_tree

SCHEMA = "doc_id long, text string"


def test_op10_names_held_out_languages(spark, sf, documents):
    out = {r.doc_id: r for r in queries.op10_language_id(spark, sf).collect()}
    right = [out[r.doc_id].lang_pred == r.lang for r in documents if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {r.doc_id for r in documents} == set(out) and sum(right) / len(right) > 0.9
    assert all(out[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= out[r.doc_id].score <= 1 for r in documents)


def test_language_of_odd_rows(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(language, "CHARS", 1000)  # the long text comes in pieces
    rows = [*odd_rows, (30, "12 34 !!"), (31, "漢字仮名" * 3000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("LANG_PRED", F.lit("clash"))
    learned = {"xx": np.ones(language.DIMENSIONS), "yy": -np.ones(language.DIMENSIONS)}
    out = language.identify(df, learned).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert {r.lang_pred for r in language.identify(df, {}).collect()} == {"und"}
    assert language.identify(df.limit(0), learned).collect() == [] and language.prototypes(df.limit(0).withColumn("lang", F.lit("a"))) == {}


def test_prototypes_add_trigram_vectors(spark):
    df = spark.createDataFrame([("Ab", "x"), ("ab ab", "x"), (None, "x"), ("zz", None)], "text string, lang string")
    got = language.prototypes(df)["x"]
    one = lambda t: language._bound(np.array([[ord(c) for c in t]]), language.DIMENSIONS)[0]
    assert np.array_equal(got, 3 * one(" ab") + 3 * one("ab ") + one("b a"))


def plain_bundle(text, dims):
    """Sum of the vectors of a text's trigrams, one letter after the other."""
    letters = " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + " "
    joined = " " + " ".join(letters.split()) + " " if letters.split() else " "
    total = np.zeros(dims)
    for a, b, c in zip(joined, joined[1:], joined[2:]):
        x, y, z = (language._letter_vector(ord(p), dims).astype(np.int64) for p in (a, b, c))
        total += np.roll(x, 2) * np.roll(y, 1) * z
    return total


def test_slices_add_up_to_the_plain_bundle(monkeypatch):
    monkeypatch.setattr(language, "SLICE", 97)
    texts = ["".join(map(chr, np.random.default_rng(2).integers(0x4E00, 0x4F00, 3_000))), "Ab ab, 12 ab\n" * 40, "", "é"]
    docs, slices = language._trigrams(*language._chunks(texts))
    sums = sum(counts @ language._bound(triples, 64) for counts, triples in slices)
    assert docs == [0, 1, 2, 3] and all(np.array_equal(v, plain_bundle(t, 64)) for v, t in zip(sums, texts, strict=True))


def test_op10_against_plain_cosines(spark, sf, documents):
    """Every document's language and score from letters' vectors added one by one."""
    bundles = {r.doc_id: plain_bundle(r.text, language.DIMENSIONS) for r in documents}
    learned = {}
    for r in documents:
        if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None:
            learned[r.lang] = learned.get(r.lang, 0) + bundles[r.doc_id]
    for r in queries.op10_language_id(spark, sf).collect():
        v = bundles[r.doc_id]
        if not v.any():
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        cosines = {n: float(p @ v / np.linalg.norm(p) / np.linalg.norm(v)) for n, p in learned.items()}
        assert r.score == pytest.approx(max(0.0, max(cosines.values())), abs=1e-5)
        assert cosines[r.lang_pred] == pytest.approx(max(cosines.values()), abs=1e-5)


def test_many_letters_take_bounded_memory():
    """A million characters of thousands of letters, in a process of its own that may not pass 1 GB."""
    code = (
        "import resource, sys, numpy as np; sys.path.insert(0, %r)\n"
        "from turnstile.llm import language as l\n"
        "text = ''.join(map(chr, np.random.default_rng(1).integers(0x4E00, 0x9FA5, 1_000_000)))\n"
        "n = size = 0\n"
        "for piece in l._chunks([text]):\n"
        "    for counts, triples in l._trigrams(piece)[1]:\n"
        "        size += (counts[:, :64] @ l._bound(triples[:64], 64)).shape[1]; l._bound(triples, 1024); n += counts.sum()\n"
        "print(int(n), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"
    ) % os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    n, mb = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert n == 1_000_000 and mb < 1024


def test_op8_counts_exactly_and_beats_single_tokens(spark, sf, documents):
    out = {r.doc_id: r for r in queries.op8_suffix_tree(spark, sf).collect()}
    tokens = {r.doc_id: [*words(lower(r.text)), None] for r in documents}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    n, v = sum(counts.values()), len(counts)
    for i, ts in tokens.items():
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ts), sum(counts[t] > 0 for t in ts), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert sum(out[i].score for i in out if held[i]) > sum(out[i].base_score for i in out if held[i])


def plain_scores(texts, learned, least):
    """log10 probability of each text under the tree grown with dictionaries, a context at a time."""
    train = [suffix_tree.tokens_of(t.encode()) for t, l in zip(texts, learned, strict=True) if l]
    counts = Counter(t for ts in train for t in ts)
    total, kinds = sum(counts.values()), len(counts)
    once, twice = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
    off = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.05
    root = lambda t: (counts[t] - off) / total if counts[t] else off * kinds / total
    tree, times = {}, {(t,): c for t, c in counts.items() if c >= least}

    def chance(context, token):
        for k in range(len(context)):
            if context[k:] in tree:
                told, left = tree[context[k:]]
                return told[token] if token in told else left * chance(context[k + 1 :], token)
        return root(token)

    for depth in range(1, suffix_tree.DEPTH + 1):
        after = {c: Counter() for c in times}
        for ts in train:
            for i in range(depth, len(ts)):
                if tuple(ts[i - depth : i]) in after:
                    after[tuple(ts[i - depth : i])][ts[i]] += 1
        found, deeper = {}, {}
        for context, tokens in after.items():
            told, taken = {}, 0.0
            for token, n in tokens.items():
                if n < least or counts[token] < least:
                    continue
                if token != suffix_tree.END and (*context[1:], token) in times:
                    deeper[(*context, token)] = n
                below = chance(context[1:], token)
                expected = times[context] * below
                if n > expected and n * math.log(n / expected) - n + expected >= suffix_tree.LEAST_DIVERGENCE:
                    told[token] = (n - suffix_tree.DISCOUNT) / times[context]
                    taken += below
            if told:
                found[context] = told, (1 - sum(told.values())) / (1 - taken)
        tree |= found
        times = deeper
    out = []
    for text in texts:
        ts = suffix_tree.tokens_of(text.encode())
        out.append(sum(math.log10(chance(tuple(ts[max(0, i - suffix_tree.DEPTH) : i]), t)) for i, t in enumerate(ts)))
    return out, {d: sum(len(c) == d for c in tree) for d in range(1, suffix_tree.DEPTH + 1)}


def test_suffix_tree_against_dictionaries(spark):
    rng = random.Random(4)
    phrases = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(2, 7))) for _ in range(12)]
    texts = [" ".join(rng.choice(phrases) if rng.random() < 0.7 else f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(30)) for _ in range(150)]
    learned = [i % 5 > 0 for i in range(len(texts))]
    want, retained = plain_scores(texts, learned, suffix_tree.least_times(10_000))
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.doc_id: r.score for r in suffix_tree.scored(df, F.col("doc_id") % 5 > 0).collect()}
    assert min(retained.values()) > 0 and [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-6)


def test_suffix_tree_has_all_its_contexts_at_any_size(spark, monkeypatch):
    """Where the tree is too large to go out to all tasks, its scores stay those of the dictionaries."""
    rng = random.Random(5)
    phrases = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(2, 7))) for _ in range(40)]
    texts = [" ".join(rng.choice(phrases) if rng.random() < 0.7 else f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(30)) for _ in range(150)]
    want, retained = plain_scores(texts, [i % 5 > 0 for i in range(len(texts))], suffix_tree.LEAST_TIMES)
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    assert min(retained.values()) > 0
    for evidence, common, held in ((256, 1_000_000, 0), (4, 1_000_000, 10**6), (1, 200, 0)):  # a small tree, all of a large one, few go out
        monkeypatch.setattr(suffix_tree, "HELD", held, raising=False)
        monkeypatch.setattr(suffix_tree, "EVIDENCE", evidence)
        monkeypatch.setattr(suffix_tree, "COMMON", common)
        got = {r.doc_id: r.score for r in suffix_tree.scored(df, F.col("doc_id") % 5 > 0).collect()}
        assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-6), (evidence, common)


def test_token_hashes_agree_however_they_are_read(monkeypatch):
    monkeypatch.setattr(suffix_tree, "HASHED", 3)
    rng = random.Random(3)
    draw = lambda: bytes(rng.choice(b" \t\n\x0b\x0c\r aAbZz\xc3\xa9\x1c\x85\xa0") for _ in range(rng.randrange(12)))
    for _ in range(200):
        texts = [None if rng.random() < 0.1 else draw() for _ in range(rng.randrange(9))] + [b"x" * rng.randrange(200) + b" Y"]
        tokens = [t for value in texts for t in suffix_tree.tokens_of(value)]
        keys, place = suffix_tree._token_keys(pa.array([b"more", *texts], pa.binary()).slice(1))
        assert keys.tolist() == suffix_tree._hashes(pa.array(tokens, pa.binary())).tolist() and len(set(keys.tolist())) == len(set(tokens))
        assert place.tolist() == [i for value in texts for i in range(len(suffix_tree.tokens_of(value)))]


def test_large_trees_send_few_rows_and_keep_their_scores(spark, monkeypatch):
    """n-grams are sent in arrays, and tokens with too small a share go out to all tasks while there is room."""
    rng = random.Random(6)
    phrases = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(2, 7))) for _ in range(40)]
    texts = [" ".join(rng.choice(phrases) if rng.random() < 0.7 else f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(30)) for _ in range(150)] + ["new words", ""]
    want, _ = plain_scores(texts, [i % 5 > 0 for i in range(len(texts))], suffix_tree.LEAST_TIMES)
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).coalesce(2)
    rows, stage, blocks = {}, suffix_tree.staged_alone, suffix_tree._gram_blocks
    monkeypatch.setattr(suffix_tree, "staged_alone", lambda df, label: rows.__setitem__(label, out := stage(df, label)) or out)
    monkeypatch.setattr(suffix_tree, "_gram_blocks", lambda *given: rows.__setitem__("blocks", out := blocks(*given)) or out)
    monkeypatch.setattr(suffix_tree, "EVIDENCE", 1)
    for common, part, held in ((100, 10**6, 10**6), (100, 500, 20), (20, 500, 0)):  # all tokens go out, all of them, some
        monkeypatch.setattr(suffix_tree, "COMMON", common)
        monkeypatch.setattr(suffix_tree, "PART", part)
        monkeypatch.setattr(suffix_tree, "HELD", held)
        got = {r.doc_id: r.score for r in suffix_tree.scored(df, F.col("doc_id") % 5 > 0).collect()}
        assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-6), (common, part, held)
        assert rows["blocks"].count() <= 2 * 2 ** max(1, (10_000 // part).bit_length())
        tail = rows["parts"].filter("token IS NOT NULL").select("token").distinct().count()
        assert tail == 2 if common == 100 else tail > 20  # "new" and "words" are in no text to learn from


def test_tokens_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(suffix_tree, "_hashes", lambda tokens: np.array([len(t.as_py()) for t in tokens], np.uint64))
    names, other = (pa.array(x, pa.binary()) for x in ([b"b", b"aa", b"a", b"cc", b"dd"], [b"dd", b"x", b"a", b"aa", b"xxx", b"b", b"cc"]))
    assert suffix_tree.Tokens.of(names).numbers(other, suffix_tree._hashes(other)).tolist() == [4, -1, 2, 1, -1, 0, 3]


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    out = {r.doc_id: r for r in suffix_tree.scored(df, F.lit(False)).collect()}
    assert [(out[i].n_tokens, out[i].n_known, out[i].train_tokens, out[i].score) for i in (1, 2)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]


def model_of(spark, path, monkeypatch):
    """(contexts retained at each depth, what contexts add to a held-out token's log10 probability)."""
    trees, grow = [], suffix_tree.grow
    monkeypatch.setattr(suffix_tree, "grow", lambda *given: trees.append(grow(*given)) or trees[-1])
    per_token = []
    for least in (8, 10**9):  # with contexts, and with none
        monkeypatch.setattr(suffix_tree, "LEAST_TIMES", least)
        out = queries.op8_suffix_tree(spark, path).filter("held_out").agg(F.sum("score") / F.sum("n_tokens")).first()
        per_token.append(out[0])
    monkeypatch.undo()
    assert not trees[1].levels
    return [int(level.retained.sum()) for level in trees[0].levels], per_token[0] - per_token[1]


def test_model_grows_with_the_input(spark, sf, monkeypatch):
    """Ten times the text: more contexts at each depth, and held-out texts gain more from them."""
    small, large = (model_of(spark, path, monkeypatch) for path in (sf, sf.replace("0.001", "0.01")))
    assert len(small[0]) == len(large[0]) == suffix_tree.DEPTH and all(a < b for a, b in zip(small[0], large[0], strict=True))
    assert 0 < small[1] < large[1]


def test_least_times_grows_by_the_square_root():
    assert [suffix_tree.least_times(n) for n in (0, 10**6, 10**8, 10**10, 10**14)] == [8, 8, 39, 390, 39062]


def test_suffix_tree_is_a_distribution_and_learns_contexts(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "PAIRS", 50)
    texts = ["a b c d " * 20, "a b c e " * 20, "x y " * 30, "b q " * 10]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    counts = Counter(t for x in texts for t in suffix_tree.tokens_of(x.encode()))
    names, total = [t for t, _ in counts.most_common()], sum(counts.values())
    times = np.array([counts[t] for t in names])
    root = np.log10(times / total)
    tree = suffix_tree.grow(df, "text", names, times, root, total)
    assert len(tree.levels) >= 2 and tree.levels[0].retained.any()
    number = {t: i for i, t in enumerate(names)}
    for context in ([b"x"], [b"a", b"b"], [b"q"], [b"b", b"c"]):
        ids = np.array([[*(number[t] for t in context), i] for i in range(len(names))])
        p = [10 ** tree.log10(row, root[row])[-1] for row in ids]
        assert sum(p) == pytest.approx(1, abs=1e-6)
    assert 10 ** tree.log10(np.array([number[b"x"], number[b"y"]]), root[[number[b"x"], number[b"y"]]])[-1] > 0.9


def test_scores_of_odd_rows(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, SCHEMA)
    out = suffix_tree.scored(df, F.coalesce(F.col("doc_id") == 1, F.lit(False))).collect()
    assert len(out) == len(odd_rows) and {r.train_tokens for r in out} == {6} and all(r.score < 0 for r in out)
    assert {r.score for r in suffix_tree.scored(df, F.lit(False)).collect()} == {0.0}
    assert suffix_tree.scored(df.limit(0), F.lit(True)).collect() == []


def test_op9_fingerprints(spark, sf, documents):
    out = {r.doc_id: r for r in queries.op9_fingerprints(spark, sf).collect()}
    text = {r.doc_id: r.text or "" for r in documents}
    ids, errors, prints = sorted(text, reverse=True), [], {}
    for i, doc in enumerate(ids):
        own, after, r = text[doc], text[ids[(i + 1) % len(ids)]], out[doc]
        k = len(own) // 3
        edited = own[: len(own) - k] + after[:k]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(own, r.fingerprint) == r.fingerprint
        a, b = shingles(own), shingles(edited)
        if len(a) >= 50:
            errors.append(r.near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.06


def test_fingerprints_of_odd_rows(spark, odd_rows):
    out = minhash.fingerprints(spark.createDataFrame(odd_rows, SCHEMA)).collect()
    assert len(out) == len(odd_rows)
    assert {r.fingerprint for r in out if r.doc_id in (2, 3, 4)} == {""}
    assert len({r.fingerprint for r in out if r.doc_id in (1, 5)}) == 1
    assert minhash.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = minhash.fingerprints(spark.createDataFrame([(1, "a b c d e f")], SCHEMA)).collect()
    assert [r.near_next for r in alone] == [1.0]
