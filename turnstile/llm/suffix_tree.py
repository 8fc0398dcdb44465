"""Scoring texts by a probabilistic suffix tree over tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.columns import ROWS, in_bytes
from turnstile.llm.staging import discard, staged_alone

DEPTH = 3  # longest context in tokens
BITS = 21  # hold the number of a token that contexts are made of; the number of a context has the rest
EVIDENCE = 256  # at most EVIDENCE * sqrt(tokens) contexts, and as many successors, a depth go out to all tasks
LEAST_TIMES = 8  # no context and no successor is learned from fewer occurrences, at any size
HELD = 1_000_000  # of a larger tree, so many contexts and successors go out to all tasks, or those by EVIDENCE if they are more
FILTER_BITS = 25  # the binary logarithm of the bits of a filter of n-grams; what it lets through is counted
LEAST_DIVERGENCE = 8.0  # nats by which a successor, and a context, must differ from the shorter one
DISCOUNT = 0.5  # taken off each successor's count for what was not seen
COMMON = 1_000_000  # tokens that go out to all tasks: the most frequent, and those with at least 1 / COMMON of all
FLUSH = 400_000  # distinct tokens that a task counts before it hands them on
PAIRS = 2_000_000  # successors, or tokens, that a task gathers before it counts them
HASHED = 1 << 14  # tokens that are hashed at once
INDEX_BITS = 24  # hold the place of a key among those that a task sorts
PART = 1 << 18  # n-grams of about so many tokens are counted together
END = b"\n"  # no word has a line end in it


def tokens_of(text: bytes | None) -> list[bytes]:
    return [*text.lower().split(), END] if text else [END]


def _coded(tokens: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct tokens, and each token's number among them."""
    coded = tokens.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def _encoded(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens of texts, the number of each token of one text after the other, and the texts' lengths."""
    tokens = [tokens_of(value) for value in texts]
    kinds, codes = _coded(pa.array(list(chain.from_iterable(tokens)), pa.binary()))
    return kinds, codes, np.array([len(t) for t in tokens], np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits that all depend on all bits of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
LETTERS = _mixed(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
IN_WORDS = np.where(BLANK, np.uint64(0), LETTERS)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, one value after the other, and where values begin, and the end."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, edges, data = column.buffers()
    edges = np.frombuffer(edges, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def _sums(data: np.ndarray, letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the tokens that begin at starts, each up to the next: what letters has for their bytes, times
    numbers drawn for their places. Some tokens at a time, since a byte takes 32 on the way."""
    edges = np.append(starts, len(data))
    most = int(np.diff(edges).max(initial=0))
    drawn = _mixed(np.arange(1, most + 1, dtype=np.uint64) << np.uint64(32)) | np.uint64(1)
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), HASHED):
        own = edges[a : a + HASHED + 1] - edges[a]
        place = np.arange(own[-1]) - np.repeat(own[:-1], np.diff(own))
        out[a : a + HASHED] = np.add.reduceat(letters[data[edges[a] : edges[a] + own[-1]]] * drawn[place], own[:-1])
    return _mixed(out)


def _hashes(tokens: pa.Array) -> np.ndarray:
    """64-bit hashes of tokens."""
    data, edges = _bytes_of(tokens.cast(pa.binary()))
    return _sums(data, LETTERS, edges[:-1])


def _token_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """_hashes() of the tokens of texts, one text after the other, and the tokens' places in their texts."""
    data, edges = _bytes_of(pc.fill_null(texts.cast(pa.binary()), b""))
    blank = BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    full = edges[:-1][np.diff(edges) > 0]
    begins[full] = ~blank[full]
    starts = np.flatnonzero(begins)
    lead = int(starts[0]) if len(starts) else 0
    keys = _sums(data[lead:], IN_WORDS, starts - lead)
    before = np.searchsorted(starts, edges)
    lengths = np.diff(before) + 1
    out = np.full(len(keys) + len(texts), _hashes(pa.array([END], pa.binary()))[0])
    out[np.arange(len(keys)) + np.repeat(np.arange(len(texts)), lengths - 1)] = keys
    return out, _places(lengths)


def _places(lengths: np.ndarray) -> np.ndarray:
    """Places of tokens in their texts."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def token_counts(docs: DataFrame, text: str, learn_from: Column) -> DataFrame:
    """(token, c): all distinct tokens of docs, c the number of times in the documents to learn from."""

    def run(batches):
        held: list[tuple[pa.Array, np.ndarray]] = []
        size = 0

        def together():
            kinds, codes = _coded(pa.concat_arrays([k for k, _ in held]))
            return kinds, np.bincount(codes, np.concatenate([n for _, n in held]), len(kinds)).astype(np.int64)

        def rows():
            kinds, n = together()
            return pa.RecordBatch.from_arrays([kinds, pa.array(n)], names=["token", "n"])

        for batch in batches:
            learned = pc.fill_null(batch.column(1), False).to_numpy(zero_copy_only=False)
            texts = in_bytes(batch.column(0))
            for begin in range(0, len(texts), ROWS):
                kinds, codes, lengths = _encoded(texts[begin : begin + ROWS])
                held.append((kinds, np.bincount(codes, np.repeat(learned[begin : begin + ROWS], lengths), len(kinds))))
                size += len(kinds)
                if size > 3 * FLUSH:
                    held = [together()]
                    size = len(held[0][0])
                    if size > FLUSH:
                        yield rows()
                        held, size = [], 0
        if held:
            yield rows()

    counted = docs.select(F.col(text).cast("string").alias("t"), learn_from.alias("l")).mapInArrow(run, "token binary, n bigint")
    return counted.groupBy("token").agg(F.sum("n").alias("c"))


def _find(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value, -1 where there is none."""
    if not len(sorted_values):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[at] == wanted, at, -1)


@dataclass
class Level:
    """Contexts of one length, sorted by key: the number of the context without its oldest token, then that
    token. retained marks those that passed the test; they have successors, sorted by code (context,
    token), with log10 probabilities, and log10 of what they leave to their suffix."""

    keys: np.ndarray
    words: np.ndarray  # newest token first
    times: np.ndarray
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    logs: np.ndarray = field(default_factory=lambda: np.zeros(0))
    retained: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass
class SuffixTree:
    """levels[d - 1]: contexts of d tokens; root: log10 probability of each token that can be in one."""

    root: np.ndarray
    levels: list[Level]

    def contexts(self, ids: np.ndarray) -> Iterator[np.ndarray]:
        """For each place and each length, the number of the context before it, or -1. ids: tokens by
        number, -1 for others and between texts."""
        at = np.zeros(len(ids), np.int64)
        for d, level in enumerate(self.levels, 1):
            oldest = np.full(len(ids), -1, np.int64)
            oldest[d:] = ids[:-d]
            at = np.where((at >= 0) & (oldest >= 0), _find(level.keys, (at << BITS) | oldest), -1)
            yield at

    def log10(self, ids: np.ndarray, root: np.ndarray) -> np.ndarray:
        """log10 probability of each token by the longest retained context before it; root: by none. What a
        context has no count for is left to its suffix."""
        out = root.copy()
        for level, at in zip(self.levels, self.contexts(ids), strict=True):
            out = _deeper(level, at, ids, out)
        return out

    def suffix_log10(self, depth: int, contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """log10 probability of tokens by the longest retained proper suffix of contexts of this depth."""
        out = self.root[tokens].copy()
        words = self.levels[depth - 1].words[contexts]
        at = np.zeros(len(contexts), np.int64)
        for d in range(1, depth):
            at = _find(self.levels[d - 1].keys, (at << BITS) | words[:, d - 1])
            out = _deeper(self.levels[d - 1], at, tokens, out)
        return out


def _deeper(level: Level, at: np.ndarray, tokens: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    if not level.retained.any():
        return shorter
    out = shorter.copy()
    here = np.flatnonzero(at >= 0)
    here = here[level.retained[at[here]]]
    contexts, token = at[here], tokens[here]
    entry = np.where(token >= 0, _find(level.codes, (contexts << BITS) | np.maximum(token, 0)), -1)
    out[here] = np.where(entry >= 0, level.logs[np.maximum(entry, 0)] if len(level.logs) else 0.0, shorter[here] + level.left[contexts])
    return out


def _numbered(texts: list[bytes | None], number: dict[bytes, int]) -> np.ndarray:
    """Numbers of the tokens of texts one after the other, -1 for those without and after each text."""
    out: list[int] = []
    for value in texts:
        out.extend([number.get(t, -1) for t in tokens_of(value)])
        out.append(-1)
    return np.array(out, np.int64)


def least_times(total: int) -> int:
    """How often a context, and a successor in it, must occur among so many tokens to go out to all tasks. What
    occurs less often, LEAST_TIMES at least, is in the model too, and is joined."""
    return max(LEAST_TIMES, math.isqrt(total) // EVIDENCE)


def _successors(docs: DataFrame, text: str, number, tree, least: int) -> list:
    """(code, n) of the deepest level's contexts with the tokens after them, n at least least: at most all
    tokens / least rows come back."""

    def run(batches):
        names, model = number.value, tree.value
        held: list[np.ndarray] = []
        size = 0

        def rows():
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

        for batch in batches:
            texts = in_bytes(batch.column(0))
            for at in range(0, len(texts), ROWS):
                ids = _numbered(texts[at : at + ROWS], names)
                *_, deepest = model.contexts(ids)
                here = (deepest >= 0) & (ids >= 0)
                held.append((deepest[here] << BITS) | ids[here])
                size += len(held[-1])
                if size >= PAIRS:
                    yield rows()
                    held, size = [], 0
        if held:
            yield rows()

    counted = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "code bigint, n bigint")
    return counted.groupBy("code").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).toPandas().sort_values("code")


def _tested(tree: SuffixTree, depth: int, codes: np.ndarray, n: np.ndarray) -> None:
    """Keep the successors and contexts of the deepest level that diverge from the suffix.

    A successor counts if n times it differs from the n e expected by the suffix by n log(n / e) -
    n + e nats (the Kullback-Leibler divergence of the two rates) of LEAST_DIVERGENCE or more."""
    level = tree.levels[depth - 1]
    context, token = codes >> BITS, codes & ((1 << BITS) - 1)
    below = 10.0 ** tree.suffix_log10(depth, context, token)
    expected = level.times[context] * below
    divergence = n * np.log(n / expected) - n + expected
    keep = (n > expected) & (divergence >= LEAST_DIVERGENCE)
    context, share = context[keep], (n[keep] - DISCOUNT) / level.times[context[keep]]
    level.codes, level.logs = codes[keep], np.log10(share)
    size = len(level.keys)
    told, taken = np.bincount(context, share, size), np.bincount(context, below[keep], size)
    level.retained = np.bincount(context, minlength=size) > 0
    level.left = np.log10(np.clip((1 - told) / np.maximum(1 - taken, 1e-9), 1e-9, None))


def grow(docs: DataFrame, text: str, names: list[bytes], times: np.ndarray, root: np.ndarray, total: int) -> SuffixTree:
    """The tree of docs. names: the tokens that contexts are made of, times and root their counts and log10
    probabilities, total the number of all tokens.

    One pass over the texts a depth: how often which token follows each context. Those that follow
    LEAST_TIMES or more are tested as successors and make the contexts of the next depth. For texts
    of which all such contexts may go out to all tasks; learned() is for larger ones."""
    spark = docs.sparkSession
    number = spark.sparkContext.broadcast({w: i for i, w in enumerate(names)})
    ids = np.arange(len(names))
    tree = SuffixTree(root, [Level(ids, ids[:, None], times)] if len(ids) else [])
    least = LEAST_TIMES
    for depth in range(1, DEPTH + 1):
        if len(tree.levels) < depth:
            break
        shared = spark.sparkContext.broadcast(tree)
        rows = _successors(docs, text, number, shared, least)
        codes, n = rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        _tested(tree, depth, codes, n)
        context, token = codes >> BITS, codes & ((1 << BITS) - 1)
        ends = np.array([w == END for w in names])
        further = ~ends[token]
        level = tree.levels[depth - 1]
        words = np.concatenate([token[further, None], level.words[context[further]]], 1)
        at = np.zeros(len(words), np.int64)
        for d in range(1, depth + 1):
            at = np.where(at >= 0, _find(tree.levels[d - 1].keys, (np.maximum(at, 0) << BITS) | words[:, d - 1]), -1)
        known = at >= 0
        keys = (at[known] << BITS) | words[known, depth]
        order = np.argsort(keys)
        if depth < DEPTH and len(keys):
            tree.levels.append(Level(keys[order], words[known][order], n[further][known][order]))
    for level in tree.levels:
        if not len(level.retained):
            level.retained, level.left = np.zeros(len(level.keys), bool), np.zeros(len(level.keys))
    return tree


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Keys of n-grams from those of their first and their last n - 1 tokens."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Sorted:
    """Sorted hashes, one more at the end, and where those with the same first bits begin."""

    keys: np.ndarray
    begins: np.ndarray
    bits: np.uint64  # the others

    @classmethod
    def of(cls, keys: np.ndarray) -> Sorted:
        bits = len(keys).bit_length() + 1
        begins = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        return cls(np.append(keys, np.uint64((1 << 64) - 1)), begins.astype(np.int32), np.uint64(64 - bits))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The first place of each wanted hash, -1 where there is none."""
        at = self.begins[wanted >> self.bits]
        there = self.keys[at]
        less = np.flatnonzero(there < wanted)
        while len(less):
            at[less] += 1
            there[less] = self.keys[at[less]]
            less = less[there[less] < wanted[less]]
        return np.where((there == wanted) & (at < len(self.keys) - 1), at, -1)


def _in_filter(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64((1 << FILTER_BITS) - 1)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def _filter(keys: DataFrame) -> np.ndarray:
    """A bit for each of 2**FILTER_BITS remainders of keys: set for all keys given, and for some others."""
    slot = F.col("key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr(f"shiftleft(1L, CAST((key & {(1 << FILTER_BITS) - 1}L) & 63L AS INT))")
    rows = keys.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return words


def _grams(keys: np.ndarray, place: np.ndarray, filters: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """For n = 2, 3, ..., as far as there are filters: the places where an n-gram ends whose first and last
    n - 1 tokens pass the filter, the keys of those two, and the n-grams' own."""
    at = np.arange(len(keys))  # where keys end
    for n, words in enumerate(filters, 2):
        frequent = _in_filter(words, keys)
        keys, at = keys[frequent], at[frequent]
        pair = np.flatnonzero((np.diff(at) == 1) & (place[at[1:]] >= n - 1))
        first, last = keys[pair], keys[pair + 1]
        keys, at = _joined(first, last), at[pair + 1]
        yield at, first, last, keys


def _ends(tokens: list[np.ndarray]) -> list[np.ndarray]:
    """Keys of the first and of the last n - 1 tokens of n-grams, from those of their n tokens."""
    while len(tokens) > 2:
        tokens = [_joined(a, b) for a, b in zip(tokens, tokens[1:], strict=False)]
    return tokens


def _new(keys: np.ndarray) -> np.ndarray:
    """Places of sorted keys that differ from the one before."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])


def _nearly_sorted(keys: np.ndarray) -> np.ndarray:
    """The order of keys by all but their last INDEX_BITS bits, which is much faster to find."""
    low = np.uint64((1 << INDEX_BITS) - 1)
    return (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)


def _gram_blocks(docs: DataFrame, text: str, filters: list[Broadcast], names: Broadcast, total: int) -> DataFrame:
    """(part, numbers, n, tokens, m): n-grams of one token more than the filters are of, with how often a task saw
    them, in arrays: n of those by the numbers of their tokens in names (24 bits), m of those by their tokens'
    keys, where one has no number (64 bits).

    Most occur once in a task, and a row for each costs more than the counting: a task sums up its own
    and sends an array for each part of the keys. total: the number of all tokens."""
    bits = min(40, max(1, (total // PART).bit_length()))  # 2**bits parts
    length = len(filters) + 1

    def run(batches):
        words, named = [sent.value for sent in filters], names.value
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def rows():
            tokens, numbers, keys, at = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(keys) if len(keys) >> INDEX_BITS else _nearly_sorted(keys)  # a few can come twice
            keys = keys[order]
            new = _new(keys)
            n = np.diff(np.append(new, len(keys))).astype(np.int32)
            keys, ends = keys[new], at[order[new]]
            own = np.stack([numbers[ends - i] for i in range(length - 1, -1, -1)], 1).astype("<i4")
            whole = (own >= 0).all(1)
            own = own.view(np.uint8).reshape(len(own), length, 4)[:, :, :3]
            edges = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(edges))
            at_once = max(1, PART * len(full) // max(1, len(keys)))
            for some in range(0, len(full), at_once):
                parts = full[some : some + at_once]
                blocks: list[tuple[bytes, ...]] = []
                for p in parts:
                    here = slice(edges[p], edges[p + 1])
                    told = whole[here]
                    others = np.stack([tokens[ends[here][~told] - i] for i in range(length - 1, -1, -1)], 1)
                    blocks.append((own[here][told].tobytes(), n[here][told].tobytes(), others.tobytes(), n[here][~told].tobytes()))
                columns = [pa.array(x, pa.binary()) for x in zip(*blocks, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *columns], names=["part", "numbers", "n", "tokens", "m"])

        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                tokens, place = _token_keys(batch.column(0).slice(begin, ROWS))
                *_, (at, _, _, keys) = _grams(tokens, place, words)
                held.append((tokens, named.find(tokens).astype(np.int32), keys, (at + size).astype(np.int32)))
                size += len(tokens)
                if size >= PAIRS:
                    yield from rows()
                    size = 0
        if held:
            yield from rows()

    return docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "part int, numbers binary, n binary, tokens binary, m binary")


def _gram_counts(blocks: DataFrame, length: int, names: Broadcast) -> DataFrame:
    """(key, first, last, n): the n-grams of _gram_blocks(), of length tokens, that occur LEAST_TIMES or more, with
    their first and their last tokens but one."""

    def run(part):
        numbers, n, tokens, m = (np.frombuffer(b"".join(part.column(c).to_pylist()), k) for c, k in (("numbers", np.uint8), ("n", np.int32), ("tokens", np.uint64), ("m", np.int32)))
        numbers = numbers.reshape(-1, length, 3).astype(np.int32)
        numbers = numbers[:, :, 0] | numbers[:, :, 1] << 8 | numbers[:, :, 2] << 16
        first, last = _ends(list(np.concatenate([names.value.keys[numbers], tokens.reshape(-1, length)]).T))
        keys, n = _joined(first, last), np.concatenate([n, m]).astype(np.int64)
        order = np.argsort(keys)
        new = _new(keys[order])
        n, order = np.add.reduceat(n[order], new), order[new]
        often = n >= LEAST_TIMES
        order = order[often]
        return pa.table([pa.array(x.view(np.int64)) for x in (keys[order], first[order], last[order], n[often])], names=["key", "first", "last", "n"])

    return blocks.groupBy("part").applyInArrow(run, "key bigint, first bigint, last bigint, n bigint")


def learned(docs: DataFrame, text: str, counts: DataFrame, floor: int, total: int, off: float) -> tuple[DataFrame, list[Broadcast]]:
    """((key, n, value), filters): the tree of docs as a table. counts: all tokens (token, c); those with floor or
    more are few enough to go out to all tasks.

    The log10 probability of a token is that without context plus the value of each n-gram that ends
    with it, and of each that ends just before it: what the longer context changes. A context's
    value is what it leaves to its suffix; a successor's is its own log10 probability less that,
    and less the one by the suffix. One pass over the texts a depth, as in grow(); the n-grams
    meet their contexts and suffixes in joins. filters: for the n-grams of 1, 2, ... tokens.
    """
    spark = docs.sparkSession

    def keyed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column(0)).view(np.int64)), batch.column(1)], names=["key", "n"])

    level = counts.filter(F.col("c") >= LEAST_TIMES).mapInArrow(keyed, "key bigint, n bigint")
    level = staged_alone(level.withColumn("log", F.log10((F.col("n") - off) / total)), "grams")
    common = level.filter(F.col("n") >= floor).select("key").toArrow()["key"].to_numpy().view(np.uint64)
    names = spark.sparkContext.broadcast(Sorted.of(np.sort(common)[: 1 << 24]))
    filters, values, done = [], [], [level]
    for _ in range(DEPTH):
        filters.append(spark.sparkContext.broadcast(_filter(level)))
        grams = _gram_counts(_gram_blocks(docs, text, filters, names, total), len(filters) + 1, names)
        shorter = level.select(F.col("key").alias("last"), F.col("log").alias("below"))
        context = level.select(F.col("key").alias("first"), F.col("n").alias("times"))
        n, expected = F.col("n"), F.col("times") * F.pow(F.lit(10.0), F.col("below"))
        share = F.when((n > expected) & (n * F.log(n / expected) - n + expected >= LEAST_DIVERGENCE), (n - DISCOUNT) / F.col("times"))
        tested = grams.join(shorter, "last").join(context, "first").withColumn("share", share)
        tested = staged_alone(tested.drop("last"), "tested")
        told, taken = F.sum("share"), F.sum(F.pow(F.lit(10.0), F.col("below")))
        left = F.log10(F.greatest((1 - told) / F.greatest(1 - taken, F.lit(1e-9)), F.lit(1e-9)))
        left = tested.filter("share IS NOT NULL").groupBy("first").agg(F.max("times").alias("times"), left.alias("left"))
        left = staged_alone(left, "left")
        log = F.coalesce(F.log10("share"), F.col("below") + F.coalesce("left", F.lit(0.0)))
        value = F.when(F.col("share").isNotNull(), F.log10("share") - F.col("below") - F.col("left"))
        level = tested.join(left.drop("times"), "first", "left").select("key", "n", log.alias("log"), value.alias("value"))
        level = staged_alone(level, "grams")
        discard(tested)
        done += [left, level]
        values += [
            left.select(F.col("first").alias("key"), F.col("times").alias("n"), F.col("left").alias("value")),
            level.filter("value IS NOT NULL").select("key", "n", "value"),
        ]
    every = values[0]
    for more in values[1:]:
        every = every.unionByName(more)
    every = staged_alone(every.groupBy("key").agg(F.max("n").alias("n"), F.sum("value").alias("value")), "values")
    for table in done:
        discard(table)
    return every, filters


@dataclass
class Frequent:
    """What tasks hold of the table that learned() gives: the frequent n-grams' keys, with their values, a filter
    for the others, and the filters by number of tokens."""

    keys: Sorted
    values: np.ndarray
    own: np.ndarray  # a filter of keys
    others: np.ndarray
    filters: list[Broadcast]

    def score(self, keys: np.ndarray, owner: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What the frequent n-grams add to each of size texts; text, key and number of times of those to be
        joined. keys: hashes of the texts' tokens, with their texts and their places there."""
        found = [(np.arange(len(keys)), keys), *[(at, grams) for at, _, _, grams in _grams(keys, place, [sent.value for sent in self.filters])]]
        sums, rest = np.zeros(size), []
        for at, grams in found:
            here = np.flatnonzero(_in_filter(self.own, grams))
            entry = self.keys.find(grams[here])
            here, entry = here[entry >= 0], entry[entry >= 0]
            sums += np.bincount(owner[at[here]], self.values[entry], size)
            more = _in_filter(self.others, grams)
            more[here] = False
            rest.append((owner[at[more]], grams[more]))
        texts_of, keys = (np.concatenate(x) for x in zip(*rest, strict=True))
        order = np.lexsort((keys, texts_of))
        texts_of, keys = texts_of[order], keys[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(texts_of) != 0) | (keys[1:] != keys[:-1])])[: len(keys)])
        return sums, texts_of[new], keys[new].view(np.int64), np.diff(np.append(new, len(keys)))


@dataclass
class Tokens:
    """Tokens by number: found by their hashes, then compared."""

    names: pa.Array
    keys: Sorted
    order: np.ndarray
    alike: int  # so many have one hash at most

    @classmethod
    def of(cls, names: pa.Array) -> Tokens:
        keys = _hashes(names)
        order = np.argsort(keys)
        alike = int(np.unique(keys, return_counts=True)[1].max(initial=0))
        return cls(names, Sorted.of(keys[order]), order.astype(np.int32), alike)

    def numbers(self, tokens: pa.Array, keys: np.ndarray) -> np.ndarray:
        """Numbers of tokens with these hashes, -1 for others."""
        out = np.full(len(tokens), -1, np.int64)
        at = self.keys.find(keys)
        here = np.flatnonzero(at >= 0)
        found = tokens.take(pa.array(here))
        for i in range(self.alike):
            number = self.order[np.minimum(at[here] + i, len(self.order) - 1)]
            same = pc.equal(self.names.take(pa.array(number)), found).to_numpy(zero_copy_only=False)
            out[here[same]] = number[same]
        return out


def least_held(values: DataFrame, times: str, least: int, lowest: int, most: int) -> int:
    """How often what values has must occur to go out to all tasks: least times, or less, lowest at least, where
    most leaves room."""
    by_times = dict(values.filter(F.col(times) >= lowest).groupBy(F.least(times, F.lit(least)).alias("n")).count().collect())  # at most least rows
    held = by_times.get(least, 0)
    while least > lowest and held + by_times.get(least - 1, 0) <= most:
        least -= 1
        held += by_times.get(least, 0)
    return least


def frequent(values: DataFrame, filters: list[Broadcast], least: int) -> Frequent:
    """n-grams that occur least times or more are few enough to go out to all tasks."""
    rows = values.filter(F.col("n") >= least).select("key", "value").toArrow()
    keys = rows["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    held = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    slot = keys & np.uint64((1 << FILTER_BITS) - 1)
    np.bitwise_or.at(held, slot >> np.uint64(6), np.uint64(1) << (slot & np.uint64(63)))
    return Frequent(Sorted.of(keys[order]), rows["value"].to_numpy()[order], held, _filter(values.filter(F.col("n") < least)), filters)


def scored(docs: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, learned, n_tokens, n_known, train_tokens, base_score and score for each row of docs.

    Tokens are words in lower case (A-Z) and one end; c is a token's count in the rows that
    learn_from selects, N that of all and V the number of distinct ones. base_score adds
    log10((c + 1) / (N + V + 1)). score is the text's log10 probability under a suffix tree grown
    from the same rows, in the same space of outcomes (V tokens and an unknown one): without
    context (c - d) / N, and d V / N for an unknown token, d by the tokens seen once and twice;
    after a retained context its own counts, for the successors that diverge from the shorter
    context's, and what is left shared as after the shorter one.

    Every token is counted. The most frequent, at most COMMON, go out to all tasks; a document's
    other tokens, each with its number of times, meet their counts in a join.
    The tree holds all contexts and successors that occur LEAST_TIMES and diverge, however large the
    input. As long as they are few enough to go out to all tasks, they do (grow); of a larger tree the
    frequent part does, and the rest is joined by 64-bit hashes (learned). Scores are the same to rounding.
    Null text: only an end. Nothing to learn from: all tokens are unknown, probability 1.
    Repeated rows are scored apart. Other columns are left out.
    """
    spark = docs.sparkSession
    counts = staged_alone(token_counts(docs, text, learn_from), "tokens")
    c = F.col("c")
    every = counts.filter(c > 0).agg(F.sum(c), F.count("*"), F.count(F.when(c == 1, 1)), F.count(F.when(c == 2, 1))).first()
    total, kinds, once, twice = every[0] or 0, every[1], every[2], every[3]
    off = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.05
    unknown = float(np.log10(off * kinds / total)) if total else 0.0
    floor = least_held(counts, "c", max(1, -(-total // COMMON)), 1, COMMON)
    common = counts.filter(c >= floor).toArrow().combine_chunks().sort_by([("c", "descending"), ("token", "ascending")])
    names, often = common["token"].combine_chunks(), common["c"].to_numpy()
    root = np.log10((often - off) / max(total, 1))
    values, least = None, least_times(total)
    if least > LEAST_TIMES:
        values, filters = learned(docs.filter(learn_from), text, counts, floor, total, off)
        least = least_held(values, "n", least, LEAST_TIMES, HELD)
        tree = frequent(values, filters, least)
    else:
        parts = int((often >= LEAST_TIMES).sum())
        tree = grow(docs.filter(learn_from), text, names[:parts].to_pylist(), often[:parts], root[:parts], total)
    sent = spark.sparkContext.broadcast((Tokens.of(names), root, np.log10(often + 1.0), tree))

    fields = ["row", "key", "learned", "token", "times", "n_tokens", "n_known", "logs", "score", "gram"]
    types = [pa.int64(), None, pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]

    def run(batches):
        numbered, root, logs, model = sent.value
        root, logs = np.append(root, 0.0), np.append(logs, 0.0)  # the last, -1: for the join to add
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                size = part.num_rows

                def made(given, n, kind=part.column(1).type):
                    return pa.RecordBatch.from_arrays([pa.array(given[f], k or kind) if f in given else pa.nulls(n, k or kind) for f, k in zip(fields, types, strict=True)], names=fields)

                kinds, codes, lengths = _encoded(in_bytes(part.column(0)))
                owner, keys = np.repeat(np.arange(size), lengths), _hashes(kinds)
                of_kind = numbered.numbers(kinds, keys)
                ids = of_kind[codes]
                if isinstance(model, Frequent):
                    more, of, grams, often = model.score(keys[codes], owner, _places(lengths), size)
                    score = np.bincount(owner, root[of_kind][codes], size) + more
                    yield made({"row": row + of, "gram": grams, "times": often}, len(of))
                else:
                    at = np.arange(len(ids)) + owner  # with a place after each text
                    inside, alone = np.full(len(ids) + size, -1, np.int64), np.zeros(len(ids) + size)
                    inside[at], alone[at] = np.where(ids < len(model.root), ids, -1), root[ids]
                    score = np.bincount(owner, model.log10(inside, alone)[at], size)
                rare = ids < 0
                pairs, times = np.unique(owner[rare] * len(kinds) + codes[rare], return_counts=True)
                yield made({"row": row + pairs // len(kinds), "token": kinds.take(pa.array(pairs % len(kinds))), "times": times}, len(pairs))
                known, base = np.bincount(owner, ~rare, size).astype(np.int64), np.bincount(owner, logs[of_kind][codes], size)
                whole = {"row": row + np.arange(size), "key": part.column(1), "learned": part.column(2), "n_tokens": lengths, "n_known": known, "logs": base, "score": score}
                yield made(whole, size)
                row += size

    source = docs.select(F.col(text).cast("string").alias("t"), F.col(key).alias("key"), learn_from.alias("learned"))
    kind = source.schema["key"].dataType.simpleString()
    schema = f"row bigint, key {kind}, learned boolean, token binary, times bigint, n_tokens bigint, n_known bigint, logs double, score double, gram bigint"
    first = staged_alone(source.mapInArrow(run, schema), "parts")
    times = F.col("times")
    rare = first.filter("token IS NOT NULL").select("row", "token", "times").join(counts.filter(c < floor), "token")
    rare = rare.select(
        "row",
        F.when(c > 0, times).otherwise(0).alias("n_known"),
        (times * F.log10(c + 1)).alias("logs"),
        (times * F.when(c > 0, F.log10((c - off) / max(total, 1))).otherwise(unknown)).alias("score"),
    )
    if values is not None:
        joined = first.filter("gram IS NOT NULL").select("row", "times", "gram").join(values.filter(F.col("n") < least), F.col("gram") == F.col("key"))
        rare = rare.unionByName(joined.select("row", (times * F.col("value")).alias("score")), allowMissingColumns=True)
    whole = first.filter("token IS NULL AND gram IS NULL").select("row", "key", "learned", "n_tokens", "n_known", "logs", "score").unionByName(rare, allowMissingColumns=True)
    sums = [f(name).alias(name) for f, name in ((F.max, "learned"), (F.max, "n_tokens"), (F.sum, "n_known"), (F.sum, "logs"), (F.sum, "score"))]
    added = whole.groupBy("row").agg(F.max("key").alias(key), *sums)
    spread = float(np.log10(total + kinds + 1))
    return added.select(
        key,
        "learned",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * spread).alias("base_score"),
        "score",
    )
