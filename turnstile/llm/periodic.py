"""Periodic run detection by string synchronising sets over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.columns import in_bytes, with_arrow_columns

LEAST = 12  # words of a run
AT_ONCE = 200_000  # words handled at once; a longer text is handled alone
SMALL = 5  # periods found by comparing neighbours; scale 2 takes over at 3 * 2

_ODD, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NEVER = np.uint64(2**64 - 1)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, lengths, periods


def _names(words: np.ndarray) -> list[np.ndarray]:
    """Level k: a hash for the 2**k words from each place on, equal for equal words."""
    levels = [words]
    while 2 << (len(levels) - 1) <= len(words):
        half, last = 1 << (len(levels) - 1), levels[-1]
        x = last[:-half] * _ODD + (last[half:] ^ (last[half:] >> np.uint64(29))) * _TURN
        levels.append((x ^ (x >> np.uint64(31))) * _ODD)
    return levels


def _equal_ahead(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For places a < b: how many words from a on are those from b on."""
    n, far = len(levels[0]), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        last = len(levels[k]) - 1
        fits = b + far + (1 << k) <= n
        same = fits & (levels[k][np.minimum(a + far, last)] == levels[k][np.minimum(b + far, last)])
        far += same.astype(np.int64) << k
    return far


def _equal_behind(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For places a < b: how many words before a are those before b."""
    far = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        at = a - far - (1 << k)
        fits = at >= 0
        at = np.maximum(at, 0)
        same = fits & (levels[k][np.minimum(at, len(levels[k]) - 1)] == levels[k][np.minimum(at + (b - a), len(levels[k]) - 1)])
        far += same.astype(np.int64) << k
    return far


def _stretched(levels: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> Runs:
    """Runs through places where a period is proposed: grown both ways, kept if two periods long."""
    start = at - _equal_behind(levels, at, at + period)
    length = at + period + _equal_ahead(levels, at, at + period) - start
    return _smallest(start, length, period, length >= 2 * period)


def _smallest(start: np.ndarray, length: np.ndarray, period: np.ndarray, keep: np.ndarray) -> Runs:
    """Each stretch once, with its smallest period."""
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    return start[first], length[first], period[first]


def _of_neighbours(words: np.ndarray, period: int) -> Runs:
    """Stretches of a small period: rows of places equal to the one that many words on."""
    same = np.zeros(max(0, len(words) - period) + 2, np.int8)
    same[1:-1] = words[:-period] == words[period:] if len(words) > period else 0
    turns = np.diff(same)
    start, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    keep = end - start >= period
    return start[keep], (end - start + period)[keep], np.full(int(keep.sum()), period)


def synchronising(names: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Places whose window of scale words has the least hash of the scale + 1 windows from there on, or
    whose last of these has: chosen by the 2 * scale words from there on and nothing else.

    periodic marks the windows with a period of a third of scale or less; they are never the least. So
    any scale places in a row hold one of the set, but where such a period reigns."""
    hashes = np.where(periodic, _NEVER, names)
    if len(hashes) <= scale:
        return np.zeros(0, np.int64)
    least = hashes
    for step in [1 << k for k in range(scale.bit_length() - 1)]:  # least of scale windows, by doubling
        least = np.minimum(least[:-step], least[step:])
    first, last = hashes[: len(hashes) - scale], hashes[scale:]
    least = np.minimum(least[: len(first)], last)
    return np.flatnonzero((least != _NEVER) & ((least == first) | (least == last)))


def runs(words: np.ndarray) -> Runs:
    """All runs of the words (64-bit hashes): stretches of two periods or more, each with its smallest
    period, that can't grow on either side, in order of start and period.

    Periods up to SMALL come from comparing neighbours. For each scale, a power of two, places of the
    synchronising set that lie 3 to 6 scales apart and see the same 2 * scale words propose their
    distance. A run whose smallest period lies in that range holds such a pair: its first period has a
    place of the set, else a period of a third of the scale would reign over more than a period and be
    the run's own. Runs of short periods are known before a scale asks where they reign. Each proposal
    is checked by how far the words agree, so none is wrong but by an equal 64-bit hash."""
    n, levels = len(words), _names(words)
    found = [_of_neighbours(words, p) for p in range(1, SMALL + 1)]
    known = _smallest(*[np.concatenate(c) for c in zip(*found, strict=True)], keep=slice(None))
    k = 1
    while 6 << k <= n:  # a period of 3 scales fits twice
        scale = 1 << k
        start, length, period = known
        reign = (3 * period <= scale) & (length >= scale)
        marks = np.zeros(n + 1, np.int64)
        np.add.at(marks, start[reign], 1)
        np.add.at(marks, (start + length - scale + 1)[reign], -1)
        places = synchronising(levels[k], scale, np.cumsum(marks)[: len(levels[k])] > 0)
        context = levels[k + 1]
        places = places[places < len(context)]
        ahead, sites, periods = 1, [], []
        while ahead < len(places):
            near, far = places[:-ahead], places[ahead:]
            apart = far - near
            if (apart >= 6 * scale).all():
                break
            here = (apart >= 3 * scale) & (apart < 6 * scale)
            here[here] = context[near[here]] == context[far[here]]
            sites.append(near[here])
            periods.append(apart[here])
            ahead += 1
        if sites:
            new = _stretched(levels, np.concatenate(sites), np.concatenate(periods))
            known = _smallest(*[np.concatenate(c) for c in zip(known, new, strict=True)], keep=slice(None))
        k += 1
    order = np.lexsort((known[2], known[0]))
    return known[0][order], known[1][order], known[2][order]


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []  # blanks and control characters 9 to 13


def _in_groups(sizes: list[int]):
    """Ranges of texts of AT_ONCE words at most, or one text."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > AT_ONCE:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def _described(texts: list[bytes | None]):
    """Runs of each text, and what is left of it."""
    split = [_words(t) for t in texts]
    for begin, end in _in_groups([len(w) + 1 for w in split]):
        group = split[begin:end]
        # one sequence, a word of its own after each text
        hashes = np.array([h for i, w in enumerate(group) for h in (*map(xxhash.xxh3_64_intdigest, w), xxhash.xxh3_64_intdigest(b" %d" % i))], np.uint64)
        start, length, period = runs(hashes)
        long = length >= LEAST
        start, length, period = start[long], length[long], period[long]
        marks = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(marks, start + period, 1)
        np.add.at(marks, start + length, -1)
        kept = np.cumsum(marks) == 0
        first = 0
        for w in group:
            s, e = np.searchsorted(start, [first, first + len(w)])
            left = [x for x, k in zip(w, kept[first : first + len(w)], strict=True) if k]
            yield start[s:e] - first, length[s:e], period[s:e], b" ".join(left)
            first += len(w) + 1


RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])


def with_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row of docs with runs, a list of (start, length, period) in words by start and period, and
    collapsed, the text's words without those that a run repeats, joined by a blank.

    A run is a stretch of max(LEAST, 2 * period) words or more in which words period apart are equal,
    period being the smallest such number, and that neither neighbour lengthens. Of each run the first
    period stays, as far as no other run takes it. Words are kept apart by blanks and control characters
    9 to 13. A text is one row of one task; working space is some 200 bytes a word of the longest text
    or of AT_ONCE words.

    Null, empty or blank text: no runs, collapsed is empty. Repeated rows get the same answer.
    Columns of docs named like the new ones, in any case, are replaced. keep: the columns carried along.
    """

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            found, left = [], []
            for starts, lengths, periods, rest in _described(in_bytes(column)):
                found.append([{"start": s, "length": n, "period": p} for s, n, p in zip(starts.tolist(), lengths.tolist(), periods.tolist(), strict=True)])
                left.append(rest)
            kind = pa.list_(pa.struct([pa.field(f.name, pa.int64(), False) for f in RUN]))
            return [pa.array(found, kind), pa.array(left, pa.binary()).cast(pa.string())]

        return work

    fields = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    return with_arrow_columns(docs.withColumn(text, F.col(text).cast("string")), [text], fields, start, keep)


def longest(runs: str = "runs") -> Column:
    """The longest run of a list; of equal ones that with the smallest start, then period."""
    before = lambda a, b: (a.length > b.length) | ((a.length == b.length) & ((a.start < b.start) | ((a.start == b.start) & (a.period < b.period))))
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | before(r, best), r).otherwise(best))
