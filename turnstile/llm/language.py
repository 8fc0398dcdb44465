"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.columns import with_arrow_columns

DIMENSIONS = 1024
UNKNOWN = "und"
DOCS, CHARS = 256, 2_000_000  # a chunk inside a task
SLICE = 4096  # distinct trigrams whose vectors are there at once
SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@functools.lru_cache(maxsize=32_768)
def _letter_vector(point: int, dims: int) -> np.ndarray:
    """Random signs drawn from the code point alone, so every task has the same."""
    return np.random.default_rng([7, point]).integers(0, 2, dims, dtype=np.int8) * 2 - 1


def _chunks(texts: list[str | None]):
    """Runs of texts of bounded count and length; a longer text comes in overlapping pieces."""
    piece: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, max(1, len(text)), CHARS):
            part = text[max(0, at - 2) : at + CHARS]
            if piece and (size + len(part) > CHARS or len(piece) >= DOCS):
                yield piece
                piece, size = [], 0
            piece.append((i, part))
            size += len(part)
    if piece:
        yield piece


def _trigrams(piece: list[tuple[int, str]]):
    """The documents, and slices of bounded size (counts of documents by trigram, the trigrams' code points).
    Letters in lower case, a single blank for what lies between words and at both ends."""
    docs = sorted({i for i, _ in piece})
    row = {d: k for k, d in enumerate(docs)}
    joined = "".join(" " + t + " " for _, t in piece)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    lengths = np.array([len(t) + 2 for _, t in piece])
    owner = np.repeat(np.array([row[i] for i, _ in piece]), lengths)
    first = np.zeros(len(points), bool)
    first[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = True
    letter = _letters()[points]
    keep = letter | first
    keep[1:] |= letter[:-1]
    points = np.where(letter, points, SPACE)[keep]
    owner, part = owner[keep], np.cumsum(first)[keep]
    if len(points) < 3:
        return docs, iter(())
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    symbols = np.flatnonzero(seen)
    number = np.zeros(0x110000, np.int64)
    number[symbols] = np.arange(len(symbols))
    s, u = number[points], len(symbols)
    whole = part[:-2] == part[2:]
    codes, at = ((s[:-2] * u + s[1:-1]) * u + s[2:])[whole], owner[:-2][whole]
    if u**3 <= 1 << 22:
        there = np.zeros(u**3, bool)
        there[codes] = True
        kinds = np.flatnonzero(there)
        place = np.zeros(u**3, np.int64)
        place[kinds] = np.arange(len(kinds))
        columns = place[codes]
    else:
        kinds, columns = np.unique(codes, return_inverse=True)
    del s, codes, owner, part, points, keep, letter, first

    def slices():
        order = np.argsort(columns, kind="stable") if len(kinds) > SLICE else None
        place, row_of = (columns, at) if order is None else (columns[order], at[order])
        for begin in range(0, len(kinds), SLICE):
            some = kinds[begin : begin + SLICE]
            low, high = (0, len(place)) if order is None else np.searchsorted(place, [begin, begin + SLICE])
            cells = row_of[low:high] * len(some) + place[low:high] - begin
            counts = np.bincount(cells, minlength=len(docs) * len(some)).reshape(len(docs), len(some))
            yield counts.astype(np.float32), symbols[np.stack([some // (u * u), some // u % u, some % u], axis=1)]

    return docs, slices()


def _bound(triples: np.ndarray, dims: int) -> np.ndarray:
    """A trigram's vector: its letters' vectors, rolled by 2, 1 and 0 places, multiplied."""
    used, at = np.unique(triples, return_inverse=True)
    at = at.reshape(triples.shape)
    base = np.stack([_letter_vector(int(p), dims) for p in used]) if len(used) else np.zeros((0, dims), np.int8)
    return (np.roll(base, 2, 1)[at[:, 0]] * np.roll(base, 1, 1)[at[:, 1]] * base[at[:, 2]]).astype(np.float32)


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", dims: int = DIMENSIONS) -> tuple[dict[str, np.ndarray], dict[str, float]]:
    """The bundle of all texts of each language, and how many trigrams are in it: sums added up in the
    tasks, then by Spark. dims + 1 numbers for each language come to the driver."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for piece in _chunks(batch.column(1).to_pylist()):
                rows, slices = _trigrams(piece)
                for counts, triples in slices:
                    vectors = _bound(triples, dims)
                    for name in {langs[r] for r in rows}:
                        mine = counts[[langs[r] == name for r in rows]].sum(axis=0, dtype=np.float64)
                        total[name] = total.get(name, 0) + np.append(mine @ vectors, mine.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["lang", "v"]
        )

    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    parts = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).mapInArrow(run, "lang string, v array<double>")
    rows = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    out: dict[str, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["lang"], np.zeros(dims + 1))[r["i"]] = r["x"]
    return {n: v[:-1] for n, v in sorted(out.items())}, {n: float(v[-1]) for n, v in out.items()}


def prototypes(docs: DataFrame, text: str = "text", lang: str = "lang", dims: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The bundle of all texts of each language: a sum of trigram vectors."""
    return profiles(docs, text, lang, dims)[0]


def identify(docs: DataFrame, learned: dict[str, np.ndarray], text: str = "text", keep: list[str] | None = None, trigrams: dict[str, float] | None = None) -> DataFrame:
    """docs plus lang_pred and score, the cosine of the document's bundle and the prototype nearest
    to it, at least 0.

    Only the text is looked at. A null text, one without letters, or an empty set of prototypes
    gives "und" and 0. With trigrams, the counts of profiles, there is typical as well: how often the
    language has the text's trigrams, on average, as a share of how often it has its own; about 1 for
    texts of the language at any length, about 0 for others. Ties go to the language first in order. Input columns with the name of a
    result are replaced.
    """
    names = list(learned)
    dims = len(next(iter(learned.values()))) if names else 1
    pulls = [(trigrams or {}).get(n, 0.0) / (np.linalg.norm(v) or 1.0) for n, v in learned.items()]
    matrix = np.stack([v / (np.linalg.norm(v) or 1.0) for v in learned.values()]).astype(np.float32) if names else None

    def start():
        def work(texts):
            texts = texts.to_pylist()
            bundles: dict[int, np.ndarray] = {}
            many = [0.0] * len(texts)
            typical = [0.0] * len(texts)
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)

            def close(i):
                v = bundles.pop(i)
                size = np.linalg.norm(v)
                if size > 0:
                    cosines = matrix @ v / size
                    best = int(cosines.argmax())
                    pred[i], score[i] = names[best], float(min(1.0, max(0.0, cosines[best])))
                    typical[i] = float(max(0.0, cosines[best]) * size / many[i] * pulls[best])

            if names:
                for piece in _chunks(texts):
                    rows, slices = _trigrams(piece)
                    for i in [i for i in bundles if i < rows[0]]:
                        close(i)
                    for counts, triples in slices:
                        sums, sizes = counts @ _bound(triples, dims), counts.sum(axis=1)
                        for k, i in enumerate(rows):
                            many[i] += float(sizes[k])
                            bundles[i] = bundles[i] + sums[k] if i in bundles else sums[k]
                for i in list(bundles):
                    close(i)
            found = [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            return found if trigrams is None else [*found, pa.array(typical, pa.float64())]

        return work

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if trigrams is not None:
        fields.append(T.StructField("typical", T.DoubleType()))
    return with_arrow_columns(docs, [text], fields, start, keep)


def held_out(key: str, parts: int, remainder: int) -> Column:
    """Whether the checksum of the id, as text, leaves this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts == remainder
