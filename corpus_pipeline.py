"""A training corpus from documents, stage by stage; each stage is one operator of turnstile.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.decontaminate import contamination
from turnstile.llm.jaccard import near_duplicates
from turnstile.llm.language import DIMENSIONS, UNKNOWN, identify, profiles
from turnstile.llm.mix import mixed, range_sorted
from turnstile.llm.queries import SHARDS
from turnstile.llm.shard import hilbert_shards
from turnstile.llm.staging import ready, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Two standard deviations of the cosine of unrelated vectors: one trigram over and over stays below.
LEAST_SCORE = 2 * DIMENSIONS**-0.5
#: Trigrams a quarter as usual as the language's own. At sf0.1, 3,000 held-out documents have 0.33 or
#: more; letter junk of 50 words and other scripts 0.27 or less, of 200 words 0.17 or less.
LEAST_TYPICAL = 0.25
#: Texts of fewer characters can't be told from junk so surely: one standard deviation must do.
SHORT = 40


def own_columns(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; those without letters or like none of them go.

    The cosine alone says little: it falls with the length of clean texts, and letter junk shares
    some trigrams with any language. What is asked is how usual the trigrams are on average."""
    learned, trigrams = profiles(docs)
    near = (F.col("score") >= LEAST_SCORE) & (F.col("typical") >= LEAST_TYPICAL)
    near = near | ((F.length("text") < SHORT) & (F.col("score") >= LEAST_SCORE / 2))
    kept = identify(docs, learned, trigrams=trigrams).filter((F.col("lang_pred") != UNKNOWN) & near)
    return own_columns(kept)


def _digest(name: str):
    """The value's SHA-256, empty text for null."""
    return F.coalesce(F.sha2(F.col(name).cast("string").cast("binary"), 256), F.lit(""))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that links hold together, one row: the one with the smallest id (null ids last),
    then the smallest digest of the rest, so that reruns agree.

    A row is known by id and content, not by id alone: rows without id, and rows of one id with
    different texts, stay unless they are copies of another. Rows without words are copies only
    of rows equal in all columns."""
    no_id = F.col("doc_id").isNull()
    rest = F.sha2(F.concat_ws("\n", *[_digest(c) for c in COLUMNS if c != "doc_id"], *[F.col(c).isNull().cast("string") for c in COLUMNS]), 256)
    named = docs.withColumn("_row", F.struct(no_id.alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), rest.alias("digest")))
    groups = near_duplicates(named.select("_row", "text"), "_row")
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_row")).distinct()
    return own_columns(named.join(kept, "_row", "left_semi").dropDuplicates(["_row"]))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return own_columns(contamination(docs, items).filter(~F.col("contaminated")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, whole: twice where the mix takes them twice, gone where it has no room."""
    return own_columns(range_sorted(mixed(docs, whole=True)))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with its shard and its slot there."""
    return hilbert_shards(docs, SHARDS)


def _stage(work):
    """The stage on a session ready for it."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return work(ready(spark), docs, sf_dir)

    run_stage.__name__, run_stage.__doc__ = work.__name__, work.__doc__
    return run_stage


STAGES = [
    ("language id", _stage(language_id)),
    ("near copies", _stage(near_copies)),
    ("benchmark free", _stage(benchmark_free)),
    ("mix sources", _stage(mix_sources)),
    ("shard", _stage(shard)),
]

#: SQL can't express language ID by random vectors; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
