"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Business days are computed with from_utc_timestamp, which is right only when
# the session itself renders instants in UTC. Money fills Spark's 38 digits: sums and
# products keep its nine decimals, and one that does not fit stops the job; with the
# third setting at its default Spark would drop decimals instead.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
}

# HotSpot never compiles a method above 8,000 bytes of bytecode. Wide nested
# projections exceed that; with this limit Spark gives such a stage split-up
# functions, which do get compiled (five times faster on full line documents).
#
# A hot key is split even where that costs a shuffle later on: without the second
# setting Spark keeps one huge task when the next operator wants the same key.
TUNING = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results or code generation; sizing is the cluster's."""
    for key, value in {**REQUIRED, **TUNING}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate files: the one the cluster names. Where none is named, a local
    session gets a scratch folder, and a cluster an error: its executors do not share a machine's disk."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="turnstile-"))
    return context.getCheckpointDir()


def staged(df: DataFrame) -> DataFrame:
    """Compute once and keep in the work folder, for plans that read it often.

    A lost executor costs nothing but a re-read.
    """
    work_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go as soon as it is done. Else they stay until the driver happens
    to collect its garbage, and a job of several writes needs the disk for all of them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "turnstile") -> SparkSession:
    """Single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.turnstile.spread", str(cores) if str(cores).isdigit() else "0")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
