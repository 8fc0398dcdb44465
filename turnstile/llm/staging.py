"""Intermediate tables in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch between Spark and Python: texts can be long, and both sides hold a batch at once.
BATCH_ROWS = 1024

_written: dict[str, SparkSession] = {}
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a scratch folder of our own only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="turnstile-llm-")
    return _own[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet; release() removes it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and fixes whatever a retried task could do
    otherwise (numbers of range partitions). Compressed and columnar, unlike a checkpoint.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_alone(df: DataFrame, label: str = "stage") -> DataFrame:
    """As staged(), for a df that is not run again: its shuffle files go as soon as it is written."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return staged(df, label)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def discard(df: DataFrame) -> None:
    """Remove the table that staged() gave, once nothing reads it."""
    spark = df.sparkSession
    folders = {name.split("/")[-2] for name in df.inputFiles()}
    for path in [p for p in _written if p.rsplit("/", 1)[1] in folders]:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        del _written[path]


def release(spark: SparkSession) -> None:
    """Remove all staged tables of this session's driver; call once results are saved."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in list(_written):
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(conf).delete(hadoop, True)
        del _written[path]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, its Python workers able to import this package from
    where the driver has it. A cluster without that folder needs the package installed."""
    import os

    from turnstile.session import prepare

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return prepare(spark)
