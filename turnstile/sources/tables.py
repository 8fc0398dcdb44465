"""Stored tables: partitioned by a bucket of their key, so a merge rewrites few of them.

Parquet has no row-level merge, and Spark cannot overwrite the folder it reads. A
table lives in ``bucket=<b>/v=<n>`` folders. The bucket is a function of the match
key, so a batch can only meet rows of its own buckets: a load reads and rewrites
those and leaves the rest alone, whatever the size of the table. A load becomes
visible as a whole when its number is published; a load that died half-way never is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.session import shuffles_go

Bucket = Callable[[], Column]
NO_BUCKET = "none"


def by_number(column: str, width: int) -> Bucket:
    """Ranges of a growing number: new orders share the newest buckets."""
    return lambda: F.coalesce(F.floor(F.col(column) / width).cast("string"), F.lit(NO_BUCKET))


def by_month(column: str) -> Bucket:
    return lambda: F.coalesce(F.date_format(column, "yyyy-MM"), F.lit(NO_BUCKET))


class StoredTable:
    """One table under ``root/name``; works on any Hadoop file system.

    ``appends`` tables only ever gain rows: every published folder counts. For the
    others the newest published folder of a bucket holds all its rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        schema: T.StructType,
        bucket: Bucket,
        appends: bool = False,
    ):
        self.spark, self.schema, self.bucket, self.appends = spark, schema, bucket, appends
        self.home = f"{root.rstrip('/')}/{name}"

    def listed(self, pattern: str) -> list[str]:
        """Paths that match, anywhere on the table's file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().toString() for s in fs.globStatus(path) or []]

    def _folders(self) -> list[tuple[str, int, str]]:
        """(bucket, load number, path) of everything on disk, published or not."""
        found = []
        for path in self.listed(f"{self.home}/bucket=*/v=*"):
            bucket, number = path.split("/")[-2:]
            found.append((bucket.removeprefix("bucket="), int(number.removeprefix("v=")), path))
        return found

    def loads(self) -> list[int]:
        """Numbers of the published loads."""
        return sorted(int(p.rsplit("/", 1)[1]) for p in self.listed(f"{self.home}/_published/*"))

    def read(
        self,
        schema: T.StructType | None = None,
        buckets: Collection[str] | None = None,
        loads: Collection[int] | None = None,
    ) -> DataFrame:
        """The table, or the named buckets or loads of it, with the full or a narrowed schema."""
        schema, published = schema or self.schema, set(self.loads() if loads is None else loads)
        newest: dict[str, tuple[int, str]] = {}
        every: list[str] = []
        for bucket, number, path in self._folders():
            if number in published and (buckets is None or bucket in buckets):
                every.append(path)
                newest[bucket] = max(newest.get(bucket, (0, "")), (number, path))
        paths = every if self.appends else [path for _, path in newest.values()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def buckets(self, rows: DataFrame) -> set[str]:
        """Buckets that rows of this table fall in: never more than the table has."""
        return {r.bucket for r in rows.select(self.bucket().alias("bucket")).distinct().collect()}

    def write(self, *frames: DataFrame) -> None:
        """Store rows as the next load: whole buckets, or additions to an ``appends`` table.

        Rebalancing lets Spark split a bucket that holds most rows and join small ones.
        Several frames are parts of one load: they are written one after the other, so
        that the disk holds the shuffle files of one.
        """
        number = max([n for _, n, _ in self._folders()] + self.loads(), default=0) + 1
        for rows in frames:
            with shuffles_go(self.spark):
                (
                    rows.select(*self.schema.names, self.bucket().alias("bucket"), F.lit(number).alias("v"))
                    .hint("rebalance", "bucket")
                    .write.mode("append")
                    .partitionBy("bucket", "v")
                    .parquet(self.home)
                )
        self.touch(f"{self.home}/_published/{number}")

    def touch(self, name: str) -> None:
        """Make an empty file: the sign that a load is whole."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True).close()


def audit_rows(report: DataFrame, table_name: str, now: dt.datetime) -> DataFrame:
    return report.select(
        F.lit(now).alias("audit_timestamp"),
        F.lit(table_name).alias("table_name"),
        "severity",
        "test_name",
        "result_json",
    )


AUDIT = T.StructType(
    [T.StructField("audit_timestamp", T.TimestampType())]
    + [T.StructField(n, T.StringType()) for n in ("table_name", "severity", "test_name", "result_json", "run")]
)


def _run(now: dt.datetime) -> str:
    return now.astimezone(dt.timezone.utc).strftime("%Y%m%dT%H%M%S.%f")


def audit_append(report: DataFrame, table_name: str, path: str, now: dt.datetime) -> None:
    """Add a report to the audit log, a folder for each table and run: done again, it replaces its own rows."""
    rows = audit_rows(report, table_name, now).withColumn("run", F.lit(_run(now)))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table_name", "run")
        .parquet(path)
    )


def audit_log(spark: SparkSession, path: str, table_name: str | None = None, now: dt.datetime | None = None) -> DataFrame:
    """The stored reports, or those of one table or run; only their folders are read."""
    log = spark.read.schema(AUDIT).parquet(path)
    if table_name is not None:
        log = log.filter(F.col("table_name") == table_name)
    if now is not None:
        log = log.filter(F.col("run") == _run(now))
    return log.select(*AUDIT.names[:-1])
