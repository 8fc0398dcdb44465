"""Landing files of nested orders: scan, bulk load, business-day extract."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import clock
from turnstile.functions.fixed import ZONE
from turnstile.sources import schema as S


#: Holds the text of a line that is no document of the schema.
CORRUPT = "_corrupt_record"


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file): the lines of all files under a path that hold more than blanks."""
    files = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    return files.filter(F.col("line").rlike(r"\S"))


def _parsed(lines: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """lines plus the fields of their documents, and CORRUPT where a line is none.

    One amount, date or bracket out of form makes the whole line corrupt: half a document must not
    count as one. The generator keeps Catalyst from parsing once for each use of a field.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    none = F.from_json(F.lit("{}"), whole, options).withField(CORRUPT, F.col(column))  # no object at all
    document = F.coalesce(F.from_json(F.col(column), whole, options), none)
    return lines.select(*lines.columns, F.inline(F.array(document)))


def parse_documents(lines: DataFrame, column: str, schema: T.StructType = S.RAW) -> DataFrame:
    """Order documents from a text column; keys outside the schema are dropped, and so are lines that
    are no document (see rejected)."""
    return _parsed(lines.select(column), column, schema).filter(F.col(CORRUPT).isNull()).select(*schema.names)


def rejected(lines: DataFrame, column: str, schema: T.StructType = S.RAW) -> DataFrame:
    """The rows whose text is no document of the schema."""
    known = lines.select(F.struct("*").alias("_row"), F.col(column).alias("_line"))
    return _parsed(known, "_line", schema).filter(F.col(CORRUPT).isNotNull()).select("_row.*")


def raw_scan(spark: SparkSession, path: str, schema: T.StructType = S.RAW) -> DataFrame:
    """The same from JSON lines under a path, so that a document reads alike from file and from text."""
    return parse_documents(json_lines(spark, path), "line", schema)


def raw_table(spark: SparkSession, path: str, fields: Iterable[str] | None = None) -> DataFrame:
    """Landed Parquet, reading only the named nested leaves."""
    return spark.read.schema(S.narrow(S.RAW, fields) if fields else S.RAW).parquet(path)


def backfill_load(spark: SparkSession, source: str, target: str, rejects: str | None = None) -> DataFrame:
    """Replace the landing table by all JSON lines under a folder.

    Lines that are no document replace the table of rejects (line, file), beside the target unless
    named. They are counted while the documents are written, and read again only where there are any.
    """
    lines = json_lines(spark, source)
    seen = Observation("landing")
    parsed = _parsed(lines.select("line"), "line", S.RAW).observe(seen, F.count(CORRUPT).alias("bad"))
    parsed.filter(F.col(CORRUPT).isNull()).select(*S.RAW.names).write.mode("overwrite").parquet(target)
    bad = rejected(lines, "line") if seen.get["bad"] else spark.createDataFrame([], lines.schema)
    bad.write.mode("overwrite").parquet(rejects or f"{target.rstrip('/')}_rejects")
    return raw_table(spark, target)


def extract_window(
    raw: DataFrame, start: str | dt.date, end: str | dt.date, zone: str = ZONE
) -> DataFrame:
    """Orders created on the local days start to end, both included."""
    after = clock.as_date(end) + dt.timedelta(days=1)
    return raw.filter(clock.on_local_days(F.col("createdDate"), start, after, zone))


def yesterday(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """The window of the daily run."""
    day = as_of - dt.timedelta(days=1)
    return day, day
