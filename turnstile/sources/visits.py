"""Admitted tickets of every stored version, flat and partitioned by visit month.

A headcount of some days needs the lines of those days, but documents are stored by order:
without this table each measure would unnest every version ever stored. Each load of versions
is flattened once; a measure then reads the months it asks for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.session import shuffles_go
from turnstile.sources import schema as S
from turnstile.sources.history import VERSION, of_newest
from turnstile.sources.tables import StoredTable

RANKED = (*VERSION, "ingestion_timestamp")
SCHEMA = T.StructType(
    [
        *[S.HISTORY[name] for name in RANKED],
        *S.record(
            visit_date=S.DAY, sales_office=S.TEXT, ticket_type=S.TEXT, quantity=S.LONG, amount=S.MONEY
        ),
    ]
)
_STORED = T.StructType([*SCHEMA.fields, *S.record(visit_month=S.TEXT, load=S.LONG)])
FIELDS = (*S.VISIT_FIELDS, "ingestion_timestamp")


class VisitTable:
    """``visit_month=<yyyy-MM>/load=<n>`` folders beside the table of versions.

    n is the number of the load of versions that the rows come from, so a load that
    is flattened again, because its job died, replaces its own rows. A load counts
    once it is marked; until then its rows are made from its documents when read.
    """

    def __init__(self, versions: StoredTable, flatten: Callable[[DataFrame], DataFrame]):
        self.versions, self.flatten, self.spark = versions, flatten, versions.spark
        self.home = f"{versions.home.rsplit('/', 1)[0]}/visits"

    def pending(self) -> list[int]:
        """Published loads of versions that are not flattened yet."""
        done = {int(p.rsplit("/", 1)[1]) for p in self.versions.listed(f"{self.home}/_fed/*")}
        return [n for n in self.versions.loads() if n not in done]

    def _documents(self, loads: Collection[int]) -> DataFrame:
        return self.versions.read(S.narrow(self.versions.schema, FIELDS), loads=loads)

    def feed(self) -> None:
        """Flatten what has been loaded since the last time."""
        for number in self.pending():
            month = F.date_format("visit_date", "yyyy-MM")
            rows = self.flatten(self._documents([number])).select(*SCHEMA.names, month.alias("visit_month"))
            with shuffles_go(self.spark):
                (
                    rows.withColumn("load", F.lit(number).cast("long"))
                    .hint("rebalance", "visit_month")
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("visit_month", "load")
                    .parquet(self.home)
                )
            self.versions.touch(f"{self.home}/_fed/{number}")

    def between(self, first: dt.date, last: dt.date, latest_only: bool = False) -> DataFrame:
        """Tickets of the days first to last; ``latest_only`` keeps those of each order's newest version.

        The newest versions are looked up among the stored versions of the orders in
        question: three columns, and only the buckets those orders fall in.
        """
        waiting = self.pending()
        rows = self.spark.createDataFrame([], SCHEMA)
        if self.versions.listed(f"{self.home}/visit_month=*"):
            months = F.col("visit_month").between(f"{first:%Y-%m}", f"{last:%Y-%m}")
            stored = self.spark.read.schema(_STORED).parquet(self.home).filter(months)
            rows = (stored.filter(~F.col("load").isin(waiting)) if waiting else stored).select(*SCHEMA.names)
        if waiting:
            rows = rows.unionByName(self.flatten(self._documents(waiting)).select(*SCHEMA.names))
        rows = rows.filter(F.col("visit_date").between(F.lit(first), F.lit(last)))
        if latest_only:
            held = self.versions.buckets(rows)
            rows = of_newest(rows, self.versions.read(S.narrow(self.versions.schema, RANKED), held))
        return rows
