"""Sums of a ledger kept up to date from its changes: figures never scan the ledger.

The ledger is a ``BucketedTable`` by id, the sums one by date: a row for each (date, type, category) with the
exact total and the number of rows. ``refresh`` compares the ledger's version with the one the sums stand for.
Only buckets that differ are read, as they were and as they are; their difference is merged into the days it
falls on. The mark that says which ledger version a version of the sums stands for is written before that
version, so a refresh that was broken off is done anew, and none counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import money
from ..operators.buckets import BUCKETS, BucketedTable
from ..sources.versions import exists

KEYS = ["date", "type", "category"]
_SCHEMA = "date date, type string, category string, total decimal(38,18), rows long"


def sums_of(ledger: DataFrame) -> DataFrame:
    """(date, type, category, total, rows) of ledger rows."""
    total = F.coalesce(F.sum(money(F.col("value"))), F.lit(0).cast("int")).cast("decimal(38,18)")
    return ledger.groupBy(*KEYS).agg(total.alias("total"), F.count(F.lit(1)).alias("rows"))


def _added(*sums: DataFrame) -> DataFrame:
    every = sums[0]
    for more in sums[1:]:
        every = every.unionByName(more)
    return every.groupBy(*KEYS).agg(F.sum("total").cast("decimal(38,18)").alias("total"), F.sum("rows").alias("rows"))


def _merge(kept: DataFrame, difference: DataFrame) -> DataFrame:
    """Sums with a difference added; what no row is left of goes."""
    return _added(kept, difference).filter("rows <> 0")


class LedgerSums:
    """The sums of ``ledger`` below ``root``. Versions of the ledger since the last refresh must still be there."""

    def __init__(self, spark: SparkSession, root: str, ledger: BucketedTable, buckets: int = BUCKETS):
        self.spark, self.root, self.ledger = spark, root.rstrip("/"), ledger
        schema = spark.createDataFrame([], _SCHEMA).schema
        self.sums = BucketedTable(spark, f"{self.root}/sums", "date", schema, buckets)

    def _mark(self, version: int) -> str:
        return f"{self.root}/marks/version={version}"

    def stands_for(self) -> int:
        """The ledger version that the newest sums are of; 0 for none."""
        path = self._mark(self.sums.version())
        return self.spark.read.schema("ledger long").parquet(path).first()[0] if exists(self.spark, path) else 0

    def refresh(self) -> int:
        """Take in all changes of the ledger; the ledger version that the sums now stand for."""
        old, new = self.stands_for(), self.ledger.version()
        if old == new:
            return new
        before, after = self.ledger.changed(old, new)
        gone = sums_of(before).withColumns({"total": -F.col("total"), "rows": -F.col("rows")})
        difference = _added(sums_of(after), gone).filter("rows <> 0 OR total <> 0")
        mark = self.spark.range(1).select(F.lit(new).cast("long").alias("ledger"))
        mark.coalesce(1).write.mode("overwrite").parquet(self._mark(self.sums.version() + 1))
        self.sums.change(difference, _merge)
        return new

    def as_ledger(self) -> DataFrame:
        """One row for each date, type and category, with its total: what the figures of ``ledger`` take as well."""
        return self.sums.read().select(*KEYS, F.col("total").alias("value"))
