"""Logs with snapshots: what is known of a key is in one bucket and the log's tail.

A log is appended in numbered segments, ``log/segment=<n>/``. ``compact`` folds a log's segments into a
snapshot, dealt into buckets by key, and marks the last segment that is in it. Readers fold the snapshot and the
segments behind the mark. ``last_writes`` folds to the last write of each key: one that comes late, with a
smaller sequence number than the snapshot's, is in a later segment, and sequence numbers decide, whichever
came first. Any fold will do that gives the same for parts folded first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..sources.versions import exists
from .buckets import BUCKETS, BucketedTable, nullable
from .windows import keep_last

_MARK = "snapshot long, segment long"


def last_writes(keys: Sequence[str] = ("key",), seq: str = "seq") -> Callable[[DataFrame], DataFrame]:
    """The fold that keeps the row of each key with the largest sequence number."""
    return lambda rows: keep_last(rows, list(keys), seq)


class SnapshotLog:
    """A log of rows with ``schema``; ``key`` says where rows are kept, ``fold`` what is kept of them."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        fold: Callable[[DataFrame], DataFrame] | None = None,
        key: str = "key",
        buckets: int = BUCKETS,
    ):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), nullable(schema), key
        self.fold = last_writes() if fold is None else fold
        self.snapshot = BucketedTable(spark, f"{self.root}/snapshot", key, schema, buckets)

    def _log(self) -> DataFrame:
        path = f"{self.root}/log"
        fields = StructType([*self.schema.fields]).add("segment", LongType())
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(path)

    def last_segment(self) -> int:
        """The newest segment; 0 for none. Folders are listed, rows aren't read."""
        return self._log().agg(F.max("segment")).first()[0] or 0

    def append(self, rows: DataFrame, segment: int | None = None) -> int:
        """Append a segment; the same number again replaces it, so that a repeated batch counts once."""
        segment = self.last_segment() + 1 if segment is None else segment
        fields = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema]
        rows.select(*fields).write.mode("overwrite").parquet(f"{self.root}/log/segment={segment}")
        return segment

    def mark(self) -> tuple[int, int]:
        """The newest snapshot and the last segment that is in it; zeros for none."""
        path = f"{self.root}/marks"
        if not exists(self.spark, path):
            return 0, 0
        found = self.spark.read.schema(_MARK).parquet(path).agg(F.max(F.struct("segment", "snapshot")).alias("m")).first()["m"]
        return (found["snapshot"], found["segment"]) if found else (0, 0)

    def _tail(self, behind: int) -> DataFrame:
        return self._log().filter(F.col("segment") > behind).drop("segment")

    def compact(self) -> int:
        """Fold the tail into a new snapshot: only buckets with a key of the tail are rewritten."""
        snapshot, behind = self.mark()
        newest = self.last_segment()
        if newest == behind:
            return snapshot
        tail = self._log().filter((F.col("segment") > behind) & (F.col("segment") <= newest)).drop("segment")
        if snapshot == 0:
            version = self.snapshot.create(self.fold(tail))
        else:
            version = self.snapshot.change(tail, lambda rows, new: self.fold(rows.unionByName(new)), base=snapshot)
        # The mark is the commit: a snapshot without one is never read.
        done = self.spark.createDataFrame([(version, newest)], _MARK)
        done.coalesce(1).write.mode("append").parquet(f"{self.root}/marks")
        return version

    def latest(self) -> DataFrame:
        """Snapshot and tail, folded."""
        snapshot, behind = self.mark()
        rows = self.snapshot.read(snapshot) if snapshot else self.spark.createDataFrame([], self.schema)
        return self.fold(rows.unionByName(self._tail(behind)))

    def get(self, key) -> DataFrame:
        """What is kept under one key: one bucket of the snapshot and the tail are read."""
        snapshot, behind = self.mark()
        literal = F.lit(key).cast(self.schema[self.key].dataType)
        tail = self._tail(behind).filter(F.col(self.key) == literal)
        rows = self.snapshot.get(key, snapshot).unionByName(tail) if snapshot else tail
        return self.fold(rows)
