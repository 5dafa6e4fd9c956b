"""Keyed tallies of a stream: first rows, copies and corrections of every key are known while it runs.

Each micro-batch is reduced to one row for each key that it met, appended to a log under the batch's number,
so that a replayed batch replaces its own rows, and folded into a bucketed snapshot from time to time. Rows of
a key from several batches add up to what the same reduction gives over all input at once, and so do the
counters made of them. What is known of all keys is a table: no executor holds it in memory, and
it outlives the query. (A stateful aggregation of the stream could not tell lines of a file apart: line
numbers are there within a micro-batch alone.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.buckets import BUCKETS
from ..operators.snapshots import SnapshotLog
from ..plans.production import Fold
from ..sources.readers import parse_batch

#: Micro-batches between two snapshots.
COMPACT_EVERY = 100
_GROUP = "_group"


class Tallies:
    """Tallies below ``root`` of JSON lines with ``schema``, reduced by ``fold``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, fold: Fold, buckets: int = BUCKETS):
        self.schema, self.fold, self.root = schema, fold, root.rstrip("/")
        lines = spark.createDataFrame([], "value string, _file string, _split long")
        self.fields = fold.partial(parse_batch(lines, schema)).schema
        # Rows are dealt by all keys: rejected lines have no id, and many rows would share a bucket.
        kept = StructType([StructField(_GROUP, LongType()), *self.fields.fields])
        self.log = SnapshotLog(spark, f"{self.root}/tallies", kept, self._merged, _GROUP, buckets)

    def _merged(self, rows: DataFrame) -> DataFrame:
        merged = self.fold.merge(rows)
        return merged.withColumn(_GROUP, F.xxhash64(*self.fold.keys)).select(_GROUP, *merged.columns)

    def append(self, lines: DataFrame, batch: int) -> None:
        """The rows of a micro-batch of ``readers.stream_lines``."""
        partial = self.fold.partial(parse_batch(lines, self.schema))
        self.log.append(partial.withColumn(_GROUP, F.xxhash64(*self.fold.keys)), batch + 1)

    def current(self) -> DataFrame:
        """What is known of all keys, also while the stream runs: the frame that ``fold`` gives for all lines so far."""
        return self.fold.finish(self.log.latest().drop(_GROUP))

    def start(
        self,
        lines: DataFrame,
        every: str | None = None,
        compact_every: int = COMPACT_EVERY,
        after: Callable[[int], None] | None = None,
    ) -> StreamingQuery:
        """Keep the tallies of ``readers.stream_lines``; ``after`` is called with a batch's number once it is in.

        Without ``every`` it works through what is there and stops.
        """

        def add(rows: DataFrame, batch: int) -> None:
            self.append(rows, batch)
            if (batch + 1) % compact_every == 0:
                self.log.compact()
            if after is not None:
                after(batch)

        trigger = {"processingTime": every} if every else {"availableNow": True}
        writer = lines.writeStream.option("checkpointLocation", f"{self.root}/checkpoint")
        return writer.foreachBatch(add).trigger(**trigger).start()
