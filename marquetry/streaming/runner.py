"""Run a stream to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def to_files(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once across restarts.

    Without ``every`` it works through what is there and stops.
    """
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start(out)


def run_available(
    spark: SparkSession, stream: DataFrame, base: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Work through the available input below ``base`` and read the output back."""
    out = f"{base}/data"
    schema = stream.schema
    to_files(stream, out, f"{base}/checkpoint", partition_by).awaitTermination()
    return spark.read.schema(schema).parquet(out)
