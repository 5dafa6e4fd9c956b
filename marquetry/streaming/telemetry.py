"""Sensor readings: decode, and set bad ones aside without stopping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.signals import accel_g, gyro_dps, is_byte, signed_word
from ..schemas import AXES, SENSOR_RAW
from .runner import to_files


def sensor_stream(
    spark: SparkSession, path: str, schema: StructType = SENSOR_RAW, fmt: str = "parquet", **options
) -> DataFrame:
    """Stream of landed register readings."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def readings_from_json(
    stream: DataFrame, schema: StructType = SENSOR_RAW, column: str = "value"
) -> DataFrame:
    """Readings from JSON text, such as the value of a message queue record.

    A text that is no reading gives a row of NULLs, which ``decode`` rejects.
    """
    text = F.col(column).cast("string")
    return stream.select(F.from_json(text, schema).alias("_r")).select("_r.*")


def decode_to_files(
    spark: SparkSession, source: str, out: str, checkpoint: str, every: str = "1 second"
) -> StreamingQuery:
    """Decode landed readings for as long as the query runs, one folder per status."""
    return to_files(decode(sensor_stream(spark, source)), out, checkpoint, ["status"], every)


def decode_to_sinks(
    decoded: DataFrame, out: str, checkpoint: str, every: str | None = None, mark: str = "readings"
) -> StreamingQuery:
    """Decoded readings to ``out/readings`` and bad ones to ``out/rejects``, both while the query runs.

    Each micro-batch has a folder of its own in both, named by its number. A batch that was broken off between
    the two is replayed under the same number and replaces what it had written, so every reading is in one
    of the sinks, once. How many went where is in the query's progress under ``mark``. ``every`` sets
    how much is in a file. Without it the query works through what is there and stops.
    """
    bad = F.col("status") == "rejected"
    counted = decoded.observe(mark, F.count_if(~bad).alias("ok"), F.count_if(bad).alias("rejected"))

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            for status, sink, fmt in (("rejected", "rejects", "json"), ("ok", "readings", "parquet")):
                rows = held.filter(F.col("status") == status).drop("status")
                rows.write.mode("overwrite").format(fmt).save(f"{out}/{sink}/batch={number}")
        finally:
            held.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return counted.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()


def read_sink(spark: SparkSession, out: str, sink: str, schema: StructType) -> DataFrame:
    """What ``decode_to_sinks`` has written to ``readings`` or ``rejects``; ``schema`` is that of ``decode``."""
    fields = StructType([f for f in schema.fields if f.name != "status"])
    fmt = "json" if sink == "rejects" else "parquet"
    return spark.read.schema(fields).format(fmt).load(f"{out}/{sink}/*")


def decode(readings: DataFrame) -> DataFrame:
    """Registers to g and degrees per second. Batch and streaming frames alike.

    ``status`` is ``rejected`` for a reading with a missing or impossible byte; its
    measures are NULL and ``reason`` names the first bad register.
    """
    registers = [f"{axis}_{half}" for axis in AXES for half in ("h", "l")]
    reason = F.coalesce(*[F.when(~is_byte(F.col(r)), F.lit(r)) for r in registers])
    ok = reduce(lambda a, b: a & b, [is_byte(F.col(r)) for r in registers])
    measures = {}
    for axis in AXES:
        word = signed_word(F.col(f"{axis}_h"), F.col(f"{axis}_l"))
        scaled = accel_g(word) if axis.startswith("a") else gyro_dps(word)
        measures[axis] = F.when(ok, scaled)
    decoded = readings.withColumns(
        {
            **measures,
            "status": F.when(ok, "ok").otherwise("rejected"),
            "reason": reason,
        }
    )
    return decoded.drop(*registers)
