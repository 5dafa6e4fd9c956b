"""Key/value, list and hash tables kept as append-only logs with a sequence number.

Lists and hashes stay in row form (key, position or field, value): a key that holds a
large part of all rows never becomes one array or map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import with_position
from .windows import keep_last


def latest(log: DataFrame) -> DataFrame:
    """Current value of each key: the last write wins."""
    return keep_last(log, ["key"], "seq").select("key", "value")


def get(log: DataFrame, key) -> DataFrame:
    """Current value of one key; no row if it was never set."""
    return latest(log.filter(F.col("key") == F.lit(key)))


def list_items(log: DataFrame) -> DataFrame:
    """Items appended to each list, with their position from 0."""
    return with_position(log, ["key"], "seq").select("key", "pos", "item")


def list_range(log: DataFrame, start: int = 0, stop: int = -1) -> DataFrame:
    """Items start..stop of each list, both included; negative counts from the end."""
    above = max(start, 0)
    below = stop + 1 if stop >= 0 else None
    placed = with_position(log, ["key"], "seq", start=above, stop=below)
    if start < 0 or stop < -1:
        sizes = log.groupBy("key").agg(F.count(F.lit(1)).alias("_len"))
        placed = placed.join(sizes, "key")
    if start < 0:
        placed = placed.filter(F.col("pos") >= F.col("_len") + start)
    if stop < -1:
        placed = placed.filter(F.col("pos") <= F.col("_len") + stop)
    return placed.select("key", "pos", "item")


def hash_fields(log: DataFrame) -> DataFrame:
    """Current value of each field of each hash."""
    return keep_last(log, ["key", "field"], "seq").select("key", "field", "value")


def hash_get_all(log: DataFrame, key) -> DataFrame:
    """All fields of one hash."""
    return hash_fields(log.filter(F.col("key") == F.lit(key))).select("field", "value")
