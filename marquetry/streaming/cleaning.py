"""Continuous cleaning: duplicates, and references to fixed parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.presence import all_present
from ..functions.text import clean_text
from ..operators.joins import spread
from ..session import staged

SALTS = 16


def _salt(df: DataFrame, salts: int):
    """Part of a row, so that the rows of one key, equal ones too, spread over tasks."""
    return F.pmod(spread(df), F.lit(salts)).cast("int")


def drop_seen(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str | None = None,
    delay: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """First row of each key.

    Two steps: within the parts of a key, then across them, so that a hot key is already
    thinned to one row per part where its rows meet. With ``event_time`` and ``delay``
    the state is bounded: a key that returns later than ``delay`` counts as new. Without
    them it holds every key ever seen.
    """
    keys = list(keys)
    salted = stream.withColumn("_salt", _salt(stream, salts))
    if event_time is None:
        return salted.dropDuplicates([*keys, "_salt"]).dropDuplicates(keys).drop("_salt")
    return (
        salted.withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark([*keys, "_salt"])
        .dropDuplicatesWithinWatermark(keys)
        .drop("_salt")
    )


def clean_stream(
    stream: DataFrame, keys: Sequence[str], texts: Sequence[str], **seen
) -> DataFrame:
    """Require the keys, clean the texts, keep the first row of each key."""
    keyed = stream.filter(all_present(*keys))
    cleaned = keyed.withColumns({c: clean_text(F.col(c)) for c in texts})
    return drop_seen(cleaned, keys, **seen)


def prepared_parent(parent: DataFrame, key: str) -> DataFrame:
    """The parent's keys, each once, written before the stream begins.

    Micro-batches read this copy; the parent itself is read once.
    """
    return staged(parent.select(key).distinct(), "parent")


def with_parent(stream: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Streamed rows whose key the static parent has. The parent is read here, once."""
    return stream.join(prepared_parent(parent, key), key, "left_semi")


def without_parent(stream: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Streamed rows whose key the static parent lacks. The parent is read here, once."""
    return stream.join(prepared_parent(parent, key), key, "left_anti")
