"""Generated identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*parts: Column) -> Column:
    """16 hex digits derived from the row, so that a task re-run gives the same id."""
    return F.substring(F.sha2(F.concat_ws("-", *[p.cast("string") for p in parts]), 256), 1, 16)
