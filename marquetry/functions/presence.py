"""Tests for missing values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(*columns: str) -> Column:
    """True where no column is NULL; plain null checks, which scans take as filters."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def active_positive(active: str, value: str) -> Column:
    """True for entries that are switched on and have a positive value."""
    return (F.col(active) == 1) & (F.col(value) > 0)


def any_missing(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
