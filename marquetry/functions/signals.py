"""Decoding of two-byte sensor registers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw counts per g and per degree per second.
COUNTS_PER_G = 16384.0
COUNTS_PER_DPS = 131.0


def signed_word(high: Column, low: Column) -> Column:
    """Signed 16-bit number from its high and low byte."""
    word = high * 256 + low
    return F.when(word > 32767, word - 65536).otherwise(word)


def accel_g(word: Column) -> Column:
    return F.round(word / F.lit(COUNTS_PER_G), 2)


def gyro_dps(word: Column) -> Column:
    return F.round(word / F.lit(COUNTS_PER_DPS), 2)


def is_byte(c: Column) -> Column:
    """False for NULL as well as for a value outside 0..255."""
    return F.coalesce(c.between(0, 255), F.lit(False))
