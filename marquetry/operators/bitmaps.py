"""Referential checks by bitmaps of ids: facts are tested where they are, none is shuffled.

The whole-number keys of a parent become one bitmap for each 32,768 neighbouring ids, one row a bitmap. Facts
find their bitmap by its number and test one bit. The bitmaps are broadcast, so their size is counted first:
beyond ``MOST_BYTES``, as with sparse ids, and for keys that aren't whole numbers, the plain joins of ``joins``
do the same work. An id that is NULL is unknown; repeated parents count once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import joins

#: Bytes of bitmaps that may be broadcast for one parent.
MOST_BYTES = 64 << 20
_BITMAP_BYTES = 4096
_WORDS = _BITMAP_BYTES // 8


def fits(parent: DataFrame, key: str, most_bytes: int = MOST_BYTES) -> bool:
    """Whether the bitmaps of ``parent``'s ids take ``most_bytes`` at most. Only the key is read."""
    if not isinstance(parent.schema[key].dataType, IntegralType):
        return False
    numbers = parent.filter(F.col(key).isNotNull()).select(F.bitmap_bucket_number(key).alias("bucket"))
    return numbers.distinct().count() * _BITMAP_BYTES <= most_bytes


def id_bitmaps(parent: DataFrame, key: str) -> DataFrame:
    """(bucket, words): the ids of ``parent`` as bits of 64-bit words, a row for 32,768 neighbours."""
    dealt = parent.filter(F.col(key).isNotNull()).select(
        F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("bit")
    )
    built = dealt.groupBy("bucket").agg(F.hex(F.bitmap_construct_agg("bit")).alias("digits"))
    words = F.transform(
        F.sequence(F.lit(0), F.lit(_WORDS - 1)),
        lambda i: F.conv(F.substring(F.col("digits"), i * 16 + 1, F.lit(16)), 16, -10).cast("long"),
    )
    return built.select("bucket", words.alias("words"))


def _is_set(words: Column, key: Column) -> Column:
    """Whether the bit of ``key`` is set. Within a word the first byte is the highest."""
    bit = F.bitmap_bit_position(key)
    byte = F.shiftright(bit, 3)
    place = ((F.lit(7) - byte % 8) * 8 + bit % 8).cast("int")
    word = F.get(words, F.shiftright(bit, 6).cast("int"))
    return F.coalesce(F.call_function("bit_get", word, place) == 1, F.lit(False))


def with_known(df: DataFrame, parent: DataFrame, key: str, name: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``df`` with a column ``name``: whether ``parent`` has the row's ``key``."""
    if not fits(parent, key, most_bytes) or not isinstance(df.schema[key].dataType, IntegralType):
        known = parent.select(key).distinct().withColumn(name, F.lit(True))
        return df.join(known, key, "left").withColumn(name, F.coalesce(name, F.lit(False))).select(*df.columns, name)
    bits = id_bitmaps(parent, key).select(F.col("bucket").alias("_bucket"), F.col("words").alias("_words"))
    joined = df.withColumn("_number", F.bitmap_bucket_number(key)).join(
        F.broadcast(bits), F.col("_number") == F.col("_bucket"), "left"
    )
    return joined.select(*df.columns, _is_set(F.col("_words"), F.col(key)).alias(name))


def keep_with_parents(
    df: DataFrame, parents: Sequence[tuple[DataFrame, str]], most_bytes: int = MOST_BYTES
) -> DataFrame:
    """Rows whose keys all exist in their parent frames."""
    for parent, key in parents:
        if fits(parent, key, most_bytes):
            df = with_known(df, parent, key, "_known", most_bytes).filter("_known").drop("_known")
        else:
            df = joins.keep_with_parents(df, [(parent, key)])
    return df


def orphans(df: DataFrame, parent: DataFrame, key: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Rows whose key does not exist in the parent frame."""
    if not fits(parent, key, most_bytes):
        return joins.orphans(df, parent, key)
    return with_known(df, parent, key, "_known", most_bytes).filter(~F.col("_known")).drop("_known")


def orphan_report(
    df: DataFrame, parents: Sequence[tuple[DataFrame, str]], most_bytes: int = MOST_BYTES
) -> DataFrame:
    """Rows by the first parent that lacks them, ``none`` for rows with all: one pass over ``df``."""
    if not all(fits(parent, key, most_bytes) for parent, key in parents):
        return joins.orphan_report(df, parents)
    missing = F.lit("none")
    for i, (parent, key) in reversed(list(enumerate(parents))):
        df = with_known(df, parent, key, f"_known{i}", most_bytes)
        missing = F.when(~F.col(f"_known{i}"), F.lit(key)).otherwise(missing)
    return df.groupBy(missing.alias("missing")).agg(F.count(F.lit(1)).alias("rows"))
