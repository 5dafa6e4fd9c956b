"""Sorts and top-k. A tie always goes to the smaller key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_by(df: DataFrame, *columns: str) -> DataFrame:
    """Sort; a leading ``-`` means descending, with NULL last."""
    return df.orderBy(
        *[F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc(c) for c in columns]
    )


def top_k(
    df: DataFrame, value: str, key: str | list[str], k: int, ascending: bool = False
) -> DataFrame:
    """The k rows with the largest (smallest) value. Plans as one top-k, not a full sort."""
    keys = [key] if isinstance(key, str) else list(key)
    order = F.asc_nulls_last(value) if ascending else F.desc_nulls_last(value)
    return df.orderBy(order, *keys).limit(k)


def most_common(df: DataFrame, column: str, k: int, name: str = "total") -> DataFrame:
    """The k most frequent labels with their counts; NULL is not a label."""
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    )
    return top_k(counts, name, column, k)


def most_common_by_label(df: DataFrame, column: str, k: int, name: str = "total") -> DataFrame:
    """``most_common``, in label order and with the label as text."""
    return (
        most_common(df, column, k, name)
        .orderBy(column)
        .withColumn(column, F.col(column).cast("string"))
    )
