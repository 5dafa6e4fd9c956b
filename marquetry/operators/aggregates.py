"""Grouped and global aggregates. All combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import SCALE, exact, exact_avg
from ..functions.presence import all_present
from .ordering import top_k


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_labels(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def group_count(df: DataFrame, *keys: str, name: str = "total") -> DataFrame:
    """Rows per key; rows without a key are left out."""
    return df.filter(all_present(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_mean(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "mean", places: int = 2
) -> DataFrame:
    """Mean per group, highest first; rows without a key are left out."""
    keyed = df.filter(all_present(*keys))
    return (
        keyed.groupBy(*keys)
        .agg(exact_avg(F.col(value), places).alias(name))
        .orderBy(F.desc_nulls_last(name), *keys)
    )


def group_totals(df: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in measures.items()])


def global_mean(
    df: DataFrame, value: str, name: str = "mean", places: int = 2
) -> DataFrame:
    return df.agg(exact_avg(F.col(value), places).alias(name))


def extreme_row(
    df: DataFrame, value: str, key: str, largest: bool = True
) -> DataFrame:
    """The row with the largest (smallest) value; the first key wins a tie."""
    return top_k(df.filter(F.col(value).isNotNull()), value, key, 1, ascending=not largest)


def extreme_groups(df: DataFrame, group: str, value: str) -> DataFrame:
    """The group with the highest and the one with the lowest mean."""
    means = group_mean(df, [group], value)
    return (
        top_k(means, "mean", group, 1)
        .withColumn("which", F.lit("highest"))
        .unionByName(
            top_k(means, "mean", group, 1, ascending=True).withColumn("which", F.lit("lowest"))
        )
    )


def share_of_total(
    df: DataFrame, keys: Sequence[str], value: str, scale: int = SCALE
) -> DataFrame:
    """Sum per group and its share of all groups in percent; ``scale`` decimals are summed.

    The whole is summed from the groups, which Spark computes once for both.
    """
    sums = df.groupBy(*keys).agg(F.sum(exact(F.col(value), scale)).alias("_total"))
    whole = sums.agg(F.sum("_total").cast("double")).scalar()
    total = F.coalesce(F.col("_total").cast("double"), F.lit(0.0))
    share = F.when(whole > 0, total / whole * 100).otherwise(0.0)
    return sums.select(*keys, total.alias("total"), F.round(share, 1).alias("share"))


def profile(df: DataFrame) -> DataFrame:
    """Rows, columns, cells and column types as one row."""
    types = ", ".join(f"{name}:{dtype}" for name, dtype in df.dtypes)
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("rows"),
        F.lit(len(df.columns)).alias("cols"),
        (n * len(df.columns)).alias("size"),
        F.lit(types).alias("dtypes"),
    )


def unique_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Each combination of the keys once."""
    return df.select(*keys).distinct()
