"""Window operators: keep-first, growth, running sums and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.presence import all_present


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """One row per key: the first in ``order``, which must be a total order.

    Spark keeps one row per key and map task before it shuffles (a window group limit),
    so the copies of a hot key do not meet in one task.
    """
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(by)).filter("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return keep_first(df, keys, [F.desc(seq)])


def extreme_per_group(
    df: DataFrame, group: str, value: str, key: str, largest: bool = True
) -> DataFrame:
    """The row with the largest (smallest) value of each group, sorted by value."""
    present = df.filter(all_present(value, group))
    order = F.desc(value) if largest else F.asc(value)
    return keep_first(present, [group], [order, F.asc(key)]).orderBy(
        F.desc(value), F.asc(group)
    )


def pct_change(value: str, group: str, order: str, places: int = 2) -> Column:
    """Change against the previous row of the group in percent; 0 for the first.

    Meant for frames that are already aggregated to one row per group and period.
    """
    before = F.lag(value).over(Window.partitionBy(group).orderBy(order))
    change = F.when(before != 0, (F.col(value) / before - 1) * 100)
    return F.coalesce(F.round(change, places), F.lit(0.0))


def running_sum(value: str, order: str | Sequence[str], *partition: str) -> Column:
    """Sum so far, in order. The partition must be bounded, such as the days of a month."""
    order = [order] if isinstance(order, str) else list(order)
    frame = (
        Window.partitionBy(*partition)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.sum(value).over(frame)


def rank_of(df: DataFrame, key: str, wanted, value: str) -> DataFrame:
    """Place of one row when sorted by value, highest first, as one aggregate."""
    target = df.filter(F.col(key) == F.lit(wanted)).agg(F.max(value)).scalar()
    return df.agg(
        (F.count(F.when(F.col(value) > target, True)) + 1).alias("position"),
        F.max(F.when(F.col(key) == F.lit(wanted), F.col(value))).alias(value),
    )
