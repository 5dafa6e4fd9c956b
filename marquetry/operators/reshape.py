"""Set operations and wide/long reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def concat(*frames: DataFrame) -> DataFrame:
    """All rows of all frames."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def concat_loose(*frames: DataFrame) -> DataFrame:
    """All rows; a column that a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], label: str, value: str
) -> DataFrame:
    """Wide to long: one row per id and value column."""
    return df.unpivot(list(ids), list(values), label, value)


def split_label(
    df: DataFrame, keys: Sequence[str], label: str, measures: dict, value: Column
) -> DataFrame:
    """Long to wide: one column per listed label (label: column name)."""
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(label) == text, value)).alias(name) for text, name in measures.items()]
    )


def transpose(
    df: DataFrame, index: str, labels: Sequence[str | None], measure: str = "measure", null_name: str = "null"
) -> DataFrame:
    """Rows to columns: one column for each of ``labels``, one row for each other column.

    A label that several rows share takes the largest of their values; NULL among the labels
    makes the column ``null_name``; a label without a row is NULL throughout, and rows with
    other labels do not appear. The columns other than ``index`` have one type.
    """
    values = [c for c in df.columns if c != index]
    long = melt(df, [index], values, measure, "_value")
    chosen = [F.max(F.when(F.col(index).eqNullSafe(F.lit(x)), F.col("_value"))) for x in labels]
    names = [null_name if x is None else str(x) for x in labels]
    return long.groupBy(measure).agg(*[c.alias(n) for c, n in zip(chosen, names, strict=True)])
