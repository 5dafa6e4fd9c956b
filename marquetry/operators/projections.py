"""Column and row selection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.presence import all_present
from ..functions.text import matches
from .positions import with_position


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that hold all keys."""
    return df.filter(all_present(*keys))


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def equals_if(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters, each left out where its value is None."""
    for column, value in wanted.items():
        if value is not None:
            df = equals(df, column, value)
    return df


def search(df: DataFrame, column: str, pattern: str, key: str, limit: int = 50) -> DataFrame:
    """First rows by key whose text matches, regardless of case."""
    return df.filter(matches(F.col(column), pattern)).orderBy(key).limit(limit)


def at_maximum(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the largest value."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def above_average(df: DataFrame, column: str) -> DataFrame:
    """Rows above the column's mean."""
    return df.filter(F.col(column) > df.agg(F.avg(column)).scalar())


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the named columns, under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def pop(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The frame without the column, and the column by itself."""
    return df.drop(column), df.select(column)


def reindex(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Exactly the requested columns (name: type); unknown ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in have else F.lit(None)).cast(dtype).alias(name)
            for name, dtype in columns.items()
        ]
    )


def if_column(df: DataFrame, column: str, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``step`` only to a frame that has the column."""
    return step(df) if column in df.columns else df


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def threshold(c: Column, limit, below, otherwise) -> Column:
    """``below`` under the limit, else ``otherwise``."""
    return F.when(c < limit, F.lit(below)).otherwise(F.lit(otherwise))


def row_range(df: DataFrame, key: str | Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows start..stop-1 in the order of one or more columns of any type, NULL first.

    Ties go by the other columns. Rows are cut by position, so that a slice of any length
    takes the same way and never passes through one task.
    """
    return with_position(df, [], key, name="_pos", start=start, stop=max(start, stop)).drop("_pos")


def computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
