"""Vectors (``array<T>``) and matrices (``array<array<T>>``). Positions count from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def arange(stop: Column) -> Column:
    """0, 1, .. stop-1."""
    return F.when(stop > 0, F.sequence(F.lit(0), (stop - 1).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )


def assign_slice(a: Column, start: int, stop: int, value) -> Column:
    """Copy of ``a`` with positions start..stop-1 set to ``value``."""
    return F.transform(
        a, lambda x, i: F.when((i >= start) & (i < stop), F.lit(value)).otherwise(x)
    )


def reshape(a: Column, rows: int, cols: int) -> Column:
    """Vector as a ``rows`` x ``cols`` matrix, row by row."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(a, i * cols + 1, cols)
    )


def matrix_row(m: Column, row: int) -> Column:
    return F.get(m, F.lit(row))


def matrix_column(m: Column, col: int) -> Column:
    return F.transform(m, lambda r: F.get(r, F.lit(col)))


def submatrix(m: Column, row0: int, row1: int, col0: int, col1: int) -> Column:
    """Rows row0..row1-1, columns col0..col1-1."""
    return F.transform(
        F.slice(m, row0 + 1, row1 - row0), lambda r: F.slice(r, col0 + 1, col1 - col0)
    )


def matrix_shape(m: Column) -> Column:
    return F.struct(F.size(m).alias("rows"), F.size(F.get(m, F.lit(0))).alias("cols"))
