"""Ledger arithmetic and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EXPENSE, INCOME
from .numbers import percent


def savings_pct(income: Column, expense: Column, places: int | None = None) -> Column:
    """Share of income not spent, in percent; 0 without income."""
    return percent(income - expense, income, places)


def signed_value(kind: Column, value: Column) -> Column:
    """Income counts up, everything else counts down."""
    return F.when(kind == INCOME, value).otherwise(-value)


def income_of(kind: Column, value: Column) -> Column:
    return F.when(kind == INCOME, value)


def expense_of(kind: Column, value: Column) -> Column:
    return F.when(kind == EXPENSE, value)


def health_band(savings: Column, rows: Column) -> Column:
    """Bands at 30, 15 and 0 percent, and one for a period without rows."""
    return (
        F.when(rows == 0, "Sem dados")
        .when(savings >= 30, "Excelente")
        .when(savings >= 15, "Bom")
        .when(savings >= 0, "Atenção")
        .otherwise("Crítico")
    )


def goal_band(pct: Column) -> Column:
    """Bands at 100 and 80 percent of a goal."""
    return F.when(pct >= 100, "danger").when(pct >= 80, "warning").otherwise("ok")
