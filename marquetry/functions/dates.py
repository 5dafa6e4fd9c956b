"""Calendar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names.
MONTHS = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]


def br_date(c: Column) -> Column:
    """``1996-02-29`` as ``29/02/1996``."""
    return F.date_format(c, "dd/MM/yyyy")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_name(month: Column) -> Column:
    """Name of month 1..12."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), month.cast("int"))


def month_label(month: Column) -> Column:
    """First three letters of the month's name."""
    return F.substring(month_name(month), 1, 3)


def clamp_day(year: Column, month: Column, day: Column) -> Column:
    """The date, with ``day`` cut to the last day of the month."""
    first = F.make_date(year, month, F.lit(1))
    return F.make_date(year, month, F.least(day, F.day(F.last_day(first))))


def in_period(c: Column, year: int | None = None, month: int | None = None) -> Column:
    """Half-open date range of a year or month, on the bare column so that scans prune."""
    if year is None:
        return F.lit(True)
    first = f"{year:04d}-{month or 1:02d}-01"
    if month is None or month == 12:
        after = f"{year + 1:04d}-01-01"
    else:
        after = f"{year:04d}-{month + 1:02d}-01"
    return (c >= F.lit(first).cast("date")) & (c < F.lit(after).cast("date"))
