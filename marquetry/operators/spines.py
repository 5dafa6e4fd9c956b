"""Calendar frames that reports are joined to, so that empty periods show."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _dates(spark: SparkSession, first: str, last: str, step: str) -> DataFrame:
    days = F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"interval 1 {step}")
    )
    return spark.range(1).select(F.explode(days).alias("date"))


def month_spine(spark: SparkSession, first_year: int, last_year: int | None = None) -> DataFrame:
    """One row (year, month) per month of the years."""
    last_year = last_year or first_year
    return _dates(spark, f"{first_year}-01-01", f"{last_year}-12-01", "month").select(
        F.year("date").alias("year"), F.month("date").alias("month")
    )


def trailing_months(spark: SparkSession, year: int, month: int, n: int = 6) -> DataFrame:
    """The n months that end with the given one."""
    start = year * 12 + month - 1 - (n - 1)
    first = f"{start // 12:04d}-{start % 12 + 1:02d}-01"
    return _dates(spark, first, f"{year:04d}-{month:02d}-01", "month").select(
        F.year("date").alias("year"), F.month("date").alias("month")
    )


def day_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row (date) per day from first to last."""
    return _dates(spark, first, last, "day")
