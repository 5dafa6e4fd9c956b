"""Starting salaries of teachers by state and region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import extreme_groups, extreme_row, global_mean, group_mean
from ..operators.windows import extreme_per_group, rank_of
from ..sources.readers import read_csv_text
from ..functions.numbers import parse_ptbr

VALUE = "salario"


def read_salaries(spark: SparkSession, path: str) -> DataFrame:
    """Columns UF, Salário inicial, Região as text, and the salary as a number."""
    raw = read_csv_text(spark, path, sep=";")
    return raw.withColumn(VALUE, parse_ptbr(F.col("Salário inicial")).cast("double"))


def lowest_state(df: DataFrame) -> DataFrame:
    return extreme_row(df, VALUE, "UF", largest=False)


def highest_state(df: DataFrame) -> DataFrame:
    return extreme_row(df, VALUE, "UF")


def position_of(df: DataFrame, state: str) -> DataFrame:
    return rank_of(df, "UF", state, VALUE)


def mean_salary(df: DataFrame) -> DataFrame:
    return global_mean(df, VALUE)


def mean_by_region(df: DataFrame) -> DataFrame:
    return group_mean(df, ["Região"], VALUE)


def highest_by_region(df: DataFrame) -> DataFrame:
    return extreme_per_group(df, "Região", VALUE, "UF")


def lowest_by_region(df: DataFrame) -> DataFrame:
    return extreme_per_group(df, "Região", VALUE, "UF", largest=False)


def best_and_worst_region(df: DataFrame) -> DataFrame:
    return extreme_groups(df, "Região", VALUE)
