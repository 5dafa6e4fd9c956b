"""Constraint checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row (key, rule) per rule that a row breaks; NULL breaks a rule. One pass."""
    broken = [
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()
    ]
    return (
        df.select(F.col(key), F.array_compact(F.array(*broken)).alias("_broken"))
        .select(key, F.explode("_broken").alias("rule"))
    )


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def not_null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNotNull() for c in columns}
