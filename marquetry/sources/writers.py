"""Sinks. All write from the executors, one file per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from ..functions.numbers import decimal_comma
from .versions import publish

BOM = "\ufeff"


def write_jsonl(
    df: DataFrame, path: str, keep_nulls: bool = False, mode: str = "errorifexists"
) -> None:
    """One JSON object per line, with NULL fields left out or kept."""
    df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", bom: bool = False) -> None:
    """CSV with a header line, optionally with a byte order mark in front of each file."""
    if bom:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    df.write.option("header", True).option("sep", sep).csv(path)


def write_csv_ptbr(df: DataFrame, path: str) -> None:
    """Semicolon CSV with decimal commas."""
    decimals = {
        f.name: decimal_comma(F.col(f.name).cast("double"))
        for f in df.schema.fields
        if isinstance(f.dataType, (DoubleType, FloatType))
    }
    decimals |= {
        f.name: F.translate(F.col(f.name).cast("string"), ".", ",")
        for f in df.schema.fields
        if isinstance(f.dataType, DecimalType)
    }
    write_csv(df.withColumns(decimals) if decimals else df, path, sep=";")


def write_collection(df: DataFrame, target: str, fmt: str = "parquet", **options: str) -> None:
    """Replace a collection: its new version is named once it is complete, and readers see the old one until then.

    ``fmt="mongodb"`` needs that connector on the class path and replaces in place; its connection
    settings come from the Spark configuration, ``target`` names the collection.
    """
    if fmt == "mongodb":
        df.write.mode("overwrite").format(fmt).options(**options).option("collection", target).save()
    else:
        publish(df, target, fmt, **options)


def write_backup(
    path: str, tables: Mapping[str, DataFrame], order: Mapping[str, Sequence[str]]
) -> None:
    """Each table as JSON lines below one folder, sorted where an order is given.

    End the order with the key: rows that share a date then still spread over tasks.
    """
    for name, df in tables.items():
        write_jsonl(df.orderBy(*order[name]) if name in order else df, f"{path}/{name}", keep_nulls=True)
