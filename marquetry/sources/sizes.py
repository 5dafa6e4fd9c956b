"""Size of data sets before and after cleaning."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BYTES_PER_MB = 1024 * 1024


def folder_sizes(spark: SparkSession, paths: Mapping[str, str], name: str) -> DataFrame:
    """Bytes per data set (dataset: path). Lists the files; their content is not read."""
    parts = [
        spark.read.format("binaryFile")
        .load(path)
        .agg(F.coalesce(F.sum("length"), F.lit(0)).alias(name))
        .select(F.lit(dataset).alias("dataset"), name)
        for dataset, path in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def size_report(
    spark: SparkSession, raw: Mapping[str, str], clean: Mapping[str, str]
) -> DataFrame:
    """Megabytes before and after, and the reduction in percent, for data sets in both."""
    both = folder_sizes(spark, raw, "_raw").join(folder_sizes(spark, clean, "_clean"), "dataset")
    reduction = F.when(F.col("_raw") > 0, (1 - F.col("_clean") / F.col("_raw")) * 100).otherwise(0.0)
    return both.select(
        "dataset",
        F.round(F.col("_raw") / BYTES_PER_MB, 4).alias("raw_mb"),
        F.round(F.col("_clean") / BYTES_PER_MB, 4).alias("clean_mb"),
        F.round(reduction, 1).alias("reduction_pct"),
    )
