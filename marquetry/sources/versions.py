"""Tables replaced by whole versions: a new one is written beside the old one, then named."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPLETE = "complete"


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system: any store that Spark can read."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    found, files = _path(spark, path)
    return files.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    found, files = _path(spark, path)
    files.delete(found, True)


def named_version(spark: SparkSession, root: str) -> int | None:
    """The number of the newest complete version below ``root``; None if there is none."""
    root = root.rstrip("/")
    if not exists(spark, f"{root}/{COMPLETE}"):
        return None
    return spark.read.schema("version long").parquet(f"{root}/{COMPLETE}").agg(F.max("version")).first()[0]


def name_version(spark: SparkSession, root: str, version: int) -> None:
    """Name a version as complete. One row is the commit: a version that was broken off is never named."""
    done = spark.range(1).select(F.lit(version).cast("long").alias("version"))
    done.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{COMPLETE}")


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version}"


def current_path(spark: SparkSession, root: str) -> str:
    """Where the newest complete version is; ``root`` itself for files without versions."""
    version = named_version(spark, root)
    return root if version is None else version_path(root, version)


def publish(df: DataFrame, root: str, fmt: str = "parquet", keep: int = 2, **options: str) -> int:
    """Write ``df`` as the next version below ``root`` and name it; the last ``keep`` versions stay.

    ``df`` may read an older version: nothing is overwritten. What an attempt that was broken off
    left behind is replaced. One writer at a time.
    """
    spark = df.sparkSession
    version = (named_version(spark, root) or 0) + 1
    df.write.mode("overwrite").format(fmt).options(**options).save(version_path(root, version))
    name_version(spark, root, version)
    if version > keep:
        remove(spark, version_path(root, version - keep))
    return version
