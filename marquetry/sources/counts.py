"""Row counts without reading the rows: from Parquet footers, and estimated for JSON lines."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files whose lines are counted for an estimate.
SAMPLED_FILES = 32
#: Standard errors on both sides of an estimate: one in 15,000 estimates is further off.
ERRORS = 4.0


def counting_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which counts are pushed into Parquet footers."""
    own = spark.newSession()
    v1 = [x for x in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if x.strip() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_count(spark: SparkSession, path: str | list[str], by: str | None = None, name: str = "n") -> DataFrame:
    """Exact rows of Parquet files, for each value of the partition column ``by`` if given.

    Only footers are read, in tasks; files are one row each before they are added up.
    """
    paths = [path] if isinstance(path, str) else path
    df = counting_session(spark).read.parquet(*paths)
    return (df.groupBy(by) if by else df).agg(F.count(F.lit(1)).alias(name))


def file_sizes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, file, length) of the files, ``file`` as rows read from them name it; their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("_metadata.file_path").alias("file"), "length")


def estimated_lines(
    spark: SparkSession, path: str | list[str], files: int = SAMPLED_FILES, seed: int = 0, errors: float = ERRORS
) -> DataFrame:
    """How many documents JSON lines hold, from ``files`` of them: one row with bounds.

    ``estimate`` is the sampled files' documents for each byte times all bytes, ``low`` and ``high`` are
    ``errors`` standard errors of such a ratio away, for a sample without replacement. With no more files
    than that, all are read, and the bounds meet. Files are drawn by a hash of their path and the seed, so
    that the same files give the same answer. Blank lines are no documents, empty files no files. Compressed files
    count by their compressed bytes.
    """
    sizes = file_sizes(spark, path)
    whole = sizes.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    drawn = sizes.filter("length > 0").orderBy(F.xxhash64("path", F.lit(seed)), "path").limit(files).collect()
    lines = {}
    if drawn:
        documents = spark.read.text([r["path"] for r in drawn]).filter(F.trim(F.col("value")) != "")
        # No more rows than files that were drawn.
        per_file = documents.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
        lines = {r["file"]: r["count"] for r in per_file}
    found = [(r["length"], lines.get(r["file"], 0)) for r in drawn]
    row = _ratio_estimate(found, whole["files"], whole["bytes"], errors)
    return spark.createDataFrame(
        [(*row, len(found), whole["files"], whole["bytes"])],
        "estimate long, low long, high long, files_read long, files long, bytes long",
    )


def _ratio_estimate(found: list[tuple[int, int]], files: int, size: int, errors: float) -> tuple[int, int, int]:
    """Estimate and bounds from the (bytes, documents) of sampled files."""
    read, counted = sum(b for b, _ in found), sum(n for _, n in found)
    if read == size:
        return counted, counted, counted
    ratio = counted / read
    estimate = ratio * size
    rest = size - read
    if len(found) < 2:
        # One file tells nothing about others: a document has a byte and its line feed at least.
        return round(estimate), counted, counted + rest
    spread = sum((n - ratio * b) ** 2 for b, n in found) / (len(found) - 1)
    error = errors * files * math.sqrt((1 - len(found) / files) * spread / len(found))
    low, high = max(counted, math.floor(estimate - error)), min(counted + rest, math.ceil(estimate + error))
    return round(estimate), low, max(low, high)
