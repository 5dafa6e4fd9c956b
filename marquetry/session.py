"""Session helpers: a local session for tests, and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cores: int | str = "*", app: str = "marquetry", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if SparkSession.getActiveSession() is None and CHECKPOINT_DIR.replace(".", "__") not in conf:
        builder = builder.config(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="marquetry-"))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster the
    driver's temporary folder is invisible to the executors.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="marquetry-")
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/marquetry/{app}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to shared scratch space and read it back.

    For a frame that feeds several outputs: its inputs are read once, and a lost
    executor costs a re-read of the written table, not of the whole lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not partition_by:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


def bounded_batches(spark: SparkSession, most: int) -> None:
    """Send rows to Python in batches of about ``most`` bytes, unless the session names a size of its own.

    The JVM and the worker both hold a batch, and by default it has 10,000 rows, however long their texts are. Frames
    are run later than they are made, so the setting stays; it changes no results.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(most))


@contextmanager
def dealt_into(spark: SparkSession, partitions: int, joined_bytes: int) -> Iterator[None]:
    """Jobs run inside shuffle into ``partitions`` or more, of which adaptive execution joins neighbours up to ``joined_bytes``.

    The settings of the session come back afterwards.
    """
    parts, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {name: spark.conf.get(name) for name in (parts, size)}
    spark.conf.set(parts, str(max(int(before[parts]), partitions)))
    spark.conf.set(size, str(joined_bytes))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def remove_copies(spark: SparkSession) -> None:
    """Remove what this application has staged below ``spark.checkpoint.dir``, when its results are read."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(
            f"{base.rstrip('/')}/marquetry/{spark.sparkContext.applicationId}"
        )
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
