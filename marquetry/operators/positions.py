"""Row numbers within a key that never gather the key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    name: str = "pos",
    start: int = 0,
    stop: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """0-based position of each row within its keys, in ``seq`` order.

    ``seq`` is one or more columns of any orderable type, NULL first. Where it ties, rows
    are in the order of their other columns; equal rows are interchangeable.

    Rows are dealt into ranges of (keys, seq) and written once. A range's rows are numbered
    within it, and where a key starts in a range follows from the counts of the ranges
    before, one row for each range and key that meet there. A key of any size is spread
    over as many ranges as it fills, however its numbers are distributed.

    With ``start`` and ``stop`` only rows start..stop-1 of each key remain; ranges outside
    are dropped before any row is numbered.
    """
    seqs = [seq] if isinstance(seq, str) else list(seq)
    order = [F.col(c).asc_nulls_first() for c in [*keys, *seqs]]
    ties = [c for c, kind in df.dtypes if c not in {*keys, *seqs} and "map<" not in kind and "variant" not in kind]
    order += [F.col(c).asc_nulls_first() for c in ties]
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(partitions, *order)
    dealt = staged(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    # A struct is never NULL itself, so rows whose keys hold NULL find their range, too.
    key: Column = F.struct(*keys) if keys else F.lit(True)
    dealt = dealt.withColumn("_key", key)
    # A key that lies within one range needs no window over ranges; few keys cross a border.
    sizes = dealt.groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_size").over(before), F.lit(0))
    starts = sizes.withColumn("_start", first).filter(F.col("_start") + F.col("_size") > start)
    if stop is not None:
        starts = starts.filter(F.col("_start") < stop)
    inside = Window.partitionBy("_key", "_range").orderBy(*order)
    placed = (
        dealt.join(starts, ["_key", "_range"])
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .select(*df.columns, name)
    )
    if start > 0:
        placed = placed.filter(F.col(name) >= start)
    return placed if stop is None else placed.filter(F.col(name) < stop)
