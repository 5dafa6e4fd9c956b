"""Joins. Hot keys are split by adaptive execution; a salted form is there on request."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.presence import all_present, any_missing

# A hot key has more than this share of all rows, so there are fewer hot keys than its inverse.
HOT_SHARE = 1 / 32_768
ROWS_PER_TASK = 1_000_000
# Rows without a key match nothing; they are only spread.
NULL_SPREAD = 4096


def hot_keys(
    df: DataFrame, key_sets: Sequence[Sequence[str]], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Hot keys of several joins of ``df``, counted in one pass: (key_set, key_hash, parts).

    A key is hot with more than ``rows_per_task`` rows and more than ``HOT_SHARE`` of the
    rows that have one. That bounds the frame to 32,768 rows for each set of keys.
    """
    hashes = [
        F.struct(F.lit(i).alias("key_set"), F.when(all_present(*keys), F.xxhash64(*keys)).alias("key_hash"))
        for i, keys in enumerate(key_sets)
    ]
    counted = (
        df.select(F.inline(F.array(*hashes)))
        .filter(F.col("key_hash").isNotNull())
        .groupBy("key_set", "key_hash")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    # The counts are summed up once more rather than read again by a window in one task.
    whole = counted.groupBy("key_set").agg(F.sum("_rows").alias("_all"))
    least = F.greatest(F.lit(rows_per_task), F.ceil(F.col("_all") * F.lit(HOT_SHARE)))
    return (
        counted.filter(F.col("_rows") > rows_per_task)
        .join(whole, "key_set")
        .filter(F.col("_rows") > least)
        .select("key_set", "key_hash", F.ceil(F.col("_rows") / least).cast("int").alias("parts"))
    )


def spread(df: DataFrame) -> Column:
    """A number from the row's values and its input partition; equal rows get several.

    Columns that Spark cannot hash (maps, variants) do not take part.
    """
    values = [F.col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return F.xxhash64(F.spark_partition_id(), *values)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: DataFrame | None = None,
    key_set: int = 0,
) -> DataFrame:
    """Equi-join (inner, left, left_semi, left_anti).

    Without ``hot`` it is a plain join, which reads each side once; adaptive execution
    splits partitions that a hot key of either side makes too large. With ``hot``, the
    frame of ``hot_keys`` for these keys, left rows of a hot key get one of the key's
    parts and the matching right rows are repeated once per part. The part of a row
    follows from its values and its input partition, so a re-run task assigns it again.
    """
    keys = list(keys)
    if hot is None:
        return left.join(right, keys, how)
    own = hot.filter(F.col("key_set") == key_set).select(
        F.col("key_hash").alias("_hash"), F.col("parts").alias("_parts")
    )
    hashed = F.when(all_present(*keys), F.xxhash64(*keys))
    number = spread(left)
    marked = left.withColumn("_hash", hashed).join(F.broadcast(own), "_hash", "left").withColumn(
        "_part",
        F.when(any_missing(*keys), F.pmod(number, F.lit(NULL_SPREAD)))
        .when(F.col("_parts").isNotNull(), F.pmod(number, F.col("_parts")))
        .otherwise(0)
        .cast("int"),
    )
    copies = (
        right.withColumn("_hash", hashed)
        .join(F.broadcast(own), "_hash", "left")
        .withColumn(
            "_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
        )
        .drop("_parts", "_hash")
    )
    return marked.drop("_parts", "_hash").join(copies, [*keys, "_part"], how).drop("_part")


def keep_with_parents(
    df: DataFrame, parents: Sequence[tuple[DataFrame, str]], hot: DataFrame | None = None
) -> DataFrame:
    """Rows whose keys all exist in their parent frames. ``hot`` is for these keys in this order."""
    for i, (parent, key) in enumerate(parents):
        df = salted_join(df, parent.select(key), [key], "left_semi", hot, i)
    return df


def orphans(df: DataFrame, parent: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Rows whose key does not exist in the parent frame."""
    return salted_join(df, parent.select(key), [key], "left_anti", hot)


def orphan_report(df: DataFrame, parents: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Rows and orphans per key combination check, in one pass over ``df``.

    A row counts as an orphan of the first parent that lacks it. Equal key combinations
    are counted before the joins.
    """
    names = [key for _, key in parents]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    for parent, key in parents:
        known = parent.select(key).distinct().withColumn(f"_has_{key}", F.lit(True))
        counted = counted.join(known, key, "left")
    reason = F.lit(None).cast("string")
    for key in reversed(names):
        reason = F.when(F.col(f"_has_{key}").isNull(), F.lit(key)).otherwise(reason)
    return (
        counted.withColumn("missing", reason)
        .groupBy(F.coalesce("missing", F.lit("none")).alias("missing"))
        .agg(F.sum("_n").alias("rows"))
    )


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """Inner join on all keys. Adaptive execution splits hot keys of either side."""
    return salted_join(left, right, keys, "inner", hot)


def align(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys of either side; values of the other side are NULL where absent.

    Meant for series, which hold each key once.
    """
    return left.join(right, list(keys), "full")


def align_to(
    df: DataFrame, values: DataFrame, keys: Sequence[str], hot: DataFrame | None = None
) -> DataFrame:
    """The rows of ``df`` with the columns of ``values``; NULL where the key is absent."""
    return salted_join(df, values, keys, "left", hot)


def absent_from(
    df: DataFrame, existing: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows whose key is not in ``existing``, where a key may occur any number of times.

    ``df`` holds each key once, as a table does; ``orphans`` is the form for facts.
    """
    return df.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def lookup(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    defaults: Mapping[str, Column | str],
) -> DataFrame:
    """Add the dimension's columns, with defaults where the label is unknown.

    The planner broadcasts a dimension that it knows to be small, as literal tables are.
    """
    renamed = dim.select(
        F.col(dim_key).alias(key), *[F.col(name).alias(f"_{name}") for name in defaults]
    )
    joined = df.join(renamed, key, "left")
    filled = {
        name: F.coalesce(
            F.col(f"_{name}"), default if isinstance(default, Column) else F.lit(default)
        )
        for name, default in defaults.items()
    }
    return joined.withColumns(filled).drop(*[f"_{name}" for name in defaults])


def fill_spine(
    spine: DataFrame, facts: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Every spine row, with 0 for measures that have no fact."""
    joined = spine.join(facts, list(keys), "left")
    return joined.fillna(0, subset=list(measures))
