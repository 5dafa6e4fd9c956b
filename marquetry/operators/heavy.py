"""The k commonest keys of very many, without a shuffle of all keys.

1. Keys are hashed into ``BUCKETS`` buckets, twice with different seeds, and rows (or weights) are added up
   by bucket: at most 2 x BUCKETS rows leave a task. A key has no more than either of its buckets.
2. Keys whose buckets are among the heaviest both times are candidates. They alone are counted exactly.
3. Any other key lies in a bucket that isn't, so it has no more than the heaviest of those. If the k-th
   candidate has more than that, none can be missing, ties included. If it hasn't, as with keys of like
   frequency, or where a weight is negative, all keys are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .ordering import top_k

BUCKETS = 1 << 16
#: Heaviest buckets that are looked into, for each key asked for.
BUCKETS_A_KEY = 8
_SEEDS = (1, 2)


def _bucket(keys: Sequence[str], seed: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(buckets)).cast("int")


def candidates(
    df: DataFrame, keys: Sequence[str], k: int, amount: Column, buckets: int = BUCKETS
) -> tuple[DataFrame, object] | None:
    """Rows of keys that can be among the first k, and what no other key exceeds (None: there is no other key).

    The result is None where this can't be told.
    ``amount`` is what a row adds, exact (whole number or decimal). A row for each seed comes to the driver.
    """
    looked_into = k * BUCKETS_A_KEY
    # Two zeros of floats are one key with two hashes.
    if looked_into * 8 > buckets or any(isinstance(df.schema[c].dataType, (DoubleType, FloatType)) for c in keys):
        return None
    twice = F.explode(
        F.array(*[F.struct(F.lit(s).alias("seed"), _bucket(keys, s, buckets).alias("bucket")) for s in _SEEDS])
    )
    sums = (
        df.select(amount.alias("_amount"), twice.alias("_place"))
        .groupBy("_place.seed", "_place.bucket")
        .agg(F.sum("_amount").alias("total"), F.min("_amount").alias("least"))
    )
    # A group is BUCKETS rows at most.
    heaviest = F.slice(
        F.sort_array(F.collect_list(F.struct(F.coalesce("total", F.lit(0)).alias("total"), "bucket")), asc=False), 1, looked_into + 1
    )
    found = sums.groupBy("seed").agg(heaviest.alias("heaviest"), F.min("least").alias("least")).collect()
    if not found or any(r["least"] is not None and r["least"] < 0 for r in found):
        return None
    chosen, others = df, []
    for row in found:
        inside = [h["bucket"] for h in row["heaviest"][:looked_into]]
        chosen = chosen.filter(_bucket(keys, row["seed"], buckets).isin(inside))
        others += [h["total"] for h in row["heaviest"][looked_into:]]
    return chosen, max(others, default=None)


def heaviest(
    df: DataFrame, keys: Sequence[str], k: int, amount: Column | None = None, name: str = "total", buckets: int = BUCKETS
) -> DataFrame:
    """The k keys with the most rows, or the largest sum of ``amount``, and what they have; ties by key.

    Equal to grouping all rows and taking the first k. A NULL key is a key; a NULL amount adds nothing, and a key
    with NULL alone has 0.
    """
    counted = F.lit(1).cast("long") if amount is None else F.coalesce(amount, F.lit(0).cast("int"))

    def exact(rows: DataFrame) -> DataFrame:
        sums = rows.withColumn("_amount", counted).groupBy(*keys).agg(F.sum("_amount").alias(name))
        return top_k(sums, name, list(keys), k)

    found = candidates(df, keys, k, counted, buckets)
    if found is None:
        return exact(df)
    # At most k rows.
    chosen, bound = found
    first = exact(chosen).collect()
    if bound is not None and (len(first) < k or first[-1][name] <= bound):
        return exact(df)
    kept = df.sparkSession.createDataFrame(first, exact(chosen).schema)
    return kept.orderBy(F.desc_nulls_last(name), *keys)
