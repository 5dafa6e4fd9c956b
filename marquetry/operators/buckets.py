"""Tables dealt into buckets by key, so that a change rewrites only the buckets it touches.

Layout below a root: ``v=<n>/bucket=<b>/`` holds the buckets that version n wrote, ``versions/version=<n>/`` names
for every bucket the version that holds it. A version is its list: it is written last, so readers see the old
table or the new one, never a mix, and what an attempt that was broken off left behind is in no list. Files of other
buckets are neither read nor written. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..sources.versions import exists, remove

#: Buckets of a table; lists have a row for each. About the table's size over that of a good file.
BUCKETS = 256
_LIST = "bucket int, held_by long"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def nullable(schema: StructType) -> StructType:
    """``schema`` as files have it: every field, also of structs, may be NULL."""
    text = schema.json()
    for flag in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{flag}":false', f'"{flag}":true')
    return StructType.fromJson(json.loads(text))


class BucketedTable:
    """A table with a key column below ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str, schema: StructType, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.schema = nullable(schema)

    def version(self) -> int:
        """The newest complete version; 0 for none."""
        path = f"{self.root}/versions"
        if not exists(self.spark, path):
            return 0
        return self.spark.read.schema(f"{_LIST}, version long").parquet(path).agg(F.max("version")).first()[0] or 0

    def _list(self, version: int) -> dict[int, int]:
        """The version that holds each bucket with rows. A row for each bucket at most."""
        if version == 0:
            return {}
        rows = self.spark.read.schema(_LIST).parquet(f"{self.root}/versions/version={version}").collect()
        return {r["bucket"]: r["held_by"] for r in rows if r["bucket"] >= 0}

    def _read(self, held: dict[int, int]) -> DataFrame:
        paths = [f"{self.root}/v={version}/bucket={bucket}" for bucket, version in sorted(held.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the newest version, or of an older one."""
        return self._read(self._list(self.version() if version is None else version))

    def get(self, key, version: int | None = None) -> DataFrame:
        """The rows of one key: one bucket is read."""
        literal = F.lit(key).cast(self.schema[self.key].dataType)
        bucket = self.spark.range(1).select(bucket_of(literal, self.buckets)).first()[0]
        held = self._list(self.version() if version is None else version)
        return self._read({b: v for b, v in held.items() if b == bucket}).filter(F.col(self.key) == literal)

    def of_keys(self, keys: Sequence, version: int | None = None) -> DataFrame:
        """The rows of some keys: their buckets are read."""
        kind = self.schema[self.key].dataType
        wanted = self.spark.createDataFrame([(k,) for k in keys], StructType().add(self.key, kind))
        buckets = {r[0] for r in wanted.select(bucket_of(F.col(self.key), self.buckets)).collect()}
        held = self._list(self.version() if version is None else version)
        return self._read({b: v for b, v in held.items() if b in buckets}).filter(F.col(self.key).isin(list(keys)))

    def changed(self, old: int, new: int) -> tuple[DataFrame, DataFrame]:
        """The rows of the buckets that differ between two versions, as the old and as the new one has them."""
        before, after = self._list(old), self._list(new)
        return (
            self._read({b: v for b, v in before.items() if after.get(b) != v}),
            self._read({b: v for b, v in after.items() if before.get(b) != v}),
        )

    def _with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", bucket_of(F.col(self.key), self.buckets))

    def _commit(self, rows: DataFrame, version: int, others: dict[int, int]) -> None:
        """Write ``rows`` as what ``version`` changes; ``others`` stay where they are."""
        fields = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema]
        path = f"{self.root}/v={version}"
        dealt = self._with_bucket(rows.select(*fields)).hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        # Which buckets have rows is told by the folders alone.
        written = self.spark.read.schema(StructType([*self.schema.fields]).add("bucket", IntegerType())).parquet(path)
        held = others | {r["bucket"]: version for r in written.select("bucket").distinct().collect()}
        # A row of no bucket, so that the version of a table without rows is there, too.
        names = self.spark.createDataFrame([(-1, version), *sorted(held.items())], _LIST)
        names.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/versions/version={version}")

    def create(self, rows: DataFrame) -> int:
        """Replace the whole table."""
        version = self.version() + 1
        self._commit(rows, version, {})
        return version

    def change(
        self, changes: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], base: int | None = None
    ) -> int:
        """Apply ``changes``, which have the key, by ``apply(rows, changes)``; the new version's number.

        ``apply`` gets the rows of the buckets that some change falls into, and returns them as they shall
        be: any of ``changes.replace_rows``, ``patch_rows``, ``delete_rows``, ``import_rows`` fits.
        Rows it returns stay in the bucket of their key, so it must not invent keys that no change has.
        ``base`` is the version that is changed, the newest one if it isn't named.
        """
        now = self.version()
        held = self._list(now if base is None else base)
        # One row for each bucket at most.
        touched = {r["bucket"] for r in self._with_bucket(changes).select("bucket").distinct().collect()}
        if not touched:
            return now if base is None else base
        before = self._read({b: v for b, v in held.items() if b in touched})
        after = apply(before, changes)
        self._commit(after, now + 1, {b: v for b, v in held.items() if b not in touched})
        return now + 1

    def remove_before(self, version: int) -> None:
        """Forget the versions before ``version``, and the files that none of the others needs."""
        kept = [self._list(v) for v in range(version, self.version() + 1)]
        needed = {(v, b) for held in kept for b, v in held.items()}
        for old in range(1, version):
            remove(self.spark, f"{self.root}/versions/version={old}")
            for bucket in range(self.buckets):
                if (old, bucket) not in needed:
                    remove(self.spark, f"{self.root}/v={old}/bucket={bucket}")
