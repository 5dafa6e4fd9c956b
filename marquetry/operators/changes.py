"""Set-based table changes: (table, changes) -> new table.

Spark does not overwrite a path it reads, so a changed table is written as a new version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.dates import clamp_day, in_period
from ..functions.ids import stable_id
from ..sources.versions import current_path, name_version, named_version, version_path
from .joins import absent_from
from .windows import keep_first, keep_last


def insert_rows(
    table: DataFrame, new: DataFrame, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Table and new rows. Missing or NULL fields take their default, else NULL."""
    defaults = defaults or {}
    filled = []
    for field in table.schema:
        value = F.col(field.name) if field.name in new.columns else F.lit(None)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name])
        filled.append(value.cast(field.dataType).alias(field.name))
    return table.unionByName(new.select(*filled))


def add_transactions(transactions: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Insert entries: an id where none is given, and the time of creation.

    ``seq`` numbers the new rows, so that equal rows get ids of their own.
    """
    defaults = {
        "id": stable_id(F.col("date"), F.col("description"), F.col("value"), F.col(seq)),
        "created_at": F.current_timestamp(),
    }
    return insert_rows(transactions, new, defaults)


def add_recurring(recurring: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Insert templates, active unless told otherwise."""
    defaults = {
        "id": stable_id(F.col("description"), F.col("category"), F.col("value"), F.col(seq)),
        "active": F.lit(1),
        "created_at": F.current_timestamp(),
    }
    return insert_rows(recurring, new, defaults)


def _matched(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``table`` with the change of its key. Equal changes are one; different ones are an error."""
    others = [c for c in changes.columns if c != key]
    change = F.struct(*others)
    single = changes.groupBy(key).agg(
        F.any_value(change).alias("_change"),
        F.min(F.xxhash64(change)).alias("_least"),
        F.max(F.xxhash64(change)).alias("_most"),
    )
    several = F.raise_error(F.lit("several changes of one key: number them and name the column in seq"))
    renamed = single.select(
        F.col(key),
        F.when(F.col("_least") == F.col("_most"), F.lit(True)).otherwise(several.cast("boolean")).alias("_hit"),
        *[F.col(f"_change.{c}").alias(f"_new_{c}") for c in others],
    )
    return table.join(renamed, key, "left")


def replace_rows(
    table: DataFrame, changes: DataFrame, key: str, fields: Sequence[str], seq: str | None = None
) -> DataFrame:
    """Rows with a change take all the fields from it, NULL included.

    There is one change per key, or ``seq`` numbers the changes and the last one wins.
    Different changes of one key without ``seq`` are an error; the table's key stays unique.
    """
    if seq is not None:
        changes = keep_last(changes, [key], seq)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    joined = _matched(table, changes, key)
    return joined.select(
        *[
            F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
            for c in table.columns
        ]
    )


def patch_rows(
    table: DataFrame, changes: DataFrame, key: str, fields: Sequence[str], seq: str | None = None
) -> DataFrame:
    """Rows with a change take the supplied fields only.

    ``changes`` holds, for each field, the value and a flag ``has_<field>`` that says
    whether it was supplied, so that NULL can be written too. There is one change per key,
    or ``seq`` numbers the changes and each field takes the last value supplied for it.
    """
    if seq is not None:
        last = []
        for c in fields:
            supplied = F.coalesce(F.col(f"has_{c}"), F.lit(False))
            last += [
                F.max_by(c, F.when(supplied, F.col(seq))).alias(c),
                F.bool_or(supplied).alias(f"has_{c}"),
            ]
        changes = changes.groupBy(key).agg(*last)
    joined = _matched(table, changes, key)
    return joined.select(
        *[
            F.when(
                F.coalesce(F.col("_hit") & F.col(f"_new_has_{c}"), F.lit(False)), F.col(f"_new_{c}")
            )
            .otherwise(F.col(c))
            .alias(c)
            if c in fields
            else F.col(c)
            for c in table.columns
        ]
    )


def delete_rows(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return absent_from(table, ids, [key])


def replace_goals(goals: DataFrame) -> DataFrame:
    """A new goal table: only positive limits count."""
    return goals.filter(F.col("limit_value") > 0)


def import_rows(
    table: DataFrame, incoming: DataFrame, key: str, order: Sequence[Column | str]
) -> DataFrame:
    """Add incoming rows whose id is new; of equal ids the first in order counts.

    A row without an id gets one from its values, which should include a sequence number
    so that equal rows stay apart.
    """
    if isinstance(incoming.schema[key].dataType, StringType):
        made = stable_id(*[F.col(c) for c in incoming.columns])
        incoming = incoming.withColumn(key, F.coalesce(F.nullif(key, F.lit("")), made))
    fresh = absent_from(keep_first(incoming, [key], order), table, [key])
    return insert_rows(table, fresh)


def upsert_goals(goals: DataFrame, incoming: DataFrame, seq: str) -> DataFrame:
    """Merge incoming limits into the goals; the last one of a category wins.

    The limit is in ``limit_value`` or, under its old name, in ``limit``. A zero in the
    first falls through to the second. Entries without a positive limit are skipped.
    """
    limit = F.coalesce(F.nullif(F.col("limit_value"), F.lit(0.0)), F.col("limit"))
    valid = incoming.select(
        "category", limit.cast("double").alias("limit_value"), F.col(seq)
    ).filter(F.col("category").isNotNull() & (F.col("category") != "") & (F.col("limit_value") > 0))
    latest = keep_last(valid, ["category"], seq).select(
        "category", F.col("limit_value").alias("_limit")
    )
    return goals.join(latest, "category", "full").select(
        "category", F.coalesce("_limit", "limit_value").alias("limit_value")
    )


def due_recurring(
    transactions: DataFrame, recurring: DataFrame, year: int, month: int
) -> DataFrame:
    """Active templates without an entry in the month."""
    done = transactions.filter(
        in_period(F.col("date"), year, month) & F.col("recurring_id").isNotNull()
    ).select(F.col("recurring_id").alias("id"))
    return absent_from(recurring.filter(F.col("active") == 1), done, ["id"])


def generate_recurring(
    transactions: DataFrame, recurring: DataFrame, year: int, month: int
) -> DataFrame:
    """New entries of the month. Adding them and asking again gives none."""
    due = due_recurring(transactions, recurring, year, month)
    date = clamp_day(F.lit(year), F.lit(month), F.col("day_of_month"))
    return due.select(
        stable_id(F.col("id"), F.lit(f"{year:04d}-{month:02d}")).alias("id"),
        date.alias("date"),
        "description",
        "category",
        "type",
        "value",
        F.col("id").cast("string").alias("recurring_id"),
    )


def write_version(table: DataFrame, root: str, version: int) -> DataFrame:
    """Write one version of a table below ``root``, name it as complete, and read it back."""
    spark, path = table.sparkSession, version_path(root, version)
    table.write.mode("errorifexists").parquet(path)
    name_version(spark, root, version)
    return spark.read.schema(table.schema).parquet(path)


def current_version(spark: SparkSession, root: str) -> int | None:
    """The number of the newest complete version below ``root``."""
    return named_version(spark, root)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version below ``root``."""
    return spark.read.parquet(current_path(spark, root))
