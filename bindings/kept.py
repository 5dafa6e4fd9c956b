"""Tables that are changed bucket by bucket, and logs with snapshots; beside the SQL of the whole-table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.operators import changes as ops
from marquetry.operators.buckets import BucketedTable
from marquetry.operators.snapshots import SnapshotLog, last_writes
from marquetry.session import scratch_path

from .changes import _book
from .registry import SQL, query
from .tables import LEDGER_SQL, ledger, recurring, table

BUCKETS = 16


def kept(spark, df, key, name):
    out = BucketedTable(spark, scratch_path(spark, name), key, df.schema, BUCKETS)
    out.create(df)
    return out


@query("m02_bucketed_replace", SQL["m02_replace_fields"])
def m02(spark, sf):
    """Edits of the ledger in two versions: each rewrites the buckets that it touches."""
    book = _book(spark, sf)
    held = kept(spark, book, "id", "m02b")
    fields = ["date", "description", "category", "type", "value"]
    for half in (0, 1):
        some = held.read().filter((F.col("description") == "P") & (F.col("id") % 2 == half))
        edited = some.select(
            "id", "date", F.lit("pago").alias("description"), F.lit(None).cast("string").alias("category"),
            "type", (F.col("value") * 2).alias("value"),
        )
        held.change(edited, lambda rows, new: ops.replace_rows(rows, new, "id", fields))
    return held.read()


@query("m03_bucketed_patch", SQL["m03_update_supplied_fields"])
def m03(spark, sf):
    base = recurring(spark, sf)
    held = kept(spark, base, "id", "m03b")
    edits = base.filter((F.col("type") == "despesa") | (F.col("category") == "BUILDING")).select(
        "id",
        F.lit(0.0).alias("value"),
        (F.col("type") == "despesa").alias("has_value"),
        F.lit(0).alias("active"),
        (F.col("type") != "despesa").alias("has_active"),
    )
    held.change(edits, lambda rows, new: ops.patch_rows(rows, new, "id", ["value", "active"]))
    return held.read().select("id", "description", "value", "active")


@query("m04_bucketed_delete", SQL["m04_delete_by_id"])
def m04(spark, sf):
    book = _book(spark, sf)
    held = kept(spark, book, "id", "m04b")
    held.change(book.filter(F.col("description") == "O").select("id"), lambda rows, gone: ops.delete_rows(rows, gone, "id"))
    return held.read()


@query("m06_bucketed_import", SQL["m06_import_absent"])
def m06(spark, sf):
    present = ledger(spark, sf).filter(F.col("description") != "P").select("id", "date", "value")
    held = kept(spark, present, "id", "m06b")
    incoming = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("value"), "l_linenumber", "l_partkey", "l_suppkey",
    )
    order = ["l_linenumber", "date", "l_partkey", "l_suppkey", "value"]
    held.change(incoming, lambda rows, new: ops.import_rows(rows, new, "id", order))
    return held.read()


@query(
    "m07_bucketed_upsert",
    """WITH inc AS (SELECT s_name AS category, s_suppkey AS seq, s_acctbal AS lim FROM supplier WHERE s_nationkey % 2 = 0)
       SELECT n_name AS category, 10.0::DOUBLE AS limit_value FROM nation
       UNION ALL SELECT category, lim FROM inc WHERE lim > 0""",
)
def m07(spark, sf):
    base = table(spark, sf, "nation").select(F.col("n_name").alias("category"), F.lit(10.0).alias("limit_value"))
    held = kept(spark, base, "category", "m07b")
    incoming = table(spark, sf, "supplier").filter(F.col("s_nationkey") % 2 == 0).select(
        F.col("s_name").alias("category"), F.col("s_acctbal").alias("limit_value"),
        F.lit(None).cast("double").alias("limit"), F.col("s_suppkey").alias("seq"),
    )
    held.change(incoming, lambda rows, new: ops.upsert_goals(rows, new, "seq"))
    return held.read()


@query(
    "m04_older_version",
    f"""WITH {LEDGER_SQL} SELECT CAST(1 AS BIGINT) AS version, count(*) AS n FROM ledger
       UNION ALL SELECT 2, count(*) FROM ledger WHERE description <> 'O'""",
)
def m04_versions(spark, sf):
    """Both versions of the ledger can be read."""
    book = _book(spark, sf)
    held = kept(spark, book, "id", "m04v")
    held.change(book.filter(F.col("description") == "O").select("id"), lambda rows, gone: ops.delete_rows(rows, gone, "id"))
    parts = [held.read(v).agg(F.count(F.lit(1)).alias("n")).select(F.lit(v).cast("long").alias("version"), "n") for v in (1, 2)]
    return parts[0].unionByName(parts[1])


def _log(spark, sf, *fields, keys=("key",)):
    """Events appended in four segments, the newest first; the first two are in a snapshot, the third in its next version."""
    events = table(spark, sf, "events")
    rows = events.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("seq"), *fields)
    log = SnapshotLog(spark, scratch_path(spark, "log"), rows.schema, last_writes(keys), buckets=BUCKETS)
    for part in (3, 1):
        log.append(rows.filter(F.col("seq") % 4 == part))
    log.compact()
    log.append(rows.filter(F.col("seq") % 4 == 2))
    log.compact()
    log.append(rows.filter(F.col("seq") % 4 == 0))
    return log


@query("m10_snapshot_latest", SQL["m10_latest_value"])
def m10(spark, sf):
    return _log(spark, sf, "value").latest().select("key", "value")


@query("m10_snapshot_get", SQL["m10_get"])
def m10_get(spark, sf):
    return _log(spark, sf, "value").get("46").select("key", "value")


@query("m12_snapshot_fields", SQL["m12_hash_fields"])
def m12(spark, sf):
    log = _log(spark, sf, F.col("event_type").alias("field"), "value", keys=("key", "field"))
    return log.latest().select("key", "field", "value")


@query("m12_snapshot_get_all", SQL["m12_hash_get_all"])
def m12_get_all(spark, sf):
    log = _log(spark, sf, F.col("event_type").alias("field"), "value", keys=("key", "field"))
    return log.get("46").select("field", "value")
