"""Table changes, constraint checks and key/value tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.functions.ids import stable_id
from marquetry.operators import changes as ops
from marquetry.operators import keyvalue, quality
from marquetry.session import scratch_path

from .registry import query
from .tables import GOALS_SQL, LEDGER_SQL, RECURRING_SQL, goals, ledger, recurring, table


@query(
    "m01_insert_with_defaults",
    f"""WITH {RECURRING_SQL}
       SELECT CAST(id AS VARCHAR) AS id, description, value, active FROM recurring
       UNION ALL SELECT substring(sha256(s_name || '-' || s_suppkey), 1, 16), s_name, s_acctbal, 1
       FROM supplier""",
)
def m01(spark, sf):
    base = recurring(spark, sf).select(
        F.col("id").cast("string").alias("id"), "description", "value", "active"
    )
    new = table(spark, sf, "supplier").select(
        F.lit(None).cast("string").alias("id"),
        F.col("s_name").alias("description"),
        F.col("s_acctbal").alias("value"),
        "s_suppkey",
    )
    defaults = {
        "id": stable_id(F.col("description"), F.col("s_suppkey")),
        "active": F.lit(1),
    }
    return ops.insert_rows(base, new.withColumn("active", F.lit(None).cast("int")), defaults)


def _book(spark, sf):
    return ledger(spark, sf).select("id", "date", "description", "category", "type", "value")


@query(
    "m02_replace_fields",
    f"""WITH {LEDGER_SQL} SELECT id, date, CASE WHEN description = 'P' THEN 'pago' ELSE description END
         AS description, CASE WHEN description = 'P' THEN NULL ELSE category END AS category, type,
         CASE WHEN description = 'P' THEN value * 2 ELSE value END AS value FROM ledger""",
)
def m02(spark, sf):
    book = _book(spark, sf)
    edited = book.filter(F.col("description") == "P").select(
        "id",
        "date",
        F.lit("pago").alias("description"),
        F.lit(None).cast("string").alias("category"),
        "type",
        (F.col("value") * 2).alias("value"),
    )
    return ops.replace_rows(book, edited, "id", ["date", "description", "category", "type", "value"])


@query(
    "m02_repeated_change",
    f"""WITH {LEDGER_SQL} SELECT id, date, CASE WHEN description = 'P' THEN 'c' ELSE description END AS description,
         category, type, CASE WHEN description = 'P' THEN value * 3 ELSE value END AS value FROM ledger""",
)
def m02_repeated(spark, sf):
    """Three numbered changes of one row: the last wins and the key stays unique."""
    book = _book(spark, sf)
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(t).alias("to")) for i, t in enumerate("abc", 1)]))
    edits = book.filter(F.col("description") == "P").select("id", "value", steps.alias("s"))
    edits = edits.select("id", F.col("s.to").alias("description"), (F.col("value") * F.col("s.seq")).alias("value"), "s.seq")
    return ops.replace_rows(book, edits, "id", ["description", "value"], seq="seq")


@query(
    "m05_current_version",
    f"WITH {LEDGER_SQL}, {GOALS_SQL} SELECT category, limit_value * 2 AS limit_value FROM goals WHERE limit_value > 0",
)
def m05_current(spark, sf):
    """Two versions are written; the newest complete one is read."""
    root = scratch_path(spark, "m05c")
    kept = ops.replace_goals(goals(spark, sf))
    first = ops.write_version(kept, root, 1)
    ops.write_version(first.withColumn("limit_value", F.col("limit_value") * 2), root, 2)
    return ops.read_current(spark, root)


@query(
    "m03_update_supplied_fields",
    f"""WITH {RECURRING_SQL} SELECT id, description,
         CASE WHEN type = 'despesa' THEN 0.0 ELSE value END AS value,
         CASE WHEN type <> 'despesa' AND category = 'BUILDING' THEN 0 ELSE active END AS active
       FROM recurring""",
)
def m03(spark, sf):
    base = recurring(spark, sf)
    edits = base.filter((F.col("type") == "despesa") | (F.col("category") == "BUILDING")).select(
        "id",
        F.lit(0.0).alias("value"),
        (F.col("type") == "despesa").alias("has_value"),
        F.lit(0).alias("active"),
        (F.col("type") != "despesa").alias("has_active"),
    )
    return ops.patch_rows(base, edits, "id", ["value", "active"]).select(
        "id", "description", "value", "active"
    )


@query(
    "m04_delete_by_id",
    f"WITH {LEDGER_SQL} SELECT id, date, description, category, type, value FROM ledger WHERE description <> 'O'",
)
def m04(spark, sf):
    book = _book(spark, sf)
    gone = book.filter(F.col("description") == "O").select("id")
    return ops.delete_rows(book, gone, "id")


@query(
    "m05_replace_goals",
    f"WITH {LEDGER_SQL}, {GOALS_SQL} SELECT * FROM goals WHERE limit_value > 0",
)
def m05(spark, sf):
    kept = ops.replace_goals(goals(spark, sf))
    return ops.write_version(kept, scratch_path(spark, "m05"), 1)


@query(
    "m06_import_absent",
    f"""WITH {LEDGER_SQL},
         present AS (SELECT id, date, value FROM ledger WHERE description <> 'P'),
         incoming AS (SELECT l_orderkey AS id, CAST(l_shipdate AS DATE) AS date,
             l_extendedprice AS value, l_linenumber, l_partkey, l_suppkey FROM lineitem
             QUALIFY row_number() OVER (PARTITION BY l_orderkey
               ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1)
       SELECT id, date, value FROM present
       UNION ALL SELECT id, date, value FROM incoming WHERE id NOT IN (SELECT id FROM present)""",
)
def m06(spark, sf):
    present = ledger(spark, sf).filter(F.col("description") != "P").select("id", "date", "value")
    incoming = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("value"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
    order = ["l_linenumber", "date", "l_partkey", "l_suppkey", "value"]
    return ops.import_rows(present, incoming, "id", order)


@query(
    "m07_upsert_goals",
    """WITH base AS (SELECT n_name AS category, 10.0 AS limit_value FROM nation),
         inc AS (SELECT n_name AS category, s_suppkey AS seq,
             COALESCE(nullif(CASE WHEN s_acctbal > 5000 THEN s_acctbal ELSE 0.0 END, 0.0), s_acctbal - 1000) AS lim
           FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 2
           UNION ALL SELECT s_name, s_suppkey, s_acctbal FROM supplier),
         last AS (SELECT category, lim FROM inc WHERE lim > 0
           QUALIFY row_number() OVER (PARTITION BY category ORDER BY seq DESC) = 1)
       SELECT COALESCE(b.category, l.category) AS category,
         CAST(COALESCE(lim, limit_value) AS DOUBLE) AS limit_value
       FROM base b FULL JOIN last l ON b.category = l.category""",
)
def m07(spark, sf):
    nations = table(spark, sf, "nation")
    base = nations.select(F.col("n_name").alias("category"), F.lit(10.0).alias("limit_value"))
    suppliers = table(spark, sf, "supplier")
    by_nation = suppliers.join(
        nations.filter(F.col("n_regionkey") != 2), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("n_name").alias("category"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_acctbal")).otherwise(0.0).alias("limit_value"),
        (F.col("s_acctbal") - 1000).alias("limit"),
        F.col("s_suppkey").alias("seq"),
    )
    by_name = suppliers.select(
        F.col("s_name").alias("category"),
        F.lit(None).cast("double").alias("limit_value"),
        F.col("s_acctbal").alias("limit"),
        F.col("s_suppkey").alias("seq"),
    )
    return ops.upsert_goals(base, by_nation.unionByName(by_name), "seq")


@query(
    "m08_generate_recurring",
    f"""WITH {LEDGER_SQL}, {RECURRING_SQL}
       SELECT substring(sha256(id || '-1996-02'), 1, 16) AS id,
         make_date(1996, 2, least(day_of_month, 29)) AS date, description, category, type, value,
         CAST(id AS VARCHAR) AS recurring_id FROM recurring
       WHERE active = 1 AND id NOT IN (SELECT recurring_id FROM ledger
         WHERE date >= DATE '1996-02-01' AND date < DATE '1996-03-01')""",
)
def m08(spark, sf):
    return ops.generate_recurring(ledger(spark, sf), recurring(spark, sf), 1996, 2)


@query(
    "m09_constraint_violations",
    f"""WITH {LEDGER_SQL}, c AS (SELECT id, nullif(description, 'P') AS description, type, value,
           day(date) AS day FROM ledger)
       SELECT id, 'description not null' AS rule FROM c WHERE description IS NULL
       UNION ALL SELECT id, 'type known' FROM c WHERE type NOT IN ('receita')
       UNION ALL SELECT id, 'value positive' FROM c WHERE NOT value > 5000
       UNION ALL SELECT id, 'day in month' FROM c WHERE NOT day BETWEEN 1 AND 28""",
)
def m09(spark, sf):
    df = ledger(spark, sf).withColumn("description", F.nullif("description", F.lit("P")))
    rules = {
        **quality.not_null_rules(["description"]),
        "type known": F.col("type").isin("receita"),
        "value positive": F.col("value") > 5000,
        "day in month": F.day("date").between(1, 28),
    }
    return quality.violations(df, "id", rules)


@query(
    "m09_repeated_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2
       HAVING count(*) > 1""",
)
def m09_keys(spark, sf):
    return quality.repeated_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


def _log(spark, sf, *extra):
    return table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("key"), *extra
    )


@query(
    "m10_latest_value",
    """SELECT CAST(user_id AS VARCHAR) AS key, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def m10(spark, sf):
    return keyvalue.latest(_log(spark, sf, "value"))


@query(
    "m10_get",
    """SELECT CAST(user_id AS VARCHAR) AS key, value FROM events WHERE user_id = 46
       ORDER BY event_id DESC LIMIT 1""",
)
def m10_get(spark, sf):
    return keyvalue.get(_log(spark, sf, "value"), "46")


@query(
    "m11_list_items",
    """SELECT CAST(user_id AS VARCHAR) AS key,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, event_type AS item
       FROM events""",
)
def m11(spark, sf):
    return keyvalue.list_items(_log(spark, sf, F.col("event_type").alias("item")))


@query(
    "m11_list_range",
    """WITH l AS (SELECT CAST(user_id AS VARCHAR) AS key, event_type AS item,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos,
           count(*) OVER (PARTITION BY user_id) AS n FROM events)
       SELECT key, pos, item FROM l WHERE pos >= 1 AND pos <= n - 2""",
)
def m11_range(spark, sf):
    return keyvalue.list_range(_log(spark, sf, F.col("event_type").alias("item")), 1, -2)


@query(
    "m12_hash_fields",
    """SELECT CAST(user_id AS VARCHAR) AS key, event_type AS field, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
)
def m12(spark, sf):
    return keyvalue.hash_fields(_log(spark, sf, F.col("event_type").alias("field"), "value"))


@query(
    "m12_hash_get_all",
    """SELECT event_type AS field, value FROM events WHERE user_id = 46
       QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) = 1""",
)
def m12_get_all(spark, sf):
    log = _log(spark, sf, F.col("event_type").alias("field"), "value")
    return keyvalue.hash_get_all(log, "46")
