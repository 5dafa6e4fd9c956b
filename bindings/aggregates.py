"""Aggregates, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.functions.numbers import exact_avg, exact_sum
from marquetry.operators import aggregates as ops
from marquetry.operators import ordering
from marquetry.operators.projections import preview
from marquetry.plans import production
from marquetry.session import scratch_path
from marquetry.sources import counts
from marquetry.sources.writers import write_jsonl

from .registry import query
from .tables import (
    LEDGER_SQL,
    PARENTS_SQL,
    RECURRING_SQL,
    ledger,
    mean,
    money,
    parents,
    recurring,
    table,
)

YEAR = "CAST(year(o_orderdate) AS INTEGER)"


def _orders_by_year(spark, sf):
    return table(spark, sf, "orders").withColumn("ano", F.year(F.col("o_orderdate").cast("date")))


@query("a01_row_count", "SELECT count(*) AS n FROM lineitem")
def a01(spark, sf):
    return ops.row_count(table(spark, sf, "lineitem"))


@query("a01_footer_count", "SELECT count(*) AS n FROM lineitem")
def a01_footers(spark, sf):
    return counts.footer_count(spark, f"{sf}/lineitem.parquet")


@query(
    "a01_estimated_count",
    """SELECT CAST(count(*) AS BIGINT) AS n, true AS within_bounds, true AS close, CAST(16 AS BIGINT) AS files_read,
         CAST(48 AS BIGINT) AS files FROM orders""",
)
def a01_estimate(spark, sf):
    """Orders as JSON lines in 48 files, 16 of which are read; the exact count comes from footers."""
    path = scratch_path(spark, "orders")
    write_jsonl(table(spark, sf, "orders").repartition(48, "o_orderkey"), path)
    n = counts.footer_count(spark, f"{sf}/orders.parquet").first()["n"]
    found = counts.estimated_lines(spark, path, files=16)
    return found.select(
        F.lit(n).cast("long").alias("n"),
        (F.lit(n).between(F.col("low"), F.col("high")) & (F.col("high") - F.col("low") < n / 10)).alias("within_bounds"),
        (F.abs(F.col("estimate") - n) <= n / 50).alias("close"),
        "files_read",
        "files",
    )


@query("a02_distinct_labels", "SELECT DISTINCT c_mktsegment FROM customer")
def a02(spark, sf):
    return ops.distinct_labels(table(spark, sf, "customer"), "c_mktsegment")


@query("a03_group_count_year", f"SELECT {YEAR} AS ano, count(*) AS total FROM orders GROUP BY 1")
def a03_year(spark, sf):
    return ops.group_count(_orders_by_year(spark, sf), "ano")


@query(
    "a03_group_count_role",
    "SELECT l_returnflag, count(*) AS total FROM lineitem GROUP BY l_returnflag",
)
def a03_role(spark, sf):
    return ops.group_count(table(spark, sf, "lineitem"), "l_returnflag")


@query(
    "a04_group_mean",
    f"SELECT c_mktsegment, {mean('c_acctbal')} AS mean FROM customer GROUP BY 1 ORDER BY mean DESC",
)
def a04(spark, sf):
    return ops.group_mean(table(spark, sf, "customer"), ["c_mktsegment"], "c_acctbal")


@query(
    "a05_group_mean_two_keys",
    f"""SELECT o_orderstatus, o_orderpriority, {mean("o_totalprice")} AS mean FROM orders
       WHERE o_orderpriority <> '5-LOW' GROUP BY ALL""",
)
def a05(spark, sf):
    df = table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))
    )
    return ops.group_mean(df, ["o_orderstatus", "o_orderpriority"], "o_totalprice")


@query(
    "a06_avg_and_sum",
    f"""SELECT o_orderpriority, {mean("o_totalprice")} AS media, {money("o_totalprice")} AS total
       FROM orders GROUP BY 1 ORDER BY total DESC""",
)
def a06(spark, sf):
    price = F.col("o_totalprice")
    sums = ops.group_totals(
        table(spark, sf, "orders"), ["o_orderpriority"], media=exact_avg(price), total=exact_sum(price)
    )
    return ordering.sort_by(sums, "-total", "o_orderpriority")


@query(
    "a07_sum_by_two_keys",
    f"""SELECT o_orderpriority, o_custkey, {money("o_totalprice")} AS total FROM orders
       GROUP BY 1, 2 ORDER BY total DESC""",
)
def a07(spark, sf):
    sums = ops.group_totals(
        table(spark, sf, "orders"),
        ["o_orderpriority", "o_custkey"],
        total=exact_sum(F.col("o_totalprice")),
    )
    return ordering.sort_by(sums, "-total", "o_orderpriority", "o_custkey")


@query("a08_global_mean", f"SELECT {mean('l_extendedprice')} AS mean FROM lineitem")
def a08(spark, sf):
    return ops.global_mean(table(spark, sf, "lineitem"), "l_extendedprice")


@query(
    "a09_smallest_row",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 1",
)
def a09_min(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return ops.extreme_row(df, "c_acctbal", "c_custkey", largest=False)


@query(
    "a09_largest_row",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1",
)
def a09_max(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return ops.extreme_row(df, "c_acctbal", "c_custkey")


@query(
    "a11_extreme_groups",
    f"""WITH m AS (SELECT c_mktsegment, {mean("c_acctbal")} AS mean FROM customer GROUP BY 1)
       (SELECT *, 'highest' AS which FROM m ORDER BY mean DESC, c_mktsegment LIMIT 1)
       UNION ALL (SELECT *, 'lowest' FROM m ORDER BY mean, c_mktsegment LIMIT 1)""",
)
def a11(spark, sf):
    return ops.extreme_groups(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal")


REPORT_SQL = f"""WITH raw AS (SELECT
      CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS id_producao,
      l_suppkey AS id_pessoa, ' ' || l_returnflag || CASE WHEN l_linestatus = 'F' THEN '  x' ELSE ' x' END AS papel
      FROM lineitem), {PARENTS_SQL},
    f AS (SELECT *, trim(regexp_replace(papel, '\\s+', ' ', 'g')) AS limpo,
      CASE WHEN id_producao IS NULL THEN 'null'
        WHEN id_pessoa NOT IN (SELECT s_suppkey FROM people)
          OR id_producao NOT IN (SELECT o_orderkey FROM works) THEN 'orphan' ELSE 'ok' END AS status
      FROM raw)"""


def _raw_crew(spark, sf):
    """Lines as crew rows with missing keys and untidy roles."""
    tail = F.when(F.col("l_linestatus") == "F", "  x").otherwise(" x")
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("id_producao"),
        F.col("l_suppkey").alias("id_pessoa"),
        F.concat(F.lit(" "), "l_returnflag", tail).alias("papel"),
        F.lit(None).cast("string").alias("_corrupt_record"),
        F.lit(None).cast("string").alias("_invalid_number"),
    )


@query(
    "a19_quality_report",
    REPORT_SQL
    + """ SELECT 'equipe' AS dataset, count(*) AS lidos,
         count(DISTINCT CASE WHEN status = 'ok' THEN (id_producao, id_pessoa, limpo) END) AS escritos,
         count(CASE WHEN status = 'ok' THEN 1 END)
           - count(DISTINCT CASE WHEN status = 'ok' THEN (id_producao, id_pessoa, limpo) END) AS duplicatas,
         count(CASE WHEN status = 'null' THEN 1 END) AS nulos_removidos,
         CAST(0 AS BIGINT) AS titulos_nulos,
         count(CASE WHEN status = 'ok' AND limpo <> papel THEN 1 END) AS correcoes,
         count(CASE WHEN status = 'orphan' THEN 1 END) AS orfaos,
         CAST(0 AS BIGINT) AS erros_parse, CAST(0 AS BIGINT) AS ids_invalidos FROM f""",
)
def a19(spark, sf):
    people, works = parents(spark, sf)
    return production.quality_report(
        production.crew_by_key(_raw_crew(spark, sf), people, works), "equipe"
    )


@query(
    "a19_clean_crew",
    REPORT_SQL + " SELECT DISTINCT id_producao, id_pessoa, limpo AS papel FROM f WHERE status = 'ok'",
)
def a19_rows(spark, sf):
    people, works = parents(spark, sf)
    return production.clean_rows(production.crew_by_key(_raw_crew(spark, sf), people, works))


@query(
    "a21_profile",
    """SELECT count(*) AS rows, 11 AS cols, count(*) * 11 AS size,
         'l_orderkey:bigint, l_partkey:bigint, l_suppkey:bigint, l_linenumber:int, '
         || 'l_quantity:double, l_extendedprice:double, l_discount:double, l_tax:double, '
         || 'l_returnflag:string, l_linestatus:string, l_shipdate:timestamp_ntz' AS dtypes
       FROM lineitem""",
)
def a21(spark, sf):
    return ops.profile(table(spark, sf, "lineitem"))


@query(
    "a22_distinct_rows",
    "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
)
def a22(spark, sf):
    return ops.unique_rows(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "o01_sort",
    f"""SELECT o_orderkey, o_orderpriority, {YEAR} AS ano FROM orders
       ORDER BY o_orderpriority, ano, o_orderkey""",
)
def o01(spark, sf):
    df = _orders_by_year(spark, sf).select("o_orderkey", "o_orderpriority", "ano")
    return ordering.sort_by(df, "o_orderpriority", "ano", "o_orderkey")


@query(
    "o02_most_common",
    """SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY 1
       ORDER BY total DESC, l_suppkey LIMIT 20""",
)
def o02(spark, sf):
    return ordering.most_common(table(spark, sf, "lineitem"), "l_suppkey", 20)


@query(
    "o03_top_then_by_label",
    f"""SELECT CAST(ano AS VARCHAR) AS ano, total FROM (
         SELECT {YEAR} AS ano, count(*) AS total FROM orders GROUP BY 1
         ORDER BY total DESC, ano LIMIT 3) ORDER BY ano""",
)
def o03(spark, sf):
    return production.productions_per_year(_orders_by_year(spark, sf), 3)


@query(
    "o04_top_rows",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def o04(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ordering.top_k(df, "o_totalprice", "o_orderkey", 10)


@query(
    "o05_bottom_rows",
    """SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 10""",
)
def o05_bottom(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return ordering.top_k(df, "p_retailprice", "p_partkey", 10, ascending=True)


@query(
    "o05_top_rows",
    """SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10""",
)
def o05_top(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return ordering.top_k(df, "p_retailprice", "p_partkey", 10)


@query(
    "o07_order_by_date",
    f"WITH {LEDGER_SQL} SELECT id, date, value FROM ledger ORDER BY date DESC, id DESC",
)
def o07_date(spark, sf):
    return ordering.sort_by(ledger(spark, sf).select("id", "date", "value"), "-date", "-id")


@query(
    "o07_order_by_day",
    f"WITH {RECURRING_SQL} SELECT id, day_of_month, value FROM recurring ORDER BY day_of_month, id",
)
def o07_day(spark, sf):
    df = recurring(spark, sf).select("id", "day_of_month", "value")
    return ordering.sort_by(df, "day_of_month", "id")


@query(
    "o08_preview",
    "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 5",
)
def o08(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return preview(df, ["event_id"])
