"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.functions.presence import active_positive, all_present
from marquetry.operators import projections as ops
from marquetry.plans import ledger as ledger_plan

from .registry import query
from .tables import LEDGER_SQL, RECURRING_SQL, ledger, recurring, table


@query(
    "p01_required_keys",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
       WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
)
def p01(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return ops.require_keys(df, "o_orderstatus", "o_orderpriority")


@query("p02_not_null", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def p02(spark, sf):
    status = F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus")
    return table(spark, sf, "orders").select("o_orderkey", status).filter(all_present("o_orderstatus"))


@query(
    "p03_equals",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def p03(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return ops.equals(df, "c_mktsegment", "BUILDING")


@query(
    "p04_optional_filter",
    "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_nationkey = 3",
)
def p04(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return ops.equals_if(df, c_mktsegment=None, c_nationkey=3)


@query(
    "p05_month_filter",
    f"""WITH {LEDGER_SQL} SELECT id, date, type, value FROM ledger
       WHERE date >= DATE '1996-02-01' AND date < DATE '1996-03-01' ORDER BY date, id""",
)
def p05(spark, sf):
    df = ledger(spark, sf).select("id", "date", "type", "value")
    return ledger_plan.transactions_of(df, 1996, 2)


@query(
    "p05_year_filter",
    f"""WITH {LEDGER_SQL} SELECT id, date, type, value FROM ledger
       WHERE year(date) = 1997 ORDER BY date, id""",
)
def p05_year(spark, sf):
    df = ledger(spark, sf).select("id", "date", "type", "value")
    return ledger_plan.transactions_of(df, 1997)


@query(
    "p06_regex_search",
    """SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'RED.*(ring|bolt)', 'i')
       ORDER BY p_partkey LIMIT 50""",
)
def p06(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name")
    return ops.search(df, "p_name", "RED.*(ring|bolt)", "p_partkey")


@query(
    "p07_substring_search",
    f"""WITH {LEDGER_SQL} SELECT id, description, category, type FROM ledger
       WHERE contains(lower(description), 'p') OR contains(lower(category), 'p')""",
)
def p07(spark, sf):
    df = ledger(spark, sf).select("id", "description", "category", "type")
    return ledger_plan.search(df, "P")


@query(
    "p08_equals_maximum",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)""",
)
def p08(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ops.at_maximum(df, "o_totalprice")


@query(
    "p09_above_average",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)""",
)
def p09(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ops.above_average(df, "o_totalprice")


@query("p10_rename", "SELECT s_suppkey AS id, s_name AS nome, s_acctbal AS saldo FROM supplier")
def p10(spark, sf):
    names = {"s_suppkey": "id", "s_name": "nome", "s_acctbal": "saldo"}
    return ops.rename(table(spark, sf, "supplier"), names)


@query("p11_drop_column", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def p11_rest(spark, sf):
    return ops.pop(table(spark, sf, "supplier"), "s_acctbal")[0]


@query("p11_popped_column", "SELECT s_acctbal FROM supplier")
def p11_popped(spark, sf):
    return ops.pop(table(spark, sf, "supplier"), "s_acctbal")[1]


@query(
    "p12_reindex",
    """SELECT p_partkey, CAST(NULL AS VARCHAR) AS p_comment, p_size,
         CAST(NULL AS DOUBLE) AS p_cost FROM part""",
)
def p12(spark, sf):
    wanted = {"p_partkey": "long", "p_comment": "string", "p_size": "int", "p_cost": "double"}
    return ops.reindex(table(spark, sf, "part"), wanted)


@query(
    "p13_computed_columns",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice + l_quantity, 2) AS total,
         round(l_extendedprice * 0.10, 3) AS imposto FROM lineitem""",
)
def p13(spark, sf):
    df = table(spark, sf, "lineitem")
    total = F.round(F.col("l_extendedprice") + F.col("l_quantity"), 2)
    tax = F.round(F.col("l_extendedprice") * F.lit(0.10), 3)
    return ops.computed(df, {"total": total, "imposto": tax}).select(
        "l_orderkey", "l_linenumber", "total", "imposto"
    )


@query(
    "p14_if_column",
    "SELECT c_custkey, lower(c_mktsegment) AS c_mktsegment FROM customer",
)
def p14(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    segment = F.lower("c_mktsegment")
    df = ops.if_column(df, "c_mktsegment", lambda d: d.withColumn("c_mktsegment", segment))
    return ops.if_column(df, "absent", lambda d: d.drop("c_mktsegment"))


@query(
    "p15_threshold_case",
    """SELECT c_custkey, CASE WHEN c_acctbal < 30 THEN 'Desenvolvedor' ELSE 'Gerente' END AS cargo,
         CASE WHEN c_acctbal < 30 THEN 7000 ELSE 12000 END AS salario, 'TI' AS setor
       FROM customer""",
)
def p15(spark, sf):
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey",
        ops.threshold(balance, 30, "Desenvolvedor", "Gerente").alias("cargo"),
        ops.threshold(balance, 30, 7000, 12000).alias("salario"),
        F.lit("TI").alias("setor"),
    )


@query("p16_trim_headers", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def p16(spark, sf):
    df = table(spark, sf, "supplier")
    return ops.trim_headers(df.toDF(*[f"  {c} " for c in df.columns]))


@query(
    "p17_row_range",
    "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 50 OFFSET 100",
)
def p17(spark, sf):
    return ops.row_range(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", 100, 150)


@query(
    "p17_row_range_long",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10500 OFFSET 2000",
)
def p17_long(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return ops.row_range(df, "o_orderkey", 2000, 12500)


@query(
    "p17_row_range_text_key",
    """SELECT l_orderkey, l_linenumber, l_shipmode FROM (SELECT l_orderkey, l_linenumber, l_returnflag AS l_shipmode,
         row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber) - 1 AS pos FROM lineitem)
       WHERE pos >= 500 AND pos < 20500""",
)
def p17_text(spark, sf):
    """A text key with ties, which the other columns break, and a long slice."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("l_shipmode"))
    return ops.row_range(df, "l_shipmode", 500, 20_500)


@query(
    "p18_active_positive",
    f"""WITH {RECURRING_SQL} SELECT id, category, value FROM recurring
       WHERE active = 1 AND value > 0""",
)
def p18(spark, sf):
    return recurring(spark, sf).filter(active_positive("active", "value")).select("id", "category", "value")
