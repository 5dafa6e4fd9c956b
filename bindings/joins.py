"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.operators import changes, joins, spines
from marquetry.plans import ledger as ledger_plan
from marquetry.schemas import CATEGORIES

from .registry import query
from .tables import (
    CREW_SQL,
    EXPENSE_SQL,
    GOALS_SQL,
    INCOME_SQL,
    LEDGER_SQL,
    PARENTS_SQL,
    RECURRING_SQL,
    crew,
    goals,
    ledger,
    money,
    parents,
    recurring,
    table,
)

@query(
    "j01_referential_integrity",
    f"""WITH {CREW_SQL}, {PARENTS_SQL} SELECT * FROM crew
       WHERE id_pessoa IN (SELECT s_suppkey FROM people)
         AND id_producao IN (SELECT o_orderkey FROM works)""",
)
def j01(spark, sf):
    people, works = parents(spark, sf)
    known = [(people, "id_pessoa"), (works, "id_producao")]
    return joins.keep_with_parents(crew(spark, sf), known)


@query(
    "j02_orphan_report",
    f"""WITH {CREW_SQL}, {PARENTS_SQL} SELECT CASE
         WHEN id_pessoa NOT IN (SELECT s_suppkey FROM people) THEN 'id_pessoa'
         WHEN id_producao NOT IN (SELECT o_orderkey FROM works) THEN 'id_producao'
         ELSE 'none' END AS missing, count(*) AS rows FROM crew GROUP BY 1""",
)
def j02(spark, sf):
    people, works = parents(spark, sf)
    return joins.orphan_report(crew(spark, sf), [(people, "id_pessoa"), (works, "id_producao")])


@query(
    "j02_orphans",
    f"""WITH {CREW_SQL}, {PARENTS_SQL} SELECT * FROM crew
       WHERE id_producao NOT IN (SELECT o_orderkey FROM works)""",
)
def j02_rows(spark, sf):
    return joins.orphans(crew(spark, sf), parents(spark, sf)[1], "id_producao")


@query(
    "j03_two_key_join",
    """WITH a AS (SELECT o_orderpriority AS local, CAST(year(o_orderdate) AS INTEGER) AS ano,
           count(*) AS docentes FROM orders GROUP BY ALL),
         b AS (SELECT o_orderpriority AS local, CAST(year(o_orderdate) AS INTEGER) AS ano,
           count(*) AS salas FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)
       SELECT a.local, a.ano, docentes, salas FROM a JOIN b ON a.local = b.local AND a.ano = b.ano""",
)
def j03(spark, sf):
    keyed = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("local"),
        F.year(F.col("o_orderdate").cast("date")).alias("ano"),
        "o_orderstatus",
    )
    teachers = keyed.groupBy("local", "ano").agg(F.count(F.lit(1)).alias("docentes"))
    rooms = (
        keyed.filter(F.col("o_orderstatus") == "F")
        .groupBy("local", "ano")
        .agg(F.count(F.lit(1)).alias("salas"))
    )
    return joins.match(teachers, rooms, ["local", "ano"])


def _spend(spark, sf, status, name):
    return (
        table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == status)
        .groupBy("o_custkey")
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias(name))
    )


@query(
    "j04_full_alignment",
    """WITH a AS (SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS one
           FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
         b AS (SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS two
           FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
       SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, one, two
       FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""",
)
def j04(spark, sf):
    return joins.align(_spend(spark, sf, "F", "one"), _spend(spark, sf, "P", "two"), ["o_custkey"])


@query(
    "j05_left_alignment",
    """SELECT o_orderkey, o_custkey, c.c_acctbal AS three FROM orders
       LEFT JOIN (SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0) c
         ON o_custkey = c.c_custkey""",
)
def j05(spark, sf):
    values = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    values = values.select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("three"))
    return joins.align_to(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"), values, ["o_custkey"]
    )


@query(
    "j06_goals_left_join_spend",
    f"""WITH {LEDGER_SQL}, {GOALS_SQL},
         s AS (SELECT category, {money("value")} AS spent FROM ledger
               WHERE type = 'despesa' AND category <> 'Aluguel' GROUP BY 1)
       SELECT g.category, g.limit_value, COALESCE(s.spent, 0.0) AS spent
       FROM goals g LEFT JOIN s ON g.category = s.category""",
)
def j06(spark, sf):
    book = ledger(spark, sf)
    spent = (
        book.filter((F.col("type") == "despesa") & (F.col("category") != "Aluguel"))
        .groupBy("category")
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("spent"))
    )
    return joins.fill_spine(goals(spark, sf), spent, ["category"], ["spent"])


@query(
    "j07_recurring_not_generated",
    f"""WITH {LEDGER_SQL}, {RECURRING_SQL} SELECT id, description, day_of_month FROM recurring
       WHERE active = 1 AND id NOT IN (SELECT recurring_id FROM ledger
         WHERE date >= DATE '1996-02-01' AND date < DATE '1996-03-01')""",
)
def j07(spark, sf):
    due = changes.due_recurring(ledger(spark, sf), recurring(spark, sf), 1996, 2)
    return due.select("id", "description", "day_of_month")


@query(
    "j08_absent_ids",
    """SELECT l_orderkey, count(*) AS n FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
       GROUP BY 1""",
)
def j08(spark, sf):
    incoming = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    known = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return joins.absent_from(
        incoming, known.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"]
    )


CATEGORY_VALUES = ", ".join(f"('{n}', '{i}', '{c}')" for n, i, c in CATEGORIES)


@query(
    "j09_category_lookup",
    f"""WITH {LEDGER_SQL}, dim(name, icon, color) AS (VALUES {CATEGORY_VALUES})
       SELECT id, category, COALESCE(icon, '{CATEGORIES[-1][1]}') AS icon,
         COALESCE(color, '{CATEGORIES[-1][2]}') AS color
       FROM ledger LEFT JOIN dim ON category = name""",
)
def j09(spark, sf):
    return ledger_plan.with_category_info(spark, ledger(spark, sf).select("id", "category"))


@query(
    "j09_dimension_lookup",
    """SELECT o_orderkey, o_custkey, COALESCE(c_mktsegment, 'Outros') AS c_mktsegment FROM orders
       LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 20) ON o_custkey = c_custkey""",
)
def j09_dimension(spark, sf):
    dim = table(spark, sf, "customer").filter(F.col("c_nationkey") < 20)
    facts = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return joins.lookup(facts, "o_custkey", dim, "c_custkey", {"c_mktsegment": "Outros"})


@query(
    "j10_month_spine",
    f"""WITH {LEDGER_SQL},
         m AS (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               {INCOME_SQL} AS receitas, {EXPENSE_SQL} AS despesas FROM ledger GROUP BY 1, 2),
         s AS (SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month
               FROM range((SELECT min(year(date)) FROM ledger), (SELECT max(year(date)) + 1 FROM ledger)) AS a(y), range(1, 13) AS b(m))
       SELECT s.year, s.month, COALESCE(receitas, 0.0) AS receitas, COALESCE(despesas, 0.0) AS despesas
       FROM s LEFT JOIN m ON s.year = m.year AND s.month = m.month""",
)
def j10(spark, sf):
    book = ledger(spark, sf)
    first, last = ledger_plan.period(book)
    return joins.fill_spine(
        spines.month_spine(spark, first.year, last.year),
        ledger_plan.monthly_flows(book),
        ["year", "month"],
        ["receitas", "despesas"],
    )
