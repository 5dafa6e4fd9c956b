"""Input tables and the views that stand for the library's data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Order priorities as ledger categories; the fourth is left unknown on purpose.
CATEGORY_OF = {
    "1-URGENT": "Aluguel",
    "2-HIGH": "Alimentação",
    "3-MEDIUM": "Transporte",
    "5-LOW": "Investimentos",
}


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as ledger rows."""
    category = F.col("o_orderpriority")
    for priority, name in CATEGORY_OF.items():
        category = F.when(F.col("o_orderpriority") == priority, name).otherwise(category)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderstatus").alias("description"),
        category.alias("category"),
        F.when(F.col("o_orderstatus") == "F", "receita").otherwise("despesa").alias("type"),
        F.col("o_totalprice").alias("value"),
        F.col("o_custkey").alias("recurring_id"),
    )


LEDGER_SQL = (
    "ledger AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, "
    "o_orderstatus AS description, CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{c}'" for p, c in CATEGORY_OF.items())
    + " ELSE o_orderpriority END AS category, "
    "CASE WHEN o_orderstatus = 'F' THEN 'receita' ELSE 'despesa' END AS type, "
    "o_totalprice AS value, o_custkey AS recurring_id FROM orders)"
)


def crew(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as crew rows."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id_producao"),
        F.col("l_suppkey").alias("id_pessoa"),
        F.col("l_returnflag").alias("papel"),
    )


CREW_SQL = (
    "crew AS (SELECT l_orderkey AS id_producao, l_suppkey AS id_pessoa, "
    "l_returnflag AS papel FROM lineitem)"
)


PARENTS_SQL = """works AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'),
    people AS (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""


def parents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Known people and works for the crew: suppliers in credit, urgent orders."""
    works = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    people = table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0)
    return (
        people.select(F.col("s_suppkey").alias("id_pessoa")),
        works.select(F.col("o_orderkey").alias("id_producao")),
    )


def recurring(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as templates of recurring entries."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("description"),
        F.col("c_mktsegment").alias("category"),
        F.when(F.col("c_acctbal") < 0, "despesa").otherwise("receita").alias("type"),
        F.abs("c_acctbal").alias("value"),
        (F.col("c_custkey") % 31 + 1).cast("int").alias("day_of_month"),
        F.when(F.col("c_nationkey") == 7, 0).otherwise(1).alias("active"),
    )


RECURRING_SQL = (
    "recurring AS (SELECT c_custkey AS id, c_name AS description, c_mktsegment AS category, "
    "CASE WHEN c_acctbal < 0 THEN 'despesa' ELSE 'receita' END AS type, "
    "abs(c_acctbal) AS value, CAST(c_custkey % 31 + 1 AS INTEGER) AS day_of_month, "
    "CASE WHEN c_nationkey = 7 THEN 0 ELSE 1 END AS active FROM customer)"
)


def goals(spark: SparkSession, sf: str) -> DataFrame:
    """A limit per ledger category, from the lines of each order priority; one is zero."""
    return (
        ledger(spark, sf)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "category",
            F.when(F.col("category") == "Transporte", 0.0)
            .otherwise(F.col("_n") * 200000.0)
            .alias("limit_value"),
        )
    )


GOALS_SQL = (
    "goals AS (SELECT category, CASE WHEN category = 'Transporte' THEN 0.0 "
    "ELSE CAST(count(*) * 200000.0 AS DOUBLE) END AS limit_value FROM ledger GROUP BY category)"
)


def amount(expr: str) -> str:
    """The digits that a float shows, as an exact decimal."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18))"


def as_double(decimal: str) -> str:
    return f"CAST(CAST({decimal} AS VARCHAR) AS DOUBLE)"


def money(expr: str) -> str:
    """Exact sum of money as SQL, 0 for no rows."""
    return f"COALESCE({as_double(f'SUM({amount(expr)})')}, 0.0)"


def balance(a: str, b: str) -> str:
    return as_double(f"{amount(a)} - {amount(b)}")


def mean(expr: str, places: int = 2) -> str:
    return f"round(CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE) / count({expr}), {places})"


INCOME_SQL = money("CASE WHEN type = 'receita' THEN value END")
EXPENSE_SQL = money("CASE WHEN type = 'despesa' THEN value END")
