"""Windows, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.functions.text import clean_text
from marquetry.operators import reshape
from marquetry.operators import windows as ops
from marquetry.operators.aggregates import unique_rows
from marquetry.operators.joins import keep_with_parents
from marquetry.operators.ordering import most_common

from .registry import query
from .tables import crew, parents, table

GROWTH_SQL = """y AS (SELECT o_orderpriority AS local, CAST(year(o_orderdate) AS INTEGER) AS ano,
      CAST(count(*) AS DOUBLE) AS docentes,
      CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE) AS salas
      FROM orders GROUP BY 1, 2),
    g AS (SELECT *,
      COALESCE(round((docentes / lag(docentes) OVER (PARTITION BY local ORDER BY ano) - 1) * 100, 2), 0.0) AS cresc,
      COALESCE(round((salas / lag(salas) OVER (PARTITION BY local ORDER BY ano) - 1) * 100, 2), 0.0) AS aux
      FROM y)"""


def _yearly(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("local"),
            F.year(F.col("o_orderdate").cast("date")).alias("ano"),
        )
        .agg(
            F.count(F.lit(1)).cast("double").alias("docentes"),
            F.count(F.when(F.col("o_orderstatus") == "F", 1)).cast("double").alias("salas"),
        )
    )


@query("w01_pct_change", f"WITH {GROWTH_SQL} SELECT local, ano, docentes, cresc FROM g")
def w01(spark, sf):
    return _yearly(spark, sf).select(
        "local", "ano", "docentes", ops.pct_change("docentes", "local", "ano").alias("cresc")
    )


@query(
    "w02_growth_gap",
    f"WITH {GROWTH_SQL} SELECT local, ano, cresc, aux, round(cresc - aux, 2) AS gap FROM g",
)
def w02(spark, sf):
    grown = _yearly(spark, sf).select(
        "local",
        "ano",
        ops.pct_change("docentes", "local", "ano").alias("cresc"),
        ops.pct_change("salas", "local", "ano").alias("aux"),
    )
    return grown.withColumn("gap", F.round(F.col("cresc") - F.col("aux"), 2))


@query(
    "w03_keep_first",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def w03(spark, sf):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    first = ops.keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "w04_rank_of",
    """SELECT count(CASE WHEN c_acctbal > (SELECT c_acctbal FROM customer WHERE c_custkey = 42)
         THEN 1 END) + 1 AS position,
         max(CASE WHEN c_custkey = 42 THEN c_acctbal END) AS c_acctbal FROM customer""",
)
def w04(spark, sf):
    return ops.rank_of(table(spark, sf, "customer"), "c_custkey", 42, "c_acctbal")


@query(
    "a10_largest_per_group",
    """SELECT c_mktsegment, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER
         (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) = 1""",
)
def a10_max(spark, sf):
    df = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return ops.extreme_per_group(df, "c_mktsegment", "c_acctbal", "c_custkey")


@query(
    "a10_smallest_per_group",
    """SELECT c_mktsegment, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER
         (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) = 1""",
)
def a10_min(spark, sf):
    df = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return ops.extreme_per_group(df, "c_mktsegment", "c_acctbal", "c_custkey", largest=False)


@query(
    "u01_concat",
    """SELECT c_custkey AS id, c_name AS nome FROM customer
       UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def u01(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nome")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome")
    )
    return reshape.concat(customers, suppliers)


@query(
    "u02_concat_different_fields",
    """SELECT c_custkey AS id, c_mktsegment AS segmento, CAST(NULL AS DOUBLE) AS saldo FROM customer
       UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def u02(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segmento")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("saldo")
    )
    return reshape.concat_loose(customers, suppliers)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "u03_melt",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{m}' AS medida, {m} AS valor FROM lineitem"
        for m in MEASURES
    ),
)
def u03(spark, sf):
    keys = ["l_orderkey", "l_linenumber"]
    df = table(spark, sf, "lineitem").select(*keys, *MEASURES)
    return reshape.melt(df, keys, MEASURES, "medida", "valor")


@query(
    "u04_split_label",
    """SELECT o_custkey,
         CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS fechado,
         CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS aberto
       FROM orders GROUP BY 1""",
)
def u04(spark, sf):
    split = reshape.split_label(
        table(spark, sf, "orders"),
        ["o_custkey"],
        "o_orderstatus",
        {"F": "fechado", "O": "aberto"},
        F.col("o_totalprice").cast("decimal(18,2)"),
    )
    return split.select(
        "o_custkey", *[F.col(c).cast("double").alias(c) for c in ("fechado", "aberto")]
    )


@query(
    "u05_transpose",
    """WITH s AS (SELECT o_orderstatus AS st, CAST(count(*) AS DOUBLE) AS pedidos,
           max(o_totalprice) AS maior FROM orders GROUP BY 1)
       SELECT 'pedidos' AS medida, max(CASE WHEN st = 'F' THEN pedidos END) AS "F",
         max(CASE WHEN st = 'O' THEN pedidos END) AS "O", max(CASE WHEN st = 'P' THEN pedidos END) AS "P" FROM s
       UNION ALL SELECT 'maior', max(CASE WHEN st = 'F' THEN maior END),
         max(CASE WHEN st = 'O' THEN maior END), max(CASE WHEN st = 'P' THEN maior END) FROM s""",
)
def u05(spark, sf):
    report = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("st")).agg(
        F.count(F.lit(1)).cast("double").alias("pedidos"), F.max("o_totalprice").alias("maior")
    )
    return reshape.transpose(report, "st", ["F", "O", "P"], "medida")


@query(
    "u05_transpose_labels",
    """WITH s AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL
             WHEN o_orderpriority LIKE '2%' THEN '1-URGENT' ELSE o_orderpriority END AS st,
           CAST(count(*) AS DOUBLE) AS pedidos, max(o_totalprice) AS maior FROM orders GROUP BY o_orderpriority),
         u AS (SELECT st, 'pedidos' AS medida, pedidos AS v FROM s UNION ALL SELECT st, 'maior', maior FROM s)
       SELECT medida, max(CASE WHEN st = '1-URGENT' THEN v END) AS "1-URGENT",
         max(CASE WHEN st IS NULL THEN v END) AS sem, max(CASE WHEN st = 'x' THEN v END) AS x FROM u GROUP BY 1""",
)
def u05_labels(spark, sf):
    """A label that two rows share, one that is NULL, and one without a row."""
    priority = F.col("o_orderpriority")
    label = F.when(priority.startswith("2"), "1-URGENT").otherwise(F.nullif(priority, F.lit("5-LOW")))
    report = (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).cast("double").alias("pedidos"), F.max("o_totalprice").alias("maior"))
        .select(label.alias("st"), "pedidos", "maior")
    )
    return reshape.transpose(report, "st", ["1-URGENT", None, "x"], "medida", null_name="sem")


@query(
    "entry_common_roles",
    """WITH c AS (SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag AS papel FROM lineitem
         WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
           AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))
       SELECT papel, count(*) AS total FROM c GROUP BY 1 ORDER BY total DESC, papel LIMIT 10""",
)
def common_roles(spark, sf):
    """Crew of known people and works, cleaned and without copies: the ten commonest roles."""
    people, works = parents(spark, sf)
    rows = crew(spark, sf)
    cleaned = rows.withColumn("papel", clean_text(F.col("papel")))
    unique = unique_rows(cleaned, "id_producao", "id_pessoa", "papel")
    known = [(people, "id_pessoa"), (works, "id_producao")]
    valid = keep_with_parents(unique, known)
    return most_common(valid, "papel", 10)
