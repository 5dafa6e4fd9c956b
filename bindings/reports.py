"""Reports of the jobs: ledger, education, salaries and outbreaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.functions.dates import MONTHS
from marquetry.operators.aggregates import share_of_total
from marquetry.plans import education, outbreaks, salary
from marquetry.plans import ledger as plan

from .registry import query
from .tables import (
    EXPENSE_SQL,
    GOALS_SQL,
    INCOME_SQL,
    LEDGER_SQL,
    goals,
    ledger,
    mean,
    amount,
    as_double,
    balance,
    money,
    table,
)

SAVINGS_SQL = "CASE WHEN receitas > 0 THEN (receitas - despesas) / receitas * 100 ELSE 0.0 END"
INVEST_SQL = money("CASE WHEN type = 'despesa' AND category = 'Investimentos' THEN value END")


@query(
    "a12_monthly_kpis",
    f"""WITH {LEDGER_SQL}, k AS (SELECT strftime(date, '%Y-%m') AS mes, {INCOME_SQL} AS receitas,
           {EXPENSE_SQL} AS despesas, {INVEST_SQL} AS investimentos FROM ledger GROUP BY 1)
       SELECT mes, receitas, despesas, investimentos, {balance("receitas", "despesas")} AS saldo,
         round({SAVINGS_SQL}, 1) AS economia,
         CASE WHEN {SAVINGS_SQL} >= 30 THEN 'Excelente' WHEN {SAVINGS_SQL} >= 15 THEN 'Bom'
           WHEN {SAVINGS_SQL} >= 0 THEN 'Atenção' ELSE 'Crítico' END AS saude FROM k""",
)
def a12(spark, sf):
    book = ledger(spark, sf).withColumn("mes", F.date_format("date", "yyyy-MM"))
    return plan.kpis(book, ["mes"])


@query(
    "a12_monthly_kpis_of_all_months",
    f"""WITH {LEDGER_SQL}, f AS (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           {INCOME_SQL} AS receitas, {EXPENSE_SQL} AS despesas, {INVEST_SQL} AS investimentos, count(*) AS n
           FROM ledger GROUP BY 1, 2),
         s AS (SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month
           FROM range(1990, 2005) AS a(y), range(1, 13) AS b(m)),
         k AS (SELECT s.year, s.month, COALESCE(receitas, 0.0) AS receitas, COALESCE(despesas, 0.0) AS despesas,
           COALESCE(investimentos, 0.0) AS investimentos, n FROM s LEFT JOIN f ON s.year = f.year AND s.month = f.month)
       SELECT year, month, receitas, despesas, investimentos, {balance("receitas", "despesas")} AS saldo,
         round({SAVINGS_SQL}, 1) AS economia, CASE WHEN n IS NULL THEN 'Sem dados'
           WHEN {SAVINGS_SQL} >= 30 THEN 'Excelente' WHEN {SAVINGS_SQL} >= 15 THEN 'Bom'
           WHEN {SAVINGS_SQL} >= 0 THEN 'Atenção' ELSE 'Crítico' END AS saude FROM k""",
)
def a12_all_months(spark, sf):
    """Months without rows are there, too."""
    return plan.monthly_kpis(spark, ledger(spark, sf), 1990, 2004)


# Amounts with more than two decimals: fractions of a cent count.
FINER_SQL = LEDGER_SQL.replace("o_totalprice AS value", "o_totalprice / 8000 + 0.004 AS value")


@query(
    "a12_kpis_of_finer_values",
    f"""WITH {FINER_SQL}, k AS (SELECT strftime(date, '%Y-%m-%d') AS dia, {INCOME_SQL} AS receitas,
           {EXPENSE_SQL} AS despesas, {INVEST_SQL} AS investimentos FROM ledger GROUP BY 1)
       SELECT dia, receitas, despesas, investimentos, {balance("receitas", "despesas")} AS saldo,
         round({SAVINGS_SQL}, 1) AS economia,
         CASE WHEN {SAVINGS_SQL} >= 30 THEN 'Excelente' WHEN {SAVINGS_SQL} >= 15 THEN 'Bom'
           WHEN {SAVINGS_SQL} >= 0 THEN 'Atenção' ELSE 'Crítico' END AS saude FROM k""",
)
def a12_finer(spark, sf):
    book = ledger(spark, sf).withColumn("value", F.col("value") / 8000 + F.lit(0.004))
    return plan.kpis(book.withColumn("dia", F.date_format("date", "yyyy-MM-dd")), ["dia"])


@query(
    "o06_top_categories_of_finer_values",
    f"""WITH {FINER_SQL} SELECT category, {money("value")} AS total FROM ledger
       WHERE type = 'despesa' AND year(date) = 1996 GROUP BY 1 ORDER BY total DESC, category LIMIT 5""",
)
def o06_finer(spark, sf):
    return plan.top_categories(ledger(spark, sf).withColumn("value", F.col("value") / 8000 + F.lit(0.004)), 1996)


MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
SUMMARY_SQL = f"""{LEDGER_SQL},
    flows AS (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
      {INCOME_SQL} AS receitas, {EXPENSE_SQL} AS despesas FROM ledger GROUP BY 1, 2),
    spine AS (SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month
      FROM range((SELECT min(year(date)) FROM ledger), (SELECT max(year(date)) + 1 FROM ledger)) AS a(y), range(1, 13) AS b(m)),
    filled AS (SELECT s.year, s.month, COALESCE(receitas, 0.0) AS receitas,
      COALESCE(despesas, 0.0) AS despesas
      FROM spine s LEFT JOIN flows f ON s.year = f.year AND s.month = f.month),
    summary AS (SELECT *, {balance("receitas", "despesas")} AS saldo, ({MONTHS_SQL})[month] AS name,
      round({SAVINGS_SQL}, 1) AS economia FROM filled)"""


def _summary(spark, sf):
    book = ledger(spark, sf)
    first, last = plan.period(book)
    return plan.annual_summary(spark, book, first.year, last.year)


@query("a13_annual_summary", f"WITH {SUMMARY_SQL} SELECT * FROM summary")
def a13(spark, sf):
    return _summary(spark, sf)


@query(
    "a14_annual_totals",
    f"""WITH {SUMMARY_SQL} SELECT year, {money("receitas")} AS total_receitas,
         {money("despesas")} AS total_despesas, {money("saldo")} AS saldo_anual,
         COALESCE(round(CAST(SUM(CASE WHEN receitas > 0 OR despesas > 0
             THEN CAST(economia AS DECIMAL(18,1)) END) AS DOUBLE)
           / nullif(count(CASE WHEN receitas > 0 OR despesas > 0 THEN 1 END), 0), 1), 0.0)
           AS media_economia FROM summary GROUP BY year""",
)
def a14(spark, sf):
    return plan.annual_totals(_summary(spark, sf))


@query(
    "a15_spend_by_category",
    f"""WITH {LEDGER_SQL}, s AS (SELECT category, {money("value")} AS total FROM ledger
           WHERE type = 'despesa' GROUP BY 1)
       SELECT category, total, round(total / (SELECT {money("value")} FROM ledger
         WHERE type = 'despesa') * 100, 1) AS share FROM s""",
)
def a15(spark, sf):
    return plan.spend_by_category(ledger(spark, sf))


@query(
    "a15_share_fine_values",
    """WITH v AS (SELECT l_shipmode_part AS grupo, CAST(SUM(CAST(l_discount * 0.004 AS DECIMAL(38,10))) AS DOUBLE) AS total
           FROM (SELECT *, l_returnflag AS l_shipmode_part FROM lineitem) GROUP BY 1)
       SELECT grupo, total, round(total / (SELECT CAST(SUM(CAST(total AS DECIMAL(38,10))) AS DOUBLE) FROM v) * 100, 1)
         AS share FROM v""",
)
def a15_fine(spark, sf):
    """Values far below a cent."""
    values = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("grupo"), (F.col("l_discount") * 0.004).alias("value")
    )
    return share_of_total(values, ["grupo"], "value")


@query(
    "education_fractional",
    """SELECT o_orderpriority AS "Localidade", CAST(count(*) + 0.5 AS DOUBLE) AS "Docentes",
         CAST(count(*) * 2 + 0.25 AS DOUBLE) AS "Salas" FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1""",
)
def education_fractional(spark, sf):
    """Numbers with decimals in the wide table stay as they are."""
    year = F.year(F.col("o_orderdate").cast("date"))
    counted = table(spark, sf, "orders").filter(year == 1996).groupBy(F.col("o_orderpriority").alias("Localidade"))
    counted = counted.agg(F.count(F.lit(1)).alias("n"))
    shown = [
        counted.select("Localidade", F.lit(name).alias("Variável"), F.concat(whole.cast("string"), F.lit(tail)).alias("1996"))
        for name, whole, tail in ((education.TEACHERS, F.col("n"), ",5"), (education.CLASSROOMS, F.col("n") * 2, ",25"))
    ]
    return education.long_table(shown[0].unionByName(shown[1]), ["1996"]).select("Localidade", "Docentes", "Salas")


@query(
    "a16_goal_progress",
    f"""WITH {LEDGER_SQL}, {GOALS_SQL},
         s AS (SELECT category, {money("value")} AS spent FROM ledger WHERE type = 'despesa' GROUP BY 1),
         j AS (SELECT g.category, limit_value, COALESCE(spent, 0.0) AS spent FROM goals g
           LEFT JOIN s ON g.category = s.category WHERE limit_value > 0),
         p AS (SELECT *, spent / limit_value * 100 AS pct FROM j)
       SELECT category, limit_value, spent, round(pct, 0) AS pct,
         CASE WHEN pct >= 100 THEN 'danger' WHEN pct >= 80 THEN 'warning' ELSE 'ok' END AS band FROM p""",
)
def a16(spark, sf):
    return plan.goal_progress(ledger(spark, sf), goals(spark, sf))


@query(
    "a17_last_six_months",
    f"""WITH {LEDGER_SQL},
         flows AS (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           {INCOME_SQL} AS receitas, {EXPENSE_SQL} AS despesas FROM ledger GROUP BY 1, 2),
         spine(year, month) AS (VALUES (2001, 5), (2001, 6), (2001, 7), (2001, 8), (2001, 9), (2001, 10))
       SELECT s.year, s.month, COALESCE(receitas, 0.0) AS receitas, COALESCE(despesas, 0.0) AS despesas,
         substring(({MONTHS_SQL})[s.month], 1, 3) AS label
       FROM spine s LEFT JOIN flows f ON s.year = f.year AND s.month = f.month""",
)
def a17(spark, sf):
    return plan.last_months(spark, ledger(spark, sf), 2001, 10)


@query(
    "w05_daily_running_balance",
    f"""WITH {LEDGER_SQL},
         net AS (SELECT date, SUM({amount("CASE WHEN type = 'receita' THEN value ELSE -value END")}) AS n FROM ledger GROUP BY 1),
         days AS (SELECT CAST(unnest(generate_series((SELECT CAST(min(date) AS TIMESTAMP) FROM ledger),
           (SELECT CAST(max(date) AS TIMESTAMP) FROM ledger), INTERVAL 1 DAY)) AS DATE) AS date),
         so_far AS (SELECT days.date, SUM(COALESCE(n, 0)) OVER (PARTITION BY date_trunc('month', days.date)
         ORDER BY days.date ROWS UNBOUNDED PRECEDING) AS saldo
       FROM days LEFT JOIN net ON days.date = net.date)
       SELECT date, {as_double("saldo")} AS saldo FROM so_far""",
)
def w05(spark, sf):
    book = ledger(spark, sf)
    first, last = plan.period(book)
    return plan.daily_balance(spark, book, str(first), str(last))


@query(
    "w06_monthly_running_balance",
    f"""WITH {SUMMARY_SQL}, so_far AS (SELECT year, month, saldo, SUM({amount("saldo")}) OVER
         (PARTITION BY year ORDER BY month ROWS UNBOUNDED PRECEDING) AS acumulado FROM summary)
       SELECT year, month, saldo, {as_double("acumulado")} AS acumulado FROM so_far""",
)
def w06(spark, sf):
    return plan.cumulative_balance(_summary(spark, sf)).select(
        "year", "month", "saldo", "acumulado"
    )


@query(
    "w07_recent_rows",
    f"""WITH {LEDGER_SQL} SELECT id, date, type, value FROM ledger
       WHERE date >= DATE '1999-12-01' AND date < DATE '2000-01-01'
       ORDER BY date DESC, id DESC LIMIT 5""",
)
def w07(spark, sf):
    return plan.recent(ledger(spark, sf).select("id", "date", "type", "value"), 1999, 12)


@query(
    "o06_top_categories",
    f"""WITH {LEDGER_SQL} SELECT category, {money("value")} AS total FROM ledger
       WHERE type = 'despesa' AND year(date) = 1996 GROUP BY 1
       ORDER BY total DESC, category LIMIT 5""",
)
def o06(spark, sf):
    return plan.top_categories(ledger(spark, sf), 1996)


# Education: a wide table by priority, one column per year, numbers as pt-BR text.
YEARS = [str(y) for y in range(1995, 2002)]
KPI_SQL = """y AS (SELECT o_orderpriority AS "Localidade", CAST(year(o_orderdate) AS INTEGER) AS "Ano",
      CAST(count(*) * 17 AS DOUBLE) AS "Docentes",
      CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) * 29 AS DOUBLE) AS "Salas"
      FROM orders GROUP BY 1, 2),
    g AS (SELECT *, COALESCE(round("Docentes" / nullif("Salas", 0), 2), 0.0) AS k1,
      COALESCE(round(("Docentes" / lag("Docentes") OVER w - 1) * 100, 2), 0.0) AS k2,
      COALESCE(round(("Salas" / nullif(lag("Salas") OVER w, 0) - 1) * 100, 2), 0.0) AS aux
      FROM y WINDOW w AS (PARTITION BY "Localidade" ORDER BY "Ano")),
    kpi AS (SELECT "Localidade", "Ano", "Docentes", "Salas", k1 AS "KPI_1_Docente_por_Sala",
      k2 AS "KPI_2_Cresc_Docentes_Percent", aux AS "Aux_Cresc_Salas_Percent",
      round(k2 - aux, 2) AS "KPI_3_Descompasso_Docentes_vs_Salas_Percent" FROM g)"""


def wide_table(spark, sf):
    base = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("Localidade"),
        F.year(F.col("o_orderdate").cast("date")).alias("_year"),
        "o_orderstatus",
    )

    def shown(n):
        return F.translate(F.format_number(n, 0), ",", ".")

    def variable(name, condition, weight):
        columns = [
            shown(F.count(F.when((F.col("_year") == int(y)) & condition, 1)) * weight).alias(y)
            for y in YEARS
        ]
        counted = base.groupBy("Localidade").agg(*columns)
        return counted.select("Localidade", F.lit(name).alias("Variável"), *YEARS)

    return variable(education.TEACHERS, F.lit(True), 17).unionByName(
        variable(education.CLASSROOMS, F.col("o_orderstatus") == "F", 29)
    )


def _kpis(spark, sf):
    return education.kpi_table(education.long_table(wide_table(spark, sf), YEARS))


@query("education_kpis", f"WITH {KPI_SQL} SELECT * FROM kpi")
def education_kpis(spark, sf):
    return _kpis(spark, sf)


@query("education_kpis_of_locality", f"WITH {KPI_SQL} SELECT * FROM kpi WHERE \"Localidade\" = '2-HIGH'")
def education_locality(spark, sf):
    return education.of_locality(_kpis(spark, sf), "2-HIGH")


@query(
    "a18_latest_period_summary",
    f"""WITH {KPI_SQL} SELECT max("Ano") AS "Ano", sum("Docentes") AS total_docentes,
         sum("Salas") AS total_salas, round(avg("KPI_1_Docente_por_Sala"), 2) AS media_docente_por_sala,
         round(avg("KPI_2_Cresc_Docentes_Percent"), 1) AS cresc_medio_docentes
       FROM kpi WHERE "Ano" = (SELECT max("Ano") FROM kpi)""",
)
def a18(spark, sf):
    return education.latest_summary(_kpis(spark, sf))


# Salaries: suppliers as states, with the nation as region.
def _salaries(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("UF"),
        F.col("s_acctbal").alias("salario"),
        F.concat(F.lit("R"), "s_nationkey").alias("Região"),
    )


SALARY_SQL = """s AS (SELECT s_name AS "UF", s_acctbal AS salario, 'R' || s_nationkey AS "Região"
    FROM supplier)"""


@query(
    "salary_mean_by_region",
    f"""WITH {SALARY_SQL} SELECT "Região", {mean("salario")} AS mean FROM s GROUP BY 1""",
)
def salary_by_region(spark, sf):
    return salary.mean_by_region(_salaries(spark, sf))


@query(
    "salary_highest_by_region",
    f"""WITH {SALARY_SQL} SELECT * FROM s QUALIFY row_number() OVER
         (PARTITION BY "Região" ORDER BY salario DESC, "UF") = 1""",
)
def salary_highest(spark, sf):
    return salary.highest_by_region(_salaries(spark, sf))


@query("salary_mean", f"WITH {SALARY_SQL} SELECT {mean('salario')} AS mean FROM s")
def salary_mean(spark, sf):
    return salary.mean_salary(_salaries(spark, sf))


@query("salary_lowest_state", f"""WITH {SALARY_SQL} SELECT * FROM s ORDER BY salario, "UF" LIMIT 1""")
def salary_lowest_state(spark, sf):
    return salary.lowest_state(_salaries(spark, sf))


@query("salary_highest_state", f"""WITH {SALARY_SQL} SELECT * FROM s ORDER BY salario DESC, "UF" LIMIT 1""")
def salary_highest_state(spark, sf):
    return salary.highest_state(_salaries(spark, sf))


@query(
    "salary_lowest_by_region",
    f"""WITH {SALARY_SQL} SELECT * FROM s QUALIFY row_number() OVER
         (PARTITION BY "Região" ORDER BY salario, "UF") = 1""",
)
def salary_lowest(spark, sf):
    return salary.lowest_by_region(_salaries(spark, sf))


@query(
    "salary_best_and_worst_region",
    f"""WITH {SALARY_SQL}, m AS (SELECT "Região", {mean('salario')} AS mean FROM s GROUP BY 1)
       (SELECT *, 'highest' AS which FROM m ORDER BY mean DESC, "Região" LIMIT 1)
       UNION ALL (SELECT *, 'lowest' FROM m ORDER BY mean, "Região" LIMIT 1)""",
)
def salary_extreme_regions(spark, sf):
    return salary.best_and_worst_region(_salaries(spark, sf))


@query(
    "salary_position",
    f"""WITH {SALARY_SQL} SELECT count(CASE WHEN salario > (SELECT salario FROM s
           WHERE "UF" = 'Supplier#000000003') THEN 1 END) + 1 AS position,
         max(CASE WHEN "UF" = 'Supplier#000000003' THEN salario END) AS salario FROM s""",
)
def salary_position(spark, sf):
    return salary.position_of(_salaries(spark, sf), "Supplier#000000003")


# Outbreaks: orders as events.
def _outbreaks(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("Nome_Evento"),
        F.col("o_orderpriority").alias("Tipo_Patogeno"),
        F.year(F.col("o_orderdate").cast("date")).alias("Ano_Inicio"),
        (F.year(F.col("o_orderdate").cast("date")) + 1).alias("Ano_Fim"),
        F.concat(F.lit("R"), F.col("o_custkey") % 9).alias("Regiao_Origem"),
        (F.col("o_custkey") % 7).cast("int").alias("Continentes_Afetados"),
        (F.col("o_orderkey") * 7919 % 100003).alias("Mortes_Estimadas"),
        (F.col("o_custkey") % 101).cast("double").alias("Taxa_Fatalidade"),
        F.col("o_totalprice").alias("Impacto_Economico_Bilhao_USD"),
        (F.col("o_orderkey") % 97).cast("double").alias("Porcentagem_Disseminacao"),
        F.col("o_orderstatus").alias("Era"),
        (F.col("o_custkey") % 2 == 0).alias("Avanco_Medico"),
    )


OUTBREAK_SQL = """o AS (SELECT CAST(o_orderkey AS VARCHAR) AS "Nome_Evento",
    o_orderpriority AS "Tipo_Patogeno", CAST(year(o_orderdate) AS INTEGER) AS "Ano_Inicio",
    CAST(year(o_orderdate) + 1 AS INTEGER) AS "Ano_Fim", 'R' || (o_custkey % 9) AS "Regiao_Origem",
    CAST(o_custkey % 7 AS INTEGER) AS "Continentes_Afetados",
    o_orderkey * 7919 % 100003 AS "Mortes_Estimadas",
    CAST(o_custkey % 101 AS DOUBLE) AS "Taxa_Fatalidade",
    o_totalprice AS "Impacto_Economico_Bilhao_USD",
    CAST(o_orderkey % 97 AS DOUBLE) AS "Porcentagem_Disseminacao", o_orderstatus AS "Era",
    o_custkey % 2 = 0 AS "Avanco_Medico" FROM orders)"""


@query(
    "outbreak_deadliest",
    f"""WITH {OUTBREAK_SQL} SELECT "Nome_Evento", "Ano_Inicio", "Regiao_Origem", "Mortes_Estimadas"
       FROM o ORDER BY "Mortes_Estimadas" DESC, "Nome_Evento" LIMIT 10""",
)
def outbreak_deadliest(spark, sf):
    return outbreaks.deadliest(_outbreaks(spark, sf))


@query(
    "outbreak_most_widespread",
    f"""WITH {OUTBREAK_SQL} SELECT "Nome_Evento", "Tipo_Patogeno", "Porcentagem_Disseminacao"
       FROM o ORDER BY "Porcentagem_Disseminacao" DESC, "Nome_Evento" LIMIT 10""",
)
def outbreak_widespread(spark, sf):
    return outbreaks.most_widespread(_outbreaks(spark, sf))


@query(
    "outbreak_costliest",
    f"""WITH {OUTBREAK_SQL} SELECT "Nome_Evento", "Ano_Inicio", "Ano_Fim",
         "Impacto_Economico_Bilhao_USD" FROM o
       WHERE "Impacto_Economico_Bilhao_USD" = (SELECT max("Impacto_Economico_Bilhao_USD") FROM o)""",
)
def outbreak_costliest(spark, sf):
    return outbreaks.costliest(_outbreaks(spark, sf))


@query(
    "outbreak_above_mean_fatality",
    f"""WITH {OUTBREAK_SQL} SELECT "Nome_Evento", "Mortes_Estimadas", "Taxa_Fatalidade" FROM o
       WHERE "Taxa_Fatalidade" > (SELECT avg("Taxa_Fatalidade") FROM o)""",
)
def outbreak_above_mean(spark, sf):
    return outbreaks.above_mean_fatality(_outbreaks(spark, sf))


@query(
    "outbreak_by_pathogen",
    f"""WITH {OUTBREAK_SQL} SELECT "Tipo_Patogeno", round(avg("Porcentagem_Disseminacao"), 6)
         AS media_disseminacao, CAST(sum("Mortes_Estimadas") AS BIGINT) AS total_mortes
       FROM o GROUP BY 1""",
)
def outbreak_by_pathogen(spark, sf):
    df = outbreaks.spread_and_deaths_by_pathogen(_outbreaks(spark, sf))
    return df.withColumn("media_disseminacao", F.round("media_disseminacao", 6))


@query(
    "outbreak_by_continents",
    f"""WITH {OUTBREAK_SQL} SELECT "Continentes_Afetados", "Nome_Evento",
         CAST(sum("Mortes_Estimadas") AS BIGINT) AS total_mortes FROM o GROUP BY 1, 2""",
)
def outbreak_by_continents(spark, sf):
    return outbreaks.deaths_by_continents(_outbreaks(spark, sf))


@query(
    "outbreak_impact_by_era",
    f"""WITH {OUTBREAK_SQL} SELECT "Era", "Avanco_Medico",
         round(avg("Impacto_Economico_Bilhao_USD"), 4) AS impacto_medio FROM o GROUP BY 1, 2""",
)
def outbreak_impact(spark, sf):
    df = outbreaks.impact_by_era(_outbreaks(spark, sf))
    return df.withColumn("impacto_medio", F.round("impacto_medio", 4))
