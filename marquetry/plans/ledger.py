"""Personal ledger: lists, monthly and annual figures, goals.

A ledger has the columns of ``schemas.TRANSACTION``; ``date`` is a date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import in_period, month_label, month_name
from ..functions.money import (
    expense_of,
    goal_band,
    health_band,
    income_of,
    savings_pct,
    signed_value,
)
from ..functions.numbers import difference, money, money_sum, percent
from ..functions.text import contains_any
from ..operators.aggregates import share_of_total
from ..operators.changes import import_rows, upsert_goals
from ..operators.joins import fill_spine, lookup
from ..operators.ordering import top_k
from ..operators.projections import equals_if
from ..operators.spines import day_spine, month_spine, trailing_months
from ..operators.windows import running_sum
from ..schemas import CATEGORIES, CATEGORY, EXPENSE, INVESTMENT_CATEGORY, OTHER_CATEGORY


def transactions_of(
    ledger: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Rows of a year or month by date; all rows, newest first, without one."""
    if year is None:
        return ledger.orderBy(F.desc("date"), F.desc("id"))
    return ledger.filter(in_period(F.col("date"), year, month)).orderBy("date", "id")


def search(
    ledger: DataFrame, term: str = "", category: str | None = None, kind: str | None = None
) -> DataFrame:
    """Rows that hold the term and match the filters that are given."""
    if term:
        ledger = ledger.filter(contains_any(term, F.col("description"), F.col("category")))
    return equals_if(ledger, category=category, type=kind)


def recent(ledger: DataFrame, year: int, month: int, n: int = 5) -> DataFrame:
    """Last rows of a month, newest first."""
    rows = ledger.filter(in_period(F.col("date"), year, month))
    return rows.orderBy(F.desc("date"), F.desc("id")).limit(n)


def period(ledger: DataFrame) -> tuple[date, date] | None:
    """First and last date of the rows that have one; None without any."""
    first, last = ledger.agg(F.min("date"), F.max("date")).first()
    return None if first is None else (first, last)


def _flows():
    kind, value = F.col("type"), F.col("value")
    return (
        money_sum(income_of(kind, value)).alias("receitas"),
        money_sum(expense_of(kind, value)).alias("despesas"),
    )


def _with_balance(df: DataFrame) -> DataFrame:
    return df.withColumn("saldo", difference(F.col("receitas"), F.col("despesas")))


def _kpi_sums(ledger: DataFrame, by: Sequence[str]) -> DataFrame:
    invested = F.when(F.col("category") == INVESTMENT_CATEGORY, F.col("value"))
    return ledger.groupBy(*by).agg(
        *_flows(),
        money_sum(F.when(F.col("type") == EXPENSE, invested)).alias("investimentos"),
        F.count(F.lit(1)).alias("_rows"),
    )


def kpis(ledger: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Income, expense, balance, investments, savings and health band, per group if given."""
    return _with_kpis(_kpi_sums(ledger, by))


def monthly_kpis(
    spark: SparkSession, ledger: DataFrame, first_year: int, last_year: int | None = None
) -> DataFrame:
    """KPIs of every month of the years; one without rows has zeros and its own band."""
    dated = ledger.withColumns({"year": F.year("date"), "month": F.month("date")})
    keys = ["year", "month"]
    measures = ["receitas", "despesas", "investimentos", "_rows"]
    spine = month_spine(spark, first_year, last_year)
    return _with_kpis(fill_spine(spine, _kpi_sums(dated, keys), keys, measures))


def _with_kpis(sums: DataFrame) -> DataFrame:
    savings = savings_pct(F.col("receitas"), F.col("despesas"))
    return (
        _with_balance(sums)
        .withColumn("economia", F.round(savings, 1))
        .withColumn("saude", health_band(savings, F.col("_rows")))
        .drop("_rows")
    )


def monthly_flows(ledger: DataFrame) -> DataFrame:
    """Income and expense per (year, month)."""
    return ledger.groupBy(
        F.year("date").alias("year"), F.month("date").alias("month")
    ).agg(*_flows())


def annual_summary(
    spark: SparkSession, ledger: DataFrame, first_year: int, last_year: int | None = None
) -> DataFrame:
    """Twelve rows per year: month, name, income, expense, balance, savings. One scan."""
    last_year = last_year or first_year
    within = (F.col("date") >= F.lit(f"{first_year}-01-01").cast("date")) & (
        F.col("date") < F.lit(f"{last_year + 1}-01-01").cast("date")
    )
    months = fill_spine(
        month_spine(spark, first_year, last_year),
        monthly_flows(ledger.filter(within)),
        ["year", "month"],
        ["receitas", "despesas"],
    )
    return _with_balance(months).withColumns(
        {
            "name": month_name(F.col("month")),
            "economia": savings_pct(F.col("receitas"), F.col("despesas"), 1),
        }
    )


def annual_totals(summary: DataFrame) -> DataFrame:
    """Totals per year, and the mean of savings over months that have any row."""
    active = (F.col("receitas") > 0) | (F.col("despesas") > 0)
    mean = F.sum(F.when(active, F.col("economia").cast("decimal(18,1)"))).cast("double") / F.nullif(
        F.count(F.when(active, True)), F.lit(0)
    )
    return summary.groupBy("year").agg(
        money_sum(F.col("receitas")).alias("total_receitas"),
        money_sum(F.col("despesas")).alias("total_despesas"),
        money_sum(F.col("saldo")).alias("saldo_anual"),
        F.coalesce(F.round(mean, 1), F.lit(0.0)).alias("media_economia"),
    )


def cumulative_balance(summary: DataFrame) -> DataFrame:
    """Balance so far within each year: a window over twelve rows."""
    net = summary.withColumn("_net", money(F.col("saldo")))
    so_far = running_sum("_net", "month", "year").cast("double")
    return net.withColumn("acumulado", so_far).drop("_net")


def top_categories(ledger: DataFrame, year: int, k: int = 5) -> DataFrame:
    """Expense categories of a year with the largest sums."""
    spent = ledger.filter(in_period(F.col("date"), year) & (F.col("type") == EXPENSE))
    sums = spent.groupBy("category").agg(money_sum(F.col("value")).alias("total"))
    return top_k(sums, "total", "category", k)


def spend_by_category(ledger: DataFrame) -> DataFrame:
    """Expense per category with its share of all expense in percent."""
    return share_of_total(ledger.filter(F.col("type") == EXPENSE), ["category"], "value")


def goal_progress(ledger: DataFrame, goals: DataFrame) -> DataFrame:
    """Spend against each active goal, in percent and as a band."""
    spent = (
        ledger.filter(F.col("type") == EXPENSE)
        .groupBy("category")
        .agg(money_sum(F.col("value")).alias("spent"))
    )
    joined = fill_spine(goals.filter(F.col("limit_value") > 0), spent, ["category"], ["spent"])
    pct = percent(F.col("spent"), F.col("limit_value"))
    return joined.withColumns({"pct": F.round(pct, 0), "band": goal_band(pct)})


def daily_balance(spark: SparkSession, ledger: DataFrame, first: str, last: str) -> DataFrame:
    """Running balance per day, from zero on the first day of each month.

    Days are summed before the window, which then holds at most 31 rows per month.
    """
    net = (
        ledger.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        .groupBy("date")
        .agg(F.sum(money(signed_value(F.col("type"), F.col("value")))).alias("_net"))
    )
    days = day_spine(spark, first, last).join(net, "date", "left")
    return days.select(
        "date",
        F.coalesce(F.col("_net"), F.lit(0)).alias("_net"),
        F.trunc("date", "month").alias("_month"),
    ).select("date", running_sum("_net", "date", "_month").cast("double").alias("saldo"))


def last_months(
    spark: SparkSession, ledger: DataFrame, year: int, month: int, n: int = 6
) -> DataFrame:
    """Income and expense of the n months up to the given one, empty months kept."""
    spine = trailing_months(spark, year, month, n)
    after = F.add_months(F.make_date(F.lit(year), F.lit(month), F.lit(1)), 1)
    first = F.add_months(F.make_date(F.lit(year), F.lit(month), F.lit(1)), 1 - n)
    flows = monthly_flows(ledger.filter((F.col("date") >= first) & (F.col("date") < after)))
    filled = fill_spine(spine, flows, ["year", "month"], ["receitas", "despesas"])
    return filled.withColumn("label", month_label(F.col("month")))


def category_table(spark: SparkSession) -> DataFrame:
    """The fixed categories as a literal relation."""
    names = CATEGORY.fieldNames()
    entries = [
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, entry)]) for entry in CATEGORIES
    ]
    return spark.range(1).select(F.inline(F.array(*entries)))


def with_category_info(spark: SparkSession, ledger: DataFrame) -> DataFrame:
    """Icon and colour of each row's category; an unknown one looks like ``Outros``."""
    icon, color = next((i, c) for n, i, c in CATEGORIES if n == OTHER_CATEGORY)
    return lookup(
        ledger,
        "category",
        category_table(spark),
        "name",
        {"icon": icon, "color": color},
    )


def import_backup(
    tables: Mapping[str, DataFrame],
    backup: Mapping[str, DataFrame],
    seq: str = "seq",
    include_recurring: bool = False,
) -> dict[str, DataFrame]:
    """Tables with a backup merged in: absent transactions are added, goals are replaced.

    The rows of the backup are numbered by ``seq``. Recurring templates are left alone
    unless asked for.
    """
    merged = dict(tables)
    if "transactions" in backup:
        merged["transactions"] = import_rows(
            tables["transactions"], backup["transactions"], "id", [seq]
        )
    if "goals" in backup:
        merged["goals"] = upsert_goals(tables["goals"], backup["goals"], seq)
    if include_recurring and "recurring" in backup:
        merged["recurring"] = import_rows(tables["recurring"], backup["recurring"], "id", [seq])
    return merged
