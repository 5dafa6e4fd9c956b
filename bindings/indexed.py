"""Checks by bitmaps, commonest keys by bounds, searches by trigrams, figures from kept sums; SQL as for the plain forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.functions.numbers import money as as_money
from marquetry.operators import bitmaps, heavy
from marquetry.operators import changes as ops
from marquetry.operators.trigrams import TrigramIndex
from marquetry.plans import ledger as plan
from marquetry.plans.ledger_sums import LedgerSums
from marquetry.session import scratch_path

from . import aggregates, joins, reports  # noqa: F401  their SQL is used here
from .changes import _book
from .kept import BUCKETS, kept
from .registry import SQL, query
from .tables import LEDGER_SQL, as_double, crew, ledger, money, parents, table


def _parents(spark, sf):
    people, works = parents(spark, sf)
    return [(people, "id_pessoa"), (works, "id_producao")]


@query("j01_bitmap_integrity", SQL["j01_referential_integrity"])
def j01(spark, sf):
    return bitmaps.keep_with_parents(crew(spark, sf), _parents(spark, sf))


@query("j02_bitmap_report", SQL["j02_orphan_report"])
def j02(spark, sf):
    return bitmaps.orphan_report(crew(spark, sf), _parents(spark, sf))


@query("j02_bitmap_orphans", SQL["j02_orphans"])
def j02_rows(spark, sf):
    return bitmaps.orphans(crew(spark, sf), parents(spark, sf)[1], "id_producao")


@query(
    "o02_heavy_keys",
    """SELECT user_id, count(*) AS total FROM events GROUP BY 1 ORDER BY total DESC, user_id LIMIT 20""",
)
def o02(spark, sf):
    return heavy.heaviest(table(spark, sf, "events"), ["user_id"], 20)


@query(
    "o02_heavy_words",
    r"""SELECT word, count(*) AS total FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
       WHERE word <> '' GROUP BY 1 ORDER BY total DESC, word LIMIT 20""",
)
def o02_words(spark, sf):
    """Words are as uneven as keys get."""
    words = table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return heavy.heaviest(words.filter("word <> ''"), ["word"], 20)


@query(
    "o06_heavy_spenders",
    f"""SELECT o_custkey, {money("o_totalprice")} AS total FROM orders GROUP BY 1
       ORDER BY SUM(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,18))) DESC, o_custkey LIMIT 10""",
)
def o06(spark, sf):
    orders = table(spark, sf, "orders")
    found = heavy.heaviest(orders, ["o_custkey"], 10, as_money(F.col("o_totalprice")))
    return found.withColumn("total", F.col("total").cast("double"))


def _index(spark, df, key, columns, name):
    return TrigramIndex(df, scratch_path(spark, name), key, columns, BUCKETS)


@query(
    "p06_trigram_search",
    """SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') ORDER BY p_partkey LIMIT 50""",
)
def p06(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name")
    return _index(spark, df, "p_partkey", ["p_name"], "p06t").matching("RING")


@query(
    "p07_trigram_search",
    f"""WITH {LEDGER_SQL} SELECT id, description, category, type FROM ledger
       WHERE contains(lower(description), 'taç') OR contains(lower(category), 'taç')""",
)
def p07(spark, sf):
    df = ledger(spark, sf).select("id", "description", "category", "type")
    return _index(spark, df, "id", ["description", "category"], "p07t").containing("TAÇ")


# The ledger after the edits of ``_edited``: open orders are deleted, those of status P doubled and moved to another day.
EDITED_SQL = f"""{LEDGER_SQL.replace("ledger AS", "whole AS")},
    ledger AS (SELECT id, CASE WHEN description = 'P' THEN date + 1 ELSE date END AS date, description, category, type,
      CASE WHEN description = 'P' THEN value * 2 ELSE value END AS value FROM whole WHERE description <> 'O')"""


def _edited(spark, sf):
    """Sums that followed the ledger through three versions."""
    book = _book(spark, sf)
    held = kept(spark, book, "id", "sums-ledger")
    sums = LedgerSums(spark, scratch_path(spark, "sums"), held, BUCKETS)
    sums.refresh()
    held.change(book.filter(F.col("description") == "O").select("id"), lambda rows, gone: ops.delete_rows(rows, gone, "id"))
    sums.refresh()
    moved = book.filter(F.col("description") == "P").select(
        "id", F.date_add("date", 1).alias("date"), "description", "category", "type", (F.col("value") * 2).alias("value")
    )
    fields = ["date", "description", "category", "type", "value"]
    held.change(moved, lambda rows, new: ops.replace_rows(rows, new, "id", fields))
    sums.refresh()
    return sums.as_ledger()


def _after_edits(name):
    """A report's SQL over the edited ledger."""
    return SQL[name].replace(LEDGER_SQL, EDITED_SQL)


@query("a12_kept_monthly_kpis", _after_edits("a12_monthly_kpis"))
def a12(spark, sf):
    return plan.kpis(_edited(spark, sf).withColumn("mes", F.date_format("date", "yyyy-MM")), ["mes"])


@query(
    "a14_kept_category_sums",
    f"""WITH {EDITED_SQL} SELECT year(date) AS year, category, type,
       {as_double("SUM(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,18)))")} AS total FROM ledger GROUP BY 1, 2, 3""",
)
def a14(spark, sf):
    sums = _edited(spark, sf).groupBy(F.year("date").cast("long").alias("year"), "category", "type")
    return sums.agg(F.sum("value").cast("double").alias("total"))


@query("w05_kept_daily_balance", _after_edits("w05_daily_running_balance"))
def w05(spark, sf):
    book = _edited(spark, sf)
    first, last = plan.period(book)
    return plan.daily_balance(spark, book, str(first), str(last))
