import datetime as dt

import pytest

from marquetry.operators import changes, keyvalue
from marquetry.plans import ledger
from pyspark.sql import functions as F

SCHEMA = "id string, date date, description string, category string, type string, value double, recurring_id string"


def tx(i, date, category, kind, value, recurring=None):
    return (i, dt.date.fromisoformat(date), f"d{i}", category, kind, value, recurring)


ROWS = [
    tx("a", "1999-12-31", "Salário", "receita", 1000.0),
    tx("b", "2000-01-05", "Salário", "receita", 1000.0),
    tx("c", "2000-01-05", "Lazer", "despesa", 700.0),
    tx("d", "2000-02-10", "Lazer", "despesa", 0.1),
    tx("e", "2000-02-10", "Lazer", "despesa", 0.2),
    tx("f", "2000-04-30", "Salário", "receita", 100.0, "r1"),
    tx("g", "2000-04-30", "Investimentos", "despesa", 150.0),
    tx("h", "2000-05-01", "Salário", "receita", 200.0),
    tx("i", "2000-05-02", "Mistério", "despesa", 170.0),
]


@pytest.fixture
def book(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return [r["id"] for r in df.collect()]


def test_lists(book):
    assert ids(ledger.transactions_of(book, 2000, 4)) == ["f", "g"]
    assert ids(ledger.transactions_of(book, 1999)) == ["a"]
    assert ids(ledger.transactions_of(book))[:2] == ["i", "h"]
    assert ids(ledger.recent(book, 2000, 2, 1)) == ["e"]
    assert ids(ledger.recent(book, 2000, 3)) == []
    assert sorted(ids(ledger.search(book, "LAZ"))) == ["c", "d", "e"]
    assert ids(ledger.search(book, "", "Lazer", "receita")) == []


def test_annual_summary(spark, book):
    months = {r["month"]: r for r in ledger.annual_summary(spark, book, 2000).collect()}
    assert len(months) == 12
    assert months[1]["economia"] == 30.0 and months[1]["name"] == "Janeiro"
    assert (months[2]["receitas"], months[2]["despesas"], months[2]["saldo"]) == (0.0, 0.3, -0.3)
    assert months[2]["economia"] == 0.0
    assert (months[3]["receitas"], months[3]["despesas"]) == (0.0, 0.0)
    assert months[4]["economia"] == -50.0
    assert months[5]["economia"] == 15.0
    totals = ledger.annual_totals(ledger.annual_summary(spark, book, 2000)).collect()[0]
    assert totals["total_receitas"] == 1300.0
    assert totals["saldo_anual"] == round(1300.0 - 1020.3, 2)
    assert totals["media_economia"] == -1.3  # (30 + 0 - 50 + 15) / 4, ties away from zero
    empty = ledger.annual_totals(ledger.annual_summary(spark, book, 1980)).collect()[0]
    assert (empty["total_receitas"], empty["media_economia"]) == (0.0, 0.0)
    running = ledger.cumulative_balance(ledger.annual_summary(spark, book, 2000))
    assert {r["month"]: r["acumulado"] for r in running.collect()}[12] == 279.7


def test_kpis(spark, book):
    by = ledger.kpis(book.withColumn("mes", F.date_format("date", "yyyy-MM")), ["mes"])
    got = {r["mes"]: r for r in by.collect()}
    assert (got["2000-01"]["saude"], got["2000-04"]["saude"], got["2000-05"]["saude"]) == (
        "Excelente", "Crítico", "Bom"
    )
    assert got["2000-04"]["investimentos"] == 150.0
    none = ledger.kpis(book.limit(0)).collect()[0]
    assert (none["saude"], none["receitas"], none["economia"]) == ("Sem dados", 0.0, 0.0)


def test_goals(spark, book, rows):
    goals = spark.createDataFrame(
        [("Lazer", 700.3), ("Investimentos", 187.5), ("Saúde", 50.0), ("Contas", 0.0)],
        "category string, limit_value double",
    )
    got = {r["category"]: (r["pct"], r["band"]) for r in ledger.goal_progress(book, goals).collect()}
    assert got == {"Lazer": (100.0, "danger"), "Investimentos": (80.0, "warning"), "Saúde": (0.0, "ok")}
    assert rows(changes.replace_goals(goals), "category") == [("Investimentos",), ("Lazer",), ("Saúde",)]


def test_balance_and_months(spark, book):
    days = {str(r["date"]): r["saldo"] for r in ledger.daily_balance(spark, book, "2000-01-01", "2000-02-29").collect()}
    assert len(days) == 60
    assert (days["2000-01-04"], days["2000-01-05"], days["2000-01-31"]) == (0.0, 300.0, 300.0)
    assert (days["2000-02-09"], days["2000-02-29"]) == (0.0, -0.3)
    six = ledger.last_months(spark, book, 2000, 2).orderBy("year", "month").collect()
    assert [r["label"] for r in six] == ["Set", "Out", "Nov", "Dez", "Jan", "Fev"]
    assert [r["receitas"] for r in six] == [0.0, 0.0, 0.0, 1000.0, 1000.0, 0.0]


def test_categories(spark, book, rows):
    assert [tuple(r) for r in ledger.top_categories(book, 2000, 2).collect()] == [("Lazer", 700.3), ("Mistério", 170.0)]
    shares = {r["category"]: r["share"] for r in ledger.spend_by_category(book).collect()}
    assert shares == {"Lazer": 68.6, "Investimentos": 14.7, "Mistério": 16.7}
    info = {r["category"]: r["color"] for r in ledger.with_category_info(spark, book).collect()}
    assert info["Lazer"] == "#fdcb6e" and info["Mistério"] == "#636e72"


@pytest.fixture
def templates(spark):
    return spark.createDataFrame(
        [
            ("r1", "rent", "Aluguel", "despesa", 10.0, 31, 1),
            ("r2", "gym", "Saúde", "despesa", 5.0, 15, 1),
            ("r3", "old", "Lazer", "despesa", 5.0, 1, 0),
        ],
        "id string, description string, category string, type string, value double, day_of_month int, active int",
    )


def test_recurring_is_idempotent_and_clamped(book, templates, rows):
    april = changes.generate_recurring(book, templates, 2000, 4)
    assert rows(april, "recurring_id", "date") == [("r2", dt.date(2000, 4, 15))]
    feb = changes.generate_recurring(book, templates, 2000, 2)
    assert rows(feb, "recurring_id", "date") == [("r1", dt.date(2000, 2, 29)), ("r2", dt.date(2000, 2, 15))]
    plain = changes.generate_recurring(book, templates, 2001, 2)
    assert ("r1", dt.date(2001, 2, 28)) in rows(plain, "recurring_id", "date")
    after = changes.insert_rows(book, feb)
    assert changes.generate_recurring(after, templates, 2000, 2).count() == 0
    assert after.count() == book.count() + 2


def test_several_changes_of_one_key_need_a_number(spark, rows):
    table = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, v string")
    same = spark.createDataFrame([("a", "n"), ("a", "n")], "id string, v string")
    assert rows(changes.replace_rows(table, same, "id", ["v"])) == [("a", "n"), ("b", "y")]
    differ = spark.createDataFrame([("a", "n"), ("a", "m")], "id string, v string")
    with pytest.raises(Exception, match="several changes of one key"):
        changes.replace_rows(table, differ, "id", ["v"]).collect()
    patch = differ.withColumn("has_v", F.lit(True))
    with pytest.raises(Exception, match="several changes of one key"):
        changes.patch_rows(table, patch, "id", ["v"]).collect()


def test_the_current_version_is_the_newest_complete_one(spark, tmp_path, rows):
    table = spark.createDataFrame([("a",)], "id string")
    for number in (1, 2):
        changes.write_version(table.withColumn("id", F.concat("id", F.lit(number))), str(tmp_path), number)
    table.write.parquet(str(tmp_path / "v=3"))  # broken off before it was named
    assert changes.current_version(spark, str(tmp_path)) == 2
    assert rows(changes.read_current(spark, str(tmp_path))) == [("a2",)]


def test_changes(spark, rows):
    table = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "id string, v string, n int")
    new = spark.createDataFrame([(None, "z"), ("c", None)], "id string, v string")
    out = changes.insert_rows(table, new, {"id": F.lit("gen"), "n": F.lit(9)})
    assert rows(out) == sorted([("a", "x", 1), ("b", "y", 2), ("gen", "z", 9), ("c", None, 9)], key=repr)
    edit = spark.createDataFrame([("b", None, 5), ("q", "q", 0)], "id string, v string, n int")
    assert rows(changes.replace_rows(table, edit, "id", ["v", "n"])) == sorted([("a", "x", 1), ("b", None, 5)], key=repr)
    patch = spark.createDataFrame(
        [("a", None, True, 7, False), ("b", "w", False, 8, True)],
        "id string, v string, has_v boolean, n int, has_n boolean",
    )
    assert rows(changes.patch_rows(table, patch, "id", ["v", "n"])) == sorted([("a", None, 1), ("b", "y", 8)], key=repr)
    assert rows(changes.delete_rows(table, edit, "id")) == [("a", "x", 1)]
    incoming = spark.createDataFrame([("b", "late", 1), ("c", "second", 2), ("c", "first", 1)], "id string, v string, n int")
    assert rows(changes.import_rows(table, incoming, "id", ["n"])) == [("a", "x", 1), ("b", "y", 2), ("c", "first", 1)]


def test_several_changes_of_a_row(spark, rows):
    table = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "id string, v string, n int")
    edits = spark.createDataFrame(
        [("a", "first", 5, 1), ("a", None, 6, 3), ("a", "late", 7, 2)], "id string, v string, n int, seq int"
    )
    replaced = changes.replace_rows(table, edits, "id", ["v", "n"], seq="seq")
    assert rows(replaced) == sorted([("a", None, 6), ("b", "y", 2)], key=repr)
    patches = spark.createDataFrame(
        [
            ("a", "one", True, None, False, 1),
            ("a", None, True, 9, False, 2),
            ("a", "no", False, 8, True, 3),
            ("b", None, None, None, None, 4),
        ],
        "id string, v string, has_v boolean, n int, has_n boolean, seq int",
    )
    patched = changes.patch_rows(table, patches, "id", ["v", "n"], seq="seq")
    assert rows(patched) == sorted([("a", None, 8), ("b", "y", 2)], key=repr)


def test_imported_rows_without_id_all_arrive(spark, rows):
    table = spark.createDataFrame([("a", 1.0)], "id string, value double")
    incoming = spark.createDataFrame(
        [(None, 5.0, 1), (None, 5.0, 2), ("", 5.0, 3), ("a", 9.0, 4), ("b", 2.0, 5)],
        "id string, value double, seq int",
    )
    out = rows(changes.import_rows(table, incoming, "id", ["seq"]))
    assert sorted(v for _, v in out) == [1.0, 2.0, 5.0, 5.0, 5.0]
    assert len({i for i, _ in out}) == 5


def test_added_rows_take_defaults(spark, templates):
    base = templates.withColumn("created_at", F.lit(None).cast("timestamp"))
    new = spark.createDataFrame(
        [("tv", "Lazer", "despesa", 3.0, 10, None, 1), ("tv", "Lazer", "despesa", 3.0, 10, 0, 2)],
        "description string, category string, type string, value double, day_of_month int, active int, seq int",
    )
    added = changes.add_recurring(base, new).filter("description = 'tv'").orderBy("active").collect()
    assert [r["active"] for r in added] == [0, 1]
    assert added[0]["id"] != added[1]["id"] and added[0]["created_at"] is not None


def test_backup_import(spark, book, templates, rows):
    tables = {
        "transactions": book,
        "recurring": templates,
        "goals": spark.createDataFrame([("Lazer", 1.0)], "category string, limit_value double"),
    }
    backup = {
        "transactions": spark.createDataFrame([("a", 1.0, 1), ("new", 2.0, 2)], "id string, value double, seq int"),
        "recurring": spark.createDataFrame([("r9", 1)], "id string, seq int"),
        "goals": spark.createDataFrame([("Lazer", None, 4.0, 1)], "category string, limit_value double, limit double, seq int"),
    }
    merged = ledger.import_backup(tables, backup)
    assert merged["transactions"].count() == book.count() + 1
    assert rows(merged["goals"]) == [("Lazer", 4.0)]
    assert merged["recurring"].count() == 3
    everything = ledger.import_backup(tables, backup, include_recurring=True)
    assert everything["recurring"].count() == 4


def test_versions_do_not_overwrite(spark, tmp_path, rows):
    table = spark.createDataFrame([(1, "a")], "i int, s string")
    first = changes.write_version(table, str(tmp_path), 1)
    second = changes.write_version(changes.insert_rows(first, table), str(tmp_path), 2)
    assert (rows(first), rows(second)) == ([(1, "a")], [(1, "a"), (1, "a")])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        changes.write_version(table, str(tmp_path), 2)


def test_goal_upsert(spark, rows):
    goals = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "category string, limit_value double")
    incoming = spark.createDataFrame(
        [
            ("A", 5.0, None, 1), ("A", 6.0, None, 2), ("B", 0.0, 7.0, 3), ("C", None, 8.0, 4),
            ("D", 0.0, None, 5), ("", 3.0, None, 6), (None, 3.0, None, 7), ("A", -1.0, None, 8),
        ],
        "category string, limit_value double, limit double, seq int",
    )
    assert rows(changes.upsert_goals(goals, incoming, "seq")) == [("A", 6.0), ("B", 7.0), ("C", 8.0)]


def test_key_value(spark, rows):
    log = spark.createDataFrame([(1, "k", "a"), (3, "k", "c"), (2, "k", "b"), (1, "q", None)], "seq long, key string, value string")
    assert rows(keyvalue.latest(log)) == sorted([("k", "c"), ("q", None)], key=repr)
    assert rows(keyvalue.get(log, "k")) == [("k", "c")]
    assert rows(keyvalue.get(log, "none")) == []
    pushes = spark.createDataFrame([(i, "l", f"i{i}") for i in range(5)], "seq long, key string, item string")
    items = keyvalue.list_items(pushes)
    assert rows(items) == [("l", i, f"i{i}") for i in range(5)]

    def positions(*bounds):
        return sorted(r["pos"] for r in keyvalue.list_range(pushes, *bounds).collect())

    assert positions() == [0, 1, 2, 3, 4]
    assert positions(1, 2) == [1, 2]
    assert positions(-2) == [3, 4]
    assert positions(-4, -3) == [1, 2]
    assert positions(2, -2) == [2, 3]
    assert positions(-9, 0) == [0]
    assert positions(9, 20) == []
    hashes = spark.createDataFrame([(1, "h", "f", "x"), (2, "h", "f", "y"), (1, "h", "g", "z")], "seq long, key string, field string, value string")
    assert rows(keyvalue.hash_get_all(hashes, "h")) == [("f", "y"), ("g", "z")]
