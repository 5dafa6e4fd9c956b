"""Values as they are: amounts below a cent, many decimals, ids beside whole numbers, replaced collections."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquetry.functions import numbers
from marquetry.plans import ledger
from marquetry.schemas import PERSON_RAW
from marquetry.sources import readers, versions, writers


def test_fractions_of_a_cent_are_summed(spark):
    df = spark.createDataFrame([(0.004,)] * 3 + [(None,)], "x double")
    assert df.agg(numbers.money_sum(F.col("x"))).first()[0] == 0.012
    assert df.filter("x > 1").agg(numbers.money_sum(F.col("x"))).first()[0] == 0.0
    book = df.filter("x IS NOT NULL").select(F.lit("receita").alias("type"), F.lit("c").alias("category"), F.col("x").alias("value"))
    found = ledger.kpis(book).first()
    assert (found["receitas"], found["saldo"], found["economia"]) == (0.012, 0.012, 100.0)


def test_differences_show_no_float_noise(one):
    assert one(numbers.difference(F.col("a"), F.col("b")), a=("double", 0.3), b=("double", 0.1)) == 0.2


@pytest.mark.parametrize(
    "text, value",
    [("1,12345678901", 1.12345678901), (" 13.007,12 ", 13007.12), ("-,5", -0.5), ("7,", 7.0), ("", None), ("NaN", None), ("1f", None), (None, None), ("9" * 60, 1e60)],
)
def test_text_to_the_nearest_float(one, text, value):
    assert one(numbers.ptbr_double(F.col("x")), x=("string", text)) == value


def test_more_decimals_than_the_scale_are_rounded_and_told(one):
    x = F.col("x")
    assert one(numbers.parse_ptbr(x), x=("string", "1,12345678905")) == Decimal("1.1234567891")
    assert one(numbers.parse_us_money(x), x=("string", "$1.12345678901")) == Decimal("1.1234567890")
    told = {"1,12345678901": True, "1,1234567890": False, "1,10000000000": False, "12345678901234": False, "x": False, None: False}
    assert {t: one(numbers.more_decimals(x), x=("string", t)) for t in told} == told


def test_a_number_of_too_many_digits_is_an_error(one):
    with pytest.raises(Exception, match="more than 38 digits"):
        one(numbers.parse_ptbr(F.col("x")), x=("string", "9" * 40))


def test_ids_are_compared_without_rounding(spark):
    ids = ["2", '"2"', "2.0", "3.000", "4e1", "2.00000000001", "2.5", '"2.00000000000000000000000000000000000000001"', '"1e-1"', '"x"', '" 7 "']
    lines = spark.createDataFrame([(f'{{"id_pessoa": {i}, "nome": "n{k}"}}',) for k, i in enumerate(ids)], "value string")
    found = {int(r["nome"][1:]): r["id_pessoa"] for r in readers.parse_lines(lines, PERSON_RAW).collect()}
    assert [found[k] for k in range(len(ids))] == [2, 2, 2, 3, 40, None, None, None, None, None, 7]


def test_readers_see_the_old_collection_until_the_new_one_is_named(spark, tmp_path, rows):
    root = str(tmp_path / "people")
    writers.write_collection(spark.range(3), root)
    old = readers.read_collection(spark, root)
    # A replacement that was broken off: written, not named.
    spark.range(9).write.parquet(versions.version_path(root, 2))
    assert readers.read_collection(spark, root).count() == 3
    writers.write_collection(old.filter("id > 0"), root)
    assert rows(readers.read_collection(spark, root)) == [(1,), (2,)]
    assert old.count() == 3
    writers.write_collection(spark.range(1), root)
    assert rows(readers.read_collection(spark, root)) == [(0,)]
    assert not versions.exists(spark, versions.version_path(root, 1)) and versions.exists(spark, versions.version_path(root, 2))


def test_files_without_versions_are_read_as_they_are(spark, tmp_path, rows):
    spark.range(2).write.parquet(str(tmp_path / "plain"))
    assert rows(readers.read_collection(spark, str(tmp_path / "plain"))) == [(0,), (1,)]


def test_period_of_a_ledger(spark):
    book = spark.sql("SELECT CAST(d AS date) AS date FROM VALUES ('2020-03-01'), (NULL), ('2019-12-31') AS t(d)")
    assert [str(d) for d in ledger.period(book)] == ["2019-12-31", "2020-03-01"]
    assert ledger.period(book.filter("date IS NULL")) is None
