import base64
import datetime as dt
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquetry.functions import arrays, dates, ids, money, numbers, signals, text

c = F.col("x")


@pytest.mark.parametrize(
    "raw, clean, corrected",
    [
        ("  Ana   Maria ", "Ana Maria", True),
        ("Ana\u00a0Maria", "Ana Maria", True),
        ("Ana\t\nMaria", "Ana Maria", True),
        ("Ana\x1fMaria", "Ana Maria", True),
        ("Ana", "Ana", False),
        ("   ", None, True),
        ("", None, False),
        (None, None, False),
    ],
)
def test_clean_text(one, raw, clean, corrected):
    assert one(text.clean_text(c), x=("string", raw)) == clean
    assert one(text.text_corrected(c), x=("string", raw)) is corrected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t\n\u00a0\u2003\x1c\x85é", max_size=12), min_size=1, max_size=40))
def test_clean_text_equals_python_and_is_idempotent(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    once = text.clean_text(c)
    got = df.select("i", once.alias("a"), text.clean_text(once).alias("b")).collect()
    for r in got:
        assert r["a"] == (re.sub(r"\s+", " ", texts[r["i"]].strip()) or None)
        assert r["a"] == r["b"]


@pytest.mark.parametrize(
    "raw, year, corrected",
    [
        ("1999", 1999, False),
        (" 1999 ", 1999, False),
        ("#2004", 2004, True),
        ("ano: 1999", 1999, True),
        ("-1999", 1999, True),
        ("19.99", 1999, True),
        ("1999.0", None, True),
        ("abc", None, True),
        ("1799", None, True),
        ("1800", 1800, False),
        ("2100", 2100, False),
        ("2101", None, True),
        ("9" * 30, None, True),
        ("", None, True),
        (None, None, False),
    ],
)
def test_clean_year(one, raw, year, corrected):
    assert one(text.clean_year(c), x=("string", raw)) == year
    assert one(text.year_corrected(c), x=("string", raw)) is corrected


@pytest.mark.parametrize(
    "raw, value", [("7", 7), (" 7 ", 7), ("3.7", None), ("", None), ("x", None), (None, None)]
)
def test_tolerant_int(one, raw, value):
    assert one(text.tolerant_int(c), x=("string", raw)) == value
    assert one(text.int_corrected(c), x=("string", raw)) is (raw is not None and value is None)


@pytest.mark.parametrize(
    "raw, value",
    [
        ("13.007,12", Decimal("13007.12")),
        (" 8.452,03 ", Decimal("8452.03")),
        ("4.000", Decimal("4000.00")),
        ("927", Decimal("927.00")),
        ("-1,5", Decimal("-1.50")),
        ("1.239,456", Decimal("1239.456")),
        ("10,4", Decimal("10.4")),
        ("0,12345678901", Decimal("0.1234567890")),
        ("0,12345678900", Decimal("0.123456789")),
        ("n/d", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_ptbr(one, raw, value):
    assert one(numbers.parse_ptbr(c), x=("string", raw)) == value


def test_other_numbers(one):
    assert one(numbers.parse_us_money(c), x=("string", "$3,655.82")) == Decimal("3655.82")
    assert one(numbers.parse_us_money(c), x=("string", "free")) is None
    assert one(numbers.parse_thousands(c), x=("string", "1,234,567.5")) == Decimal("1234567.50")
    assert one(numbers.format_ptbr(c), x=("double", 1234567.5)) == "1.234.567,50"
    assert one(numbers.format_brl(c), x=("double", -1234.5)) == "-R$\u00a01.234,50"
    assert one(numbers.format_thousands(c), x=("bigint", 12849041)) == "12.849.041"
    assert one(numbers.decimal_comma(c), x=("double", 12345678.25)) == "12345678,25"
    assert one(numbers.decimal_comma(c), x=("double", 0.0001)) == "0,0001"
    assert one(numbers.decimal_comma(c), x=("double", 3983.0)) == "3983,0"
    assert one(numbers.ratio(c, F.lit(0)), x=("int", 5)) == 0.0
    assert one(numbers.ratio(c, F.lit(8)), x=("int", 1)) == 0.13
    assert one(numbers.percent(c, F.lit(0.0)), x=("double", 5.0)) == 0.0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=40))
def test_ptbr_round_trip(spark, cents):
    df = spark.createDataFrame([(Decimal(n).scaleb(-2),) for n in cents], "x decimal(18,2)")
    bad = df.filter(~numbers.parse_ptbr(numbers.format_ptbr(c)).eqNullSafe(c.cast("decimal(28,2)")))
    assert bad.count() == 0


def test_dates(one):
    day = ("date", dt.date(1996, 2, 29))
    assert one(dates.br_date(c), x=day) == "29/02/1996"
    assert one(dates.year_month(c), x=day) == "1996-02"
    assert one(dates.month_name(F.lit(3))) == "Março"
    assert one(dates.month_label(F.lit(12))) == "Dez"
    assert one(dates.clamp_day(F.lit(1996), F.lit(2), F.lit(31))) == dt.date(1996, 2, 29)
    assert one(dates.clamp_day(F.lit(1997), F.lit(2), F.lit(31))) == dt.date(1997, 2, 28)
    assert one(dates.clamp_day(F.lit(1997), F.lit(1), F.lit(31))) == dt.date(1997, 1, 31)
    assert one(dates.in_period(c, 1996, 2), x=day) is True
    assert one(dates.in_period(c, 1996, 12), x=day) is False
    assert one(dates.in_period(c), x=day) is True


def test_ids_are_stable_and_differ(one):
    first = one(ids.stable_id(F.lit("a"), F.lit(1)))
    assert re.fullmatch("[0-9a-f]{16}", first)
    assert first == one(ids.stable_id(F.lit("a"), F.lit(1)))
    assert first != one(ids.stable_id(F.lit("a"), F.lit(2)))


@pytest.mark.parametrize(
    "pct, n, band",
    [(30, 1, "Excelente"), (15, 1, "Bom"), (0, 1, "Atenção"), (-0.1, 1, "Crítico"), (50, 0, "Sem dados")],
)
def test_health_band(one, pct, n, band):
    assert one(money.health_band(F.lit(float(pct)), F.lit(n))) == band


@pytest.mark.parametrize("pct, band", [(79.9, "ok"), (80, "warning"), (99.9, "warning"), (100, "danger")])
def test_goal_band(one, pct, band):
    assert one(money.goal_band(F.lit(float(pct)))) == band


def test_money(one):
    assert one(money.savings_pct(F.lit(0.0), F.lit(5.0))) == 0.0
    assert one(money.savings_pct(F.lit(100.0), F.lit(150.0))) == -50.0
    assert one(money.signed_value(F.lit("receita"), F.lit(2.0))) == 2.0
    assert one(money.signed_value(F.lit("despesa"), F.lit(2.0))) == -2.0


@pytest.mark.parametrize("word, value", [(0, 0), (32767, 32767), (32768, -32768), (65535, -1)])
def test_signed_word(one, word, value):
    assert one(signals.signed_word(F.lit(word >> 8), F.lit(word & 255))) == value


def test_scales(one):
    assert one(signals.accel_g(F.lit(-16384))) == -1.0
    assert one(signals.gyro_dps(F.lit(262))) == 2.0
    assert one(signals.is_byte(c), x=("int", None)) is False
    assert one(signals.is_byte(c), x=("int", 256)) is False


def test_base64(one):
    raw = bytes(range(256)) * 3
    encoded = one(text.encode_base64(c), x=("binary", bytearray(raw)))
    assert encoded == base64.b64encode(raw).decode()
    assert bytes(one(text.decode_base64(c), x=("string", encoded))) == raw
    assert one(text.prefix(c, 3), x=("string", encoded)) == encoded[:3]


def test_arrays(one):
    assert one(arrays.arange(F.lit(10))) == list(range(10))
    assert one(arrays.arange(F.lit(0))) == []
    changed = arrays.assign_slice(arrays.arange(F.lit(10)), 5, 9, 0)
    assert one(changed) == [0, 1, 2, 3, 4, 0, 0, 0, 0, 9]
    m = arrays.reshape(arrays.arange(F.lit(20)), 4, 5)
    assert one(arrays.matrix_row(m, 2)) == [10, 11, 12, 13, 14]
    assert one(arrays.matrix_column(m, 1)) == [1, 6, 11, 16]
    assert one(arrays.submatrix(m, 0, 2, 1, 3)) == [[1, 2], [6, 7]]
    assert one(arrays.submatrix(m, 1, 3, 0, 3)) == [[5, 6, 7], [10, 11, 12]]
    assert tuple(one(arrays.matrix_shape(m))) == (4, 5)


def test_text_search(one):
    assert one(text.matches(c, "matrix|AÇÃO"), x=("string", "Pura ação")) is True
    assert one(text.contains_any("LAZ", c, F.lit("z")), x=("string", "lazer")) is True
    assert one(text.contains_any("q", c, F.lit("z")), x=("string", None)) is False
    assert one(text.default_to(c, "N/A"), x=("string", None)) == "N/A"
    assert one(text.full_name(F.lit("Ana"), F.lit("Lima"))) == "Ana Lima"
