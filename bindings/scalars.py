"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.functions import arrays, dates, ids, money, numbers, signals, text

from .registry import query
from .tables import table

BLANK = r"\s+"


@query(
    "f01_clean_text",
    rf"SELECT doc_id, nullif(trim(regexp_replace(text, '{BLANK}', ' ', 'g')), '') AS text FROM documents",
)
def f01(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.clean_text(F.col("text")).alias("text")
    )


@query(
    "f02_text_corrected",
    rf"""SELECT doc_id, trim(regexp_replace(text, '{BLANK}', ' ', 'g')) <> text AS corrected
        FROM documents""",
)
def f02(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.text_corrected(F.col("text")).alias("corrected")
    )


DIRTY_YEAR_SQL = """CASE o_orderstatus WHEN 'F' THEN '#' || year(o_orderdate)
    WHEN 'O' THEN CAST(year(o_orderdate) AS VARCHAR) || '.0' ELSE CAST(year(o_orderdate) AS VARCHAR) END"""


def _dirty_year():
    year = F.year("o_orderdate").cast("string")
    status = F.col("o_orderstatus")
    return (
        F.when(status == "F", F.concat(F.lit("#"), year))
        .when(status == "O", F.concat(year, F.lit(".0")))
        .otherwise(year)
    )


@query(
    "f03_clean_year",
    f"""WITH y AS (SELECT o_orderkey, {DIRTY_YEAR_SQL} AS raw FROM orders),
         d AS (SELECT *, CAST(regexp_replace(raw, '[^0-9]', '', 'g') AS INTEGER) AS n FROM y)
       SELECT o_orderkey, CASE WHEN n BETWEEN 1800 AND 2100 THEN n END AS ano,
         raw <> COALESCE(CAST(CASE WHEN n BETWEEN 1800 AND 2100 THEN n END AS VARCHAR), '')
           AS corrected FROM d""",
)
def f03(spark, sf):
    dirty = table(spark, sf, "orders").select("o_orderkey", _dirty_year().alias("raw"))
    return dirty.select(
        "o_orderkey",
        text.clean_year(F.col("raw")).alias("ano"),
        text.year_corrected(F.col("raw")).alias("corrected"),
    )


@query(
    "f04_tolerant_int",
    """WITH v AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR)
           WHEN 'O' THEN o_custkey || '.7' ELSE 'x' || o_custkey END AS raw FROM orders)
       SELECT o_orderkey, CASE WHEN regexp_full_match(raw, '[0-9]+') THEN CAST(raw AS INTEGER) END
         AS tipo_id FROM v""",
)
def f04(spark, sf):
    key = F.col("o_custkey").cast("string")
    raw = (
        F.when(F.col("o_orderstatus") == "F", key)
        .when(F.col("o_orderstatus") == "O", F.concat(key, F.lit(".7")))
        .otherwise(F.concat(F.lit("x"), key))
    )
    return table(spark, sf, "orders").select("o_orderkey", text.tolerant_int(raw).alias("tipo_id"))


@query("f05_parse_ptbr", "SELECT o_orderkey, o_totalprice AS value FROM orders")
def f05(spark, sf):
    shown = numbers.format_ptbr(F.col("o_totalprice"))
    df = table(spark, sf, "orders").select("o_orderkey", shown.alias("shown"))
    return df.select(
        "o_orderkey", numbers.parse_ptbr(F.col("shown")).cast("double").alias("value")
    )


@query(
    "f05_parse_many_decimals",
    """SELECT o_orderkey, CAST(o_orderkey || '.12345678901' AS DOUBLE) AS value,
         CAST(CAST(o_orderkey || '.1234567890' AS DECIMAL(38,10)) AS VARCHAR) AS kept, o_orderkey % 2 = 0 AS rounded FROM orders""",
)
def f05_decimals(spark, sf):
    """Eleven decimals, of which a parser with ten rounds the last; every second row has one decimal fewer."""
    key = F.col("o_orderkey")
    shown = F.concat(key, F.lit(",12345678901"))
    fewer = F.concat(key, F.lit(",1234567890"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        numbers.ptbr_double(shown).alias("value"),
        numbers.parse_ptbr(shown).cast("string").alias("kept"),
        numbers.more_decimals(F.when(key % 2 == 0, shown).otherwise(fewer)).alias("rounded"),
    )


@query("f06_parse_us_money", "SELECT o_orderkey, o_totalprice AS value FROM orders")
def f06(spark, sf):
    shown = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    df = table(spark, sf, "orders").select("o_orderkey", shown.alias("shown"))
    return df.select(
        "o_orderkey", numbers.parse_us_money(F.col("shown")).cast("double").alias("value")
    )


@query(
    "f07_format_ptbr",
    """SELECT o_orderkey, translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS ptbr,
         'R$' || chr(160) || translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS brl
       FROM orders""",
)
def f07(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", numbers.format_ptbr(price).alias("ptbr"), numbers.format_brl(price).alias("brl")
    )


@query(
    "f08_format_thousands",
    "SELECT o_orderkey, replace(format('{:,}', o_orderkey * 1000 + 7), ',', '.') AS shown FROM orders",
)
def f08(spark, sf):
    n = F.col("o_orderkey") * 1000 + 7
    return table(spark, sf, "orders").select(
        "o_orderkey", numbers.format_thousands(n).alias("shown")
    )


@query("f09_br_date", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS dia FROM orders")
def f09(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.br_date(F.col("o_orderdate").cast("date")).alias("dia")
    )


@query(
    "f10_year_month",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano,
         CAST(month(o_orderdate) AS INTEGER) AS mes, strftime(o_orderdate, '%Y-%m') AS ano_mes
       FROM orders""",
)
def f10(spark, sf):
    date = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(date).alias("ano"),
        F.month(date).alias("mes"),
        dates.year_month(date).alias("ano_mes"),
    )


MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in dates.MONTHS) + "]"


@query(
    "f11_month_names",
    f"""SELECT o_orderkey, ({MONTHS_SQL})[month(o_orderdate)] AS mes,
         substring(({MONTHS_SQL})[month(o_orderdate)], 1, 3) AS rotulo FROM orders""",
)
def f11(spark, sf):
    month = F.month(F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.month_name(month).alias("mes"), dates.month_label(month).alias("rotulo")
    )


@query(
    "f12_clamp_day",
    """SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate),
         least(o_custkey % 31 + 1, day(last_day(o_orderdate)))) AS vencimento FROM orders""",
)
def f12(spark, sf):
    date = F.col("o_orderdate").cast("date")
    day = (F.col("o_custkey") % 31 + 1).cast("int")
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.clamp_day(F.year(date), F.month(date), day).alias("vencimento")
    )


@query(
    "f13_stable_id",
    "SELECT o_orderkey, substring(sha256(o_orderkey || '-' || o_orderstatus), 1, 16) AS id FROM orders",
)
def f13(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", ids.stable_id(F.col("o_orderkey"), F.col("o_orderstatus")).alias("id")
    )


@query(
    "f14_ratio",
    # Half-up division of whole numbers, so that ties do not hang on binary fractions.
    """WITH c AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS p,
           CAST(l_quantity AS BIGINT) AS q, CAST(round(l_tax * 100) AS BIGINT) AS t,
           CAST(round(l_discount * 100) AS BIGINT) AS d FROM lineitem)
       SELECT l_orderkey, l_linenumber, (200 * p + q) // (2 * q) / 100.0 AS unit_cents,
         CASE WHEN d > 0 THEN (200 * t + d) // (2 * d) / 100.0 ELSE 0.0 END AS tax_ratio FROM c""",
)
def f14(spark, sf):
    def whole(name):
        return F.round(F.col(name) * 100)

    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.ratio(whole("l_extendedprice"), F.col("l_quantity")).alias("unit_cents"),
        numbers.ratio(whole("l_tax"), whole("l_discount")).alias("tax_ratio"),
    )


BANDS_SQL = """WITH e AS (SELECT c_custkey, CASE WHEN c_acctbal > 0
    THEN (c_acctbal - 1000.0) / c_acctbal * 100 ELSE 0.0 END AS pct FROM customer)"""


@query("f15_savings_pct", f"{BANDS_SQL} SELECT c_custkey, round(pct, 1) AS economia FROM e")
def f15(spark, sf):
    pct = money.savings_pct(F.col("c_acctbal"), F.lit(1000.0), 1)
    return table(spark, sf, "customer").select("c_custkey", pct.alias("economia"))


@query(
    "f16_bands",
    BANDS_SQL
    + """ SELECT c_custkey, CASE WHEN pct >= 30 THEN 'Excelente' WHEN pct >= 15 THEN 'Bom'
           WHEN pct >= 0 THEN 'Atenção' ELSE 'Crítico' END AS saude,
         CASE WHEN pct >= 100 THEN 'danger' WHEN pct >= 80 THEN 'warning' ELSE 'ok' END AS meta
       FROM e""",
)
def f16(spark, sf):
    pct = money.savings_pct(F.col("c_acctbal"), F.lit(1000.0))
    return table(spark, sf, "customer").select(
        "c_custkey",
        money.health_band(pct, F.lit(1)).alias("saude"),
        money.goal_band(pct).alias("meta"),
    )


@query(
    "f17_signed_value",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END
         AS valor FROM orders""",
)
def f17(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "F", "receita").otherwise("despesa")
    return table(spark, sf, "orders").select(
        "o_orderkey", money.signed_value(kind, F.col("o_totalprice")).alias("valor")
    )


@query(
    "f18_full_name",
    "SELECT p_partkey, p_brand || ' ' || p_name AS nome FROM part",
)
def f18(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.full_name(F.col("p_brand"), F.col("p_name")).alias("nome")
    )


@query(
    "f19_default",
    "SELECT o_orderkey, COALESCE(nullif(o_orderpriority, '5-LOW'), 'N/A') AS prioridade FROM orders",
)
def f19(spark, sf):
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return table(spark, sf, "orders").select(
        "o_orderkey", text.default_to(priority, "N/A").alias("prioridade")
    )


@query(
    "f20_base64",
    """SELECT doc_id, to_base64(encode(text)) AS b64, substring(to_base64(encode(text)), 1, 20) AS head,
         text AS back FROM documents""",
)
def f20(spark, sf):
    encoded = text.encode_base64(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id",
        encoded.alias("b64"),
        text.prefix(encoded, 20).alias("head"),
        text.decode_base64(encoded).cast("string").alias("back"),
    )


@query(
    "f21_signed_word",
    """WITH w AS (SELECT event_id, (event_id % 256) * 256 + user_id % 256 AS w FROM events)
       SELECT event_id, CASE WHEN w > 32767 THEN w - 65536 ELSE w END AS palavra FROM w""",
)
def f21(spark, sf):
    word = signals.signed_word(F.col("event_id") % 256, F.col("user_id") % 256)
    return table(spark, sf, "events").select("event_id", word.alias("palavra"))


@query(
    "f22_scale",
    """WITH w AS (SELECT event_id, (event_id % 256) * 256 + user_id % 256 AS w FROM events),
         s AS (SELECT event_id, CASE WHEN w > 32767 THEN w - 65536 ELSE w END AS w FROM w)
       SELECT event_id, round(w / 16384.0, 2) + 0.0 AS g, round(w / 131.0, 2) + 0.0 AS dps FROM s""",
)
def f22(spark, sf):
    word = signals.signed_word(F.col("event_id") % 256, F.col("user_id") % 256)
    return table(spark, sf, "events").select(
        "event_id", signals.accel_g(word).alias("g"), signals.gyro_dps(word).alias("dps")
    )


@query(
    "f23_arange",
    "SELECT p_partkey, array_to_string(range(0, p_size), ',') AS valores FROM part",
)
def f23(spark, sf):
    values = arrays.arange(F.col("p_size")).cast("array<string>")
    return table(spark, sf, "part").select("p_partkey", F.concat_ws(",", values).alias("valores"))


def _joined(a):
    """Vector as text of whole thousandths, so that engines print it alike."""
    whole = F.transform(a, lambda x: F.floor(x.cast("double") * 1000).cast("string"))
    return F.concat_ws(",", whole)


def _joined_sql(a):
    return (
        f"array_to_string(list_transform({a}, lambda x: "
        "CAST(CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)), ',')"
    )


_E = "CAST(embedding AS DOUBLE[])"


@query(
    "f24_assign_slice",
    f"""SELECT vec_id, {_joined_sql(f"list_concat(list_concat(({_E})[1:5], [0.0, 0.0, 0.0, 0.0]), ({_E})[10:])")}
         AS vetor FROM embeddings""",
)
def f24(spark, sf):
    vector = arrays.assign_slice(F.col("embedding"), 5, 9, 0.0)
    return table(spark, sf, "embeddings").select("vec_id", _joined(vector).alias("vetor"))


@query(
    "f25_matrix_parts",
    f"""SELECT vec_id, {_joined_sql(f"({_E})[17:24]")} AS linha,
         {_joined_sql(f"[({_E})[2], ({_E})[10], ({_E})[18], ({_E})[26], ({_E})[34], ({_E})[42], ({_E})[50], ({_E})[58]]")}
           AS coluna,
         {_joined_sql(f"list_concat(({_E})[9:11], ({_E})[17:19])")} AS bloco,
         8 AS linhas, 8 AS colunas FROM embeddings""",
)
def f25(spark, sf):
    matrix = arrays.reshape(F.col("embedding"), 8, 8)
    shape = arrays.matrix_shape(matrix)
    return table(spark, sf, "embeddings").select(
        "vec_id",
        _joined(arrays.matrix_row(matrix, 2)).alias("linha"),
        _joined(arrays.matrix_column(matrix, 1)).alias("coluna"),
        _joined(F.flatten(arrays.submatrix(matrix, 1, 3, 0, 3))).alias("bloco"),
        shape["rows"].alias("linhas"),
        shape["cols"].alias("colunas"),
    )


@query(
    "f26_label",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS rotulo,
         CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS nivel FROM orders""",
)
def f26(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.as_label(F.year(F.col("o_orderdate").cast("date"))).alias("rotulo"),
        text.tolerant_int(F.substring("o_orderpriority", 1, 1)).alias("nivel"),
    )
