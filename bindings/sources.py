"""Scans and sinks: each query writes the given tables and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marquetry.functions.text import clean_text, encode_base64
from marquetry.schemas import ARTIST_PAYLOAD, PERSON_PAYLOAD
from marquetry.session import scratch_path
from marquetry.sources import payloads, readers, sizes, writers

from .registry import query
from .tables import GOALS_SQL, LEDGER_SQL, RECURRING_SQL, goals, ledger, money, recurring, table


@query(
    "s01_jsonl_scan",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def s01(spark, sf):
    df = table(spark, sf, "orders").drop("o_orderdate")
    path = scratch_path(spark, "s01")
    writers.write_jsonl(df, path)
    return readers.read_jsonl(spark, path, df.schema)


@query(
    "s02_tolerant_jsonl_scan",
    """SELECT event_type = 'error' AS bad, count(*) AS n,
        CAST(COALESCE(SUM(CASE WHEN event_type <> 'error'
             THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END), 0) AS BIGINT) AS sum_k
       FROM events GROUP BY 1""",
)
def s02(spark, sf):
    broken = F.expr("substring(props, 1, length(props) - 1)")
    path = scratch_path(spark, "s02")
    lines = F.when(F.col("event_type") == "error", broken).otherwise(F.col("props"))
    table(spark, sf, "events").select(lines.alias("value")).write.text(path)
    schema = StructType([StructField("k", LongType())])
    df = readers.read_jsonl_tolerant(spark, path, schema)
    return df.groupBy(F.col(readers.CORRUPT).isNotNull().alias("bad")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("sum_k")
    )


@query("s03_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s03(spark, sf):
    df = table(spark, sf, "customer")
    path = scratch_path(spark, "s03")
    writers.write_csv(df, path)
    return readers.read_csv(spark, path, df.schema)


@query(
    "s04_csv_semicolon_ptbr",
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, s_acctbal FROM supplier",
)
def s04(spark, sf):
    amount = F.translate(F.format_number("s_acctbal", 2), ",.", ".,")
    padded = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias(" s_suppkey "),
        F.concat(F.lit(" "), "s_name", F.lit("   ")).alias("s_name  "),
        F.concat(F.lit("  "), amount).alias("  s_acctbal"),
    )
    path = scratch_path(spark, "s04")
    (
        padded.write.option("header", True)
        .option("sep", ";")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return readers.read_csv_ptbr(spark, path, ["s_acctbal"])


@query(
    "s05_csv_thousands",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice FROM orders",
)
def s05(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.format_number("o_totalprice", 2).alias("o_totalprice")
    )
    path = scratch_path(spark, "s05")
    writers.write_csv(df, path)
    return readers.read_csv_thousands(spark, path, ["o_totalprice"])


@query("s06_csv_byte_order_mark", "SELECT p_partkey, p_name, p_retailprice FROM part")
def s06(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    path = scratch_path(spark, "s06")
    writers.write_csv(df, path, bom=True)
    return readers.read_csv(spark, path, df.schema)


@query(
    "s07_csv_decimal_comma_sink",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_retailprice FROM part",
)
def s07(spark, sf):
    path = scratch_path(spark, "s07")
    writers.write_csv_ptbr(table(spark, sf, "part").select("p_partkey", "p_retailprice"), path)
    return readers.read_csv_ptbr(spark, path, ["p_retailprice"])


@query(
    "s07_decimal_columns",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, replace(CAST(CAST(p_retailprice AS DECIMAL(12,3)) AS VARCHAR),
         '.', ',') AS price FROM part""",
)
def s07_decimal(spark, sf):
    """Columns of decimals get the comma, too."""
    path = scratch_path(spark, "s07d")
    df = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(12,3)").alias("price"))
    writers.write_csv_ptbr(df, path)
    return readers.read_csv_text(spark, path, sep=";")


def _priority_lines(spark, sf, name, keep_nulls):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    )
    path = scratch_path(spark, name)
    writers.write_jsonl(df, path, keep_nulls)
    value = F.col("value")
    return spark.read.text(path).select(
        F.get_json_object(value, "$.o_orderkey").cast("long").alias("o_orderkey"),
        F.get_json_object(value, "$.o_orderpriority").alias("o_orderpriority"),
        F.contains(value, F.lit('"o_orderpriority"')).alias("has_field"),
    )


@query(
    "s08_jsonl_sink_dropping_nulls",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
        o_orderpriority <> '5-LOW' AS has_field FROM orders""",
)
def s08(spark, sf):
    return _priority_lines(spark, sf, "s08", keep_nulls=False)


@query(
    "s09_jsonl_sink_keeping_nulls",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
        TRUE AS has_field FROM orders""",
)
def s09(spark, sf):
    return _priority_lines(spark, sf, "s09", keep_nulls=True)


@query("s10_collection_overwrite", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def s10(spark, sf):
    df = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    path = scratch_path(spark, "s10")
    writers.write_collection(df.withColumn("s_acctbal", F.lit(0.0)), path)
    writers.write_collection(df, path)
    return readers.read_collection(spark, path)


@query(
    "s11_find",
    """SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 1""",
)
def s11(spark, sf):
    wanted = {"c_mktsegment": "BUILDING", "c_nationkey": 1}
    return readers.find(table(spark, sf, "customer"), wanted)


@query(
    "s11_find_limit",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 5",
)
def s11_limit(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return readers.find(customers, key="c_custkey", limit=5)


@query(
    "s12_literal_rows",
    """SELECT r.label, r.rank, count(*) AS n
       FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3)) AS r(label, rank)
       JOIN orders ON o_orderpriority = r.label GROUP BY ALL""",
)
def s12(spark, sf):
    rows = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)]
    ranks = readers.load_rows(spark, rows, "label string, rank int")
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("label")).count()
    return ranks.join(counts, "label").withColumnRenamed("count", "n")


@query(
    "s13_frame_from_columns",
    """SELECT r.status, r.weight, CAST(sum(r.weight) AS BIGINT) AS weighted
       FROM (VALUES ('F', 1), ('O', 2), ('P', 3)) AS r(status, weight)
       JOIN orders ON o_orderstatus = r.status GROUP BY ALL""",
)
def s13_columns(spark, sf):
    columns = {"status": ["F", "O", "P"], "weight": [1, 2, 3]}
    weights = readers.frame_from_columns(spark, columns, "status string, weight int")
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).count()
    return weights.join(counts, "status").select(
        "status", "weight", (F.col("count") * F.col("weight")).alias("weighted")
    )


@query(
    "s13_frame_from_records",
    """SELECT r.status, r.label, r.bonus, count(*) AS n
       FROM (VALUES ('F', 'done', NULL), ('O', NULL, 500), ('P', 'part', 20)) AS r(status, label, bonus)
       JOIN orders ON o_orderstatus = r.status GROUP BY ALL""",
)
def s13_records(spark, sf):
    schema = StructType(
        [
            StructField("status", StringType()),
            StructField("label", StringType()),
            StructField("bonus", LongType()),
        ]
    )
    records = [
        {"status": "F", "label": "done"},
        {"status": "O", "bonus": 500},
        {"status": "P", "label": "part", "bonus": 20},
    ]
    frame = readers.frame_from_records(spark, records, schema)
    frame = frame.withColumn("bonus", F.col("bonus").cast("int"))
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).count()
    return frame.join(counts, "status").withColumnRenamed("count", "n")


def _land(spark, lines, name, schema):
    """Write payload lines and scan them, as a collector's landing folder is."""
    path = scratch_path(spark, name)
    lines.write.text(path)
    return payloads.read_payloads(spark, path, schema)


def people_payloads(spark, sf):
    """One payload per customer, with one to three people."""

    def person(i):
        return F.struct(
            F.struct(
                F.lit("Customer").alias("first"),
                F.concat("c_custkey", F.lit("-"), i.cast("string")).alias("last"),
            ).alias("name"),
            F.struct((18 + (F.col("c_custkey") * 7 + i * 13) % 50).cast("int").alias("age")).alias(
                "dob"
            ),
            F.concat(F.lit("c"), "c_custkey", F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+55 "), "c_nationkey").alias("phone"),
        )

    people = F.transform(F.sequence(F.lit(0), (F.col("c_custkey") % 3).cast("int")), person)
    lines = table(spark, sf, "customer").select(
        F.to_json(F.struct(people.alias("results"))).alias("value")
    )
    return _land(spark, lines, "people", PERSON_PAYLOAD)


@query(
    "s14_employee_payloads",
    """WITH p AS (SELECT *, CAST(18 + (c_custkey * 7 + i * 13) % 50 AS INTEGER) AS idade
         FROM customer, unnest(range(0, c_custkey % 3 + 1)) AS t(i))
       SELECT 'Customer ' || c_custkey || '-' || i AS nome, idade,
         'c' || c_custkey || '@example.com' AS email, '+55 ' || c_nationkey AS telefone,
         CASE WHEN idade < 30 THEN 'Desenvolvedor' ELSE 'Gerente' END AS cargo,
         CASE WHEN idade < 30 THEN 7000 ELSE 12000 END AS salario, 'TI' AS setor FROM p""",
)
def s14(spark, sf):
    return payloads.employee_documents(people_payloads(spark, sf))


def artist_payloads(spark, sf):
    """One payload per order, with one or two albums of one to four tracks."""

    def track(j):
        return F.struct(F.concat(F.lit("Track "), j.cast("string")).alias("name"))

    def album(i):
        last = ((F.col("o_orderkey") + i) % 4).cast("int")
        return F.struct(
            i.cast("string").alias("id"),
            F.concat(F.lit("Album "), "o_orderkey", F.lit("-"), i.cast("string")).alias("name"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date").cast("string"))
            .alias("release_date"),
            F.transform(F.sequence(F.lit(0), last), track).alias("tracks"),
        )

    hit = F.array(F.struct(F.col("o_custkey").cast("string").alias("id")))
    none = F.filter(hit, lambda x: F.lit(False))
    doc = F.struct(
        F.concat(F.lit("Artist "), "o_custkey").alias("name"),
        F.struct(F.when(F.col("o_orderpriority") == "5-LOW", none).otherwise(hit).alias("items"))
        .alias("artists"),
        F.transform(F.sequence(F.lit(0), (F.col("o_orderkey") % 2).cast("int")), album)
        .alias("albums"),
    )
    lines = table(spark, sf, "orders").select(F.to_json(doc).alias("value"))
    return _land(spark, lines, "artists", ARTIST_PAYLOAD)


TRACKS_SQL = """tracks AS (
    SELECT 'Track ' || j AS musica, 'Artist ' || o_custkey AS artista,
      'Album ' || o_orderkey || '-' || i AS album,
      CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'N/A' END
        AS data_lancamento
    FROM orders, unnest(range(0, o_orderkey % 2 + 1)) AS a(i),
      unnest(range(0, (o_orderkey + i) % 4 + 1)) AS t(j)
    WHERE o_orderpriority <> '5-LOW')"""


@query("s15_track_payloads", f"WITH {TRACKS_SQL} SELECT * FROM tracks")
def s15(spark, sf):
    return payloads.track_rows(artist_payloads(spark, sf))


@query(
    "a20_extraction_counts",
    f"WITH {TRACKS_SQL} SELECT artista, count(*) AS faixas FROM tracks GROUP BY artista",
)
def a20(spark, sf):
    return payloads.extraction_counts(payloads.track_rows(artist_payloads(spark, sf)))


def _images(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("nome"),
        encode_base64(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("dados_base64"),
    )


@query(
    "s16_base64_table",
    """SELECT DISTINCT 'p' || CAST(p_size AS VARCHAR) || '.bin' AS nome, to_base64(encode(string_agg(
         p_partkey || ' ' || p_name || chr(10), '' ORDER BY p_partkey))) AS dados_base64
       FROM part GROUP BY p_size""",
)
def s16(spark, sf):
    """Files landed from ``part``, one for each size, read as a table of their bytes."""
    path = scratch_path(spark, "s16")
    line = F.concat_ws(" ", "p_partkey", "p_name")
    landed = table(spark, sf, "part").select("p_size", "p_partkey", line.alias("value"))
    landed = landed.repartition("p_size").sortWithinPartitions("p_size", "p_partkey")
    landed.select("p_size", "value").write.partitionBy("p_size").text(path)
    files = readers.binary_table(spark, f"{path}/p_size=*/*.txt", folder="nome")
    return files.select(
        F.concat(F.lit("p"), F.substring_index("nome", "=", -1), F.lit(".bin")).alias("nome"), "dados_base64"
    )


@query(
    "s17_base64_decode",
    """SELECT p_partkey AS id, p_name AS nome, p_name || ' ' || p_brand || ' ' || p_type AS text
       FROM part""",
)
def s17(spark, sf):
    df = readers.binary_content(_images(spark, sf))
    return df.select("id", "nome", F.col("content").cast("string").alias("text"))


@query(
    "s17_latest_binary",
    """SELECT p_partkey AS id, p_name AS nome, p_name || ' ' || p_brand || ' ' || p_type AS text
       FROM part ORDER BY p_partkey DESC LIMIT 1""",
)
def s17_latest(spark, sf):
    df = readers.latest_binary(_images(spark, sf))
    return df.select("id", "nome", F.col("content").cast("string").alias("text"))


@query(
    "s18_backup",
    f"""WITH {LEDGER_SQL}, {RECURRING_SQL}, {GOALS_SQL}
       SELECT 'transactions' AS name, count(*) AS n, {money("value")} AS total FROM ledger
       UNION ALL SELECT 'recurring', count(*), {money("value")} FROM recurring
       UNION ALL SELECT 'goals', count(*), {money("limit_value")} FROM goals""",
)
def s18(spark, sf):
    tables = {
        "transactions": ledger(spark, sf),
        "recurring": recurring(spark, sf),
        "goals": goals(spark, sf),
    }
    path = scratch_path(spark, "s18")
    writers.write_backup(path, tables, {"transactions": ["date", "id"]})
    back = readers.read_backup(spark, path, {name: df.schema for name, df in tables.items()})
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(
                F.col("limit_value" if name == "goals" else "value").cast("decimal(18,2)")
            ).cast("double").alias("total"),
        ).select(F.lit(name).alias("name"), "n", "total")
        for name, df in back.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _clean_sql(column):
    return f"trim(regexp_replace({column}, '\\s+', ' ', 'g'))"


@query(
    "s20_size_report",
    f"""WITH s AS (
         SELECT 'conversations' AS dataset, sum(octet_length(encode(text)) + 1) AS r,
           sum(octet_length(encode({_clean_sql("text")})) + 1) AS c FROM conversations
         UNION ALL SELECT 'documents', sum(octet_length(encode(text)) + 1),
           sum(octet_length(encode({_clean_sql("text")})) + 1) FROM documents)
       SELECT dataset, round(r / 1048576.0, 4) AS raw_mb, round(c / 1048576.0, 4) AS clean_mb,
         round((1 - CAST(c AS DOUBLE) / CAST(r AS DOUBLE)) * 100, 1) AS reduction_pct FROM s""",
)
def s20(spark, sf):
    raw, clean = {}, {}
    for name in ("documents", "conversations"):
        texts = table(spark, sf, name).select("text")
        raw[name], clean[name] = scratch_path(spark, "s20-raw"), scratch_path(spark, "s20-clean")
        texts.write.text(raw[name])
        texts.select(clean_text(F.col("text")).alias("text")).write.text(clean[name])
    return sizes.size_report(spark, raw, clean)
