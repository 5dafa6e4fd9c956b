"""Whole jobs: raw files are landed from the tables, the job runs, its output is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from marquetry.plans import catalogue, production
from marquetry.plans import ledger as ledger_plan
from marquetry.schemas import CREW_RAW, PERSON_RAW
from marquetry.session import scratch_path
from marquetry.sources.writers import write_jsonl

from .registry import query
from .sources import TRACKS_SQL, artist_payloads
from .tables import GOALS_SQL, LEDGER_SQL, goals, ledger, table


def _lines(df, *fields):
    """JSON lines of (name, value column) pairs; values that are NULL are left out."""
    return df.select(F.to_json(F.struct(*[v.alias(n) for n, v in fields])).alias("value"))


def _land(path, *parts):
    reduce(lambda a, b: a.unionByName(b), parts).write.text(path)


def land_raw(spark, sf):
    """Untidy people, works and crew: copies, ids in other forms, missing and broken ones, orphans."""
    base = scratch_path(spark, "raw")
    people = table(spark, sf, "customer").select("c_custkey", "c_name")
    key = F.col("c_custkey")
    # Whole numbers written as a number, as text and with a decimal point.
    shown = (
        F.when(key % 3 == 0, F.concat(F.lit('"'), key, F.lit('"')))
        .when(key % 3 == 1, F.concat(key, F.lit(".0")))
        .otherwise(key.cast("string"))
    )
    person = F.concat(F.lit('{"id_pessoa": '), shown, F.lit(', "nome": "  '), F.col("c_name"), F.lit(' "}'))
    _land(
        f"{base}/pessoa.jsonl",
        people.select(person.alias("value")),
        people.filter(key % 5 == 0).select(person.alias("value")),
        _lines(people.filter(key % 13 == 0), ("nome", F.col("c_name"))),
        people.filter(key % 17 == 0).select(F.concat(F.lit('{"id_pessoa": '), key).alias("value")),
        _lines(people.filter(key % 19 == 0), ("id_pessoa", F.concat(F.lit("x"), key)), ("nome", F.col("c_name"))),
    )
    works = table(spark, sf, "orders")
    _land(
        f"{base}/producao.jsonl",
        _lines(
            works,
            ("id_producao", F.col("o_orderkey")),
            ("titulo", F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Title   "), "o_orderkey"))),
            ("ano", F.concat(F.lit("#"), F.year(F.col("o_orderdate").cast("date")))),
            ("tipo_id", F.substring("o_orderpriority", 1, 1)),
        ),
    )
    crew = table(spark, sf, "lineitem")
    line = (
        ("id_producao", F.col("l_orderkey")),
        ("id_pessoa", F.col("l_partkey")),
        ("papel", F.concat(F.lit(" "), "l_returnflag")),
    )
    _land(
        f"{base}/equipe.jsonl",
        _lines(crew, *line),
        _lines(crew.filter(F.col("l_linenumber") == 1), *line),
        _lines(crew.filter(F.col("l_linenumber") == 5), line[0], line[2]),
    )
    return base


def cleaned(spark, sf):
    """Counters of the job and the folder of its output."""
    target = scratch_path(spark, "clean")
    return production.run(spark, land_raw(spark, sf), target), target


CREW_LINES = """lines AS (SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem
           UNION ALL SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_linenumber = 1),
         ok AS (SELECT * FROM lines WHERE l_partkey IN (SELECT c_custkey FROM customer)
           AND l_orderkey IN (SELECT o_orderkey FROM orders))"""


@query(
    "production_run_counters",
    f"""WITH {CREW_LINES},
         p AS (SELECT count(*) AS n, count(CASE WHEN c_custkey % 5 = 0 THEN 1 END) AS dup,
           count(CASE WHEN c_custkey % 13 = 0 THEN 1 END) AS nul, count(CASE WHEN c_custkey % 17 = 0 THEN 1 END) AS par,
           count(CASE WHEN c_custkey % 19 = 0 THEN 1 END) AS inv FROM customer)
       SELECT 'pessoa' AS dataset, n + dup + nul + par + inv AS lidos, n AS escritos, dup AS duplicatas,
         nul AS nulos_removidos, CAST(0 AS BIGINT) AS titulos_nulos, n AS correcoes, CAST(0 AS BIGINT) AS orfaos,
         par AS erros_parse, inv AS ids_invalidos FROM p
       UNION ALL SELECT 'producao', count(*), count(*), 0, 0, count(CASE WHEN o_orderstatus = 'P' THEN 1 END),
         2 * count(*) - count(CASE WHEN o_orderstatus = 'P' THEN 1 END), 0, 0, 0 FROM orders
       UNION ALL SELECT 'equipe', (SELECT count(*) FROM lines)
           + (SELECT count(*) FROM lineitem WHERE l_linenumber = 5),
         (SELECT count(*) FROM (SELECT DISTINCT * FROM ok)),
         (SELECT count(*) FROM ok) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ok)),
         (SELECT count(*) FROM lineitem WHERE l_linenumber = 5), 0, (SELECT count(*) FROM ok),
         (SELECT count(*) FROM lines) - (SELECT count(*) FROM ok), 0, 0""",
)
def run_counters(spark, sf):
    return cleaned(spark, sf)[0]


@query("production_people", "SELECT c_custkey AS id_pessoa, c_name AS nome FROM customer")
def run_people(spark, sf):
    target = cleaned(spark, sf)[1]
    return spark.read.schema(PERSON_RAW).json(f"{target}/pessoa_clean")


@query(
    "production_works",
    """SELECT o_orderkey AS id_producao, CASE WHEN o_orderstatus <> 'P' THEN 'Title ' || o_orderkey END AS titulo,
         CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tipo_id
       FROM orders""",
)
def run_works(spark, sf):
    target = cleaned(spark, sf)[1]
    return spark.read.schema("id_producao long, titulo string, ano int, tipo_id int").json(f"{target}/producao_clean")


@query(
    "production_crew",
    f"""WITH {CREW_LINES} SELECT DISTINCT l_orderkey AS id_producao, l_partkey AS id_pessoa,
         l_returnflag AS papel FROM ok""",
)
def run_crew(spark, sf):
    target = cleaned(spark, sf)[1]
    return spark.read.schema(CREW_RAW).json(f"{target}/equipe_clean")


@query(
    "production_rejects",
    """SELECT 'parse' AS reason, '{"id_pessoa": ' || c_custkey AS line, CAST(1 AS BIGINT) AS copies FROM customer
         WHERE c_custkey % 17 = 0
       UNION ALL SELECT 'invalid', '{"id_pessoa":"x' || c_custkey || '","nome":"' || c_name || '"}', 1
         FROM customer WHERE c_custkey % 19 = 0""",
)
def run_rejects(spark, sf):
    target = cleaned(spark, sf)[1]
    return spark.read.schema("reason string, line string, copies long").json(f"{target}/pessoa_rejects")


@query(
    "production_load_collection",
    """SELECT count(*) + count(CASE WHEN c_custkey % 5 = 0 THEN 1 END) + count(CASE WHEN c_custkey % 13 = 0 THEN 1 END)
           AS documentos,
         count(CASE WHEN c_custkey % 17 = 0 THEN 1 END) + count(CASE WHEN c_custkey % 19 = 0 THEN 1 END) AS erros,
         count(CASE WHEN c_custkey % 5 = 0 THEN 1 END)
           + CASE WHEN count(CASE WHEN c_custkey % 13 = 0 THEN 1 END) > 1 THEN 1 ELSE 0 END AS repetidos
       FROM customer""",
)
def run_load(spark, sf):
    path = f"{land_raw(spark, sf)}/pessoa.jsonl"
    return production.load_collection(spark, path, PERSON_RAW, scratch_path(spark, "loaded"), ["id_pessoa"])


@query(
    "catalogue_export_tracks",
    f"""WITH {TRACKS_SQL}, a AS (SELECT DISTINCT 'Artist ' || o_custkey AS artista FROM orders),
         n AS (SELECT artista, count(*) AS faixas FROM tracks GROUP BY 1)
       SELECT a.artista, COALESCE(faixas, 0) AS faixas FROM a LEFT JOIN n ON a.artista = n.artista""",
)
def run_export(spark, sf):
    landed = scratch_path(spark, "payloads")
    write_jsonl(artist_payloads(spark, sf), landed)
    return catalogue.export_tracks(spark, landed, scratch_path(spark, "tracks-csv"))


@query(
    "ledger_import_backup",
    f"""WITH {LEDGER_SQL}, {GOALS_SQL},
         t AS (SELECT 'transactions' AS of, CAST(id AS VARCHAR) AS id, value FROM ledger
           UNION ALL SELECT 'transactions', 'new ' || id, value * 2 FROM ledger WHERE id % 32 = 1),
         g AS (SELECT 'goals' AS of, category AS id, CASE WHEN category = 'Aluguel' THEN 77.0
             WHEN category = 'Transporte' THEN 5.5 ELSE limit_value END AS value FROM goals
           UNION ALL SELECT 'goals', 'Viagem', 9.0)
       SELECT * FROM t UNION ALL SELECT * FROM g""",
)
def run_import(spark, sf):
    """Half of the backup's transactions are there already; goals come under both names of the limit."""
    columns = ["id", "value"]
    book = ledger(spark, sf).select(F.col("id").cast("string").alias("id"), "value", F.col("id").alias("seq"))
    some = book.filter(F.col("seq") % 32 == 1)
    incoming = some.unionByName(
        some.select(F.concat(F.lit("new "), "id").alias("id"), (F.col("value") * 2).alias("value"), "seq")
    )
    limits = [("Aluguel", 70.0, None, 1), ("Aluguel", 77.0, None, 2), ("Transporte", 0.0, 5.5, 3), ("Viagem", None, 9.0, 4), ("Lazer", -1.0, None, 5)]
    new_goals = spark.createDataFrame(limits, "category string, limit_value double, limit double, seq long")
    merged = ledger_plan.import_backup(
        {"transactions": book, "goals": goals(spark, sf)}, {"transactions": incoming, "goals": new_goals}
    )
    rows = merged["transactions"].select(F.lit("transactions").alias("of"), *columns)
    return rows.unionByName(
        merged["goals"].select(F.lit("goals").alias("of"), F.col("category").alias("id"), F.col("limit_value").alias("value"))
    )
