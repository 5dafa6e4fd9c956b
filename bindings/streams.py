"""Streaming jobs, run over all that is there and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquetry.plans import production
from marquetry.schemas import AXES, PERSON_RAW
from marquetry.session import scratch_path
from marquetry.sources import readers
from marquetry.streaming import cleaning, runner, tallies, telemetry

from .jobs import land_raw
from .registry import query
from .tables import table


def _events(spark, sf):
    schema = table(spark, sf, "events").schema
    return telemetry.sensor_stream(spark, sf, schema, pathGlobFilter="events.parquet")


def _run(spark, stream, name, partition_by=()):
    return runner.run_available(spark, stream, scratch_path(spark, name), partition_by)


@query("s19_sensor_source", "SELECT event_id, user_id, event_type, value FROM events")
def s19(spark, sf):
    stream = _events(spark, sf).select("event_id", "user_id", "event_type", "value")
    return _run(spark, stream, "s19")


def _high(i):
    return f"(event_id * {i + 3} + user_id) % 256"


def _low(i):
    return f"(event_id + user_id * {i + 5}) % 256"


def _readings(events):
    """Events as register readings; errors miss a byte, sign-ups hold an impossible one."""
    columns = ["event_id"]
    for i, axis in enumerate(AXES):
        high, low = F.expr(_high(i)), F.expr(_low(i))
        if axis == "ax":
            low = F.when(F.col("event_type") != "error", low)
        if axis == "gz":
            high = F.when(F.col("event_type") == "signup", 300).otherwise(high)
        columns += [high.cast("int").alias(f"{axis}_h"), low.cast("int").alias(f"{axis}_l")]
    return events.select(*columns)


def _word_sql(i):
    return f"(CASE WHEN {_high(i)} > 127 THEN {_high(i)} * 256 + {_low(i)} - 65536 ELSE {_high(i)} * 256 + {_low(i)} END)"


_MEASURES_SQL = ", ".join(
    f"round({_word_sql(i)} / {'16384.0' if axis.startswith('a') else '131.0'}, 2) + 0.0 AS {axis}"
    for i, axis in enumerate(AXES)
)


@query(
    "st1_sensor_decode",
    f"SELECT event_id, {_MEASURES_SQL} FROM events WHERE event_type NOT IN ('error', 'signup')",
)
def st1(spark, sf):
    decoded = _run(spark, telemetry.decode(_readings(_events(spark, sf))), "st1", ["status"])
    return decoded.filter(F.col("status") == "ok").select("event_id", *AXES)


@query(
    "st2_rejected_readings",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'ax_l' ELSE 'gz_h' END AS reason
       FROM events WHERE event_type IN ('error', 'signup')""",
)
def st2(spark, sf):
    decoded = _run(spark, telemetry.decode(_readings(_events(spark, sf))), "st2", ["status"])
    return decoded.filter(F.col("status") == "rejected").select("event_id", "reason")


@query(
    "st2_two_sinks",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'rejects' ELSE 'readings' END AS sink,
         CASE event_type WHEN 'error' THEN 'ax_l' WHEN 'signup' THEN 'gz_h' END AS reason FROM events""",
)
def st2_sinks(spark, sf):
    """Readings landed in six files, two a batch; the job is started again when it is through."""
    base = scratch_path(spark, "st2s")
    landed = _readings(table(spark, sf, "events"))
    landed.repartition(6, "event_id").write.parquet(f"{base}/landed")
    for _ in range(2):
        stream = telemetry.sensor_stream(spark, f"{base}/landed", landed.schema, maxFilesPerTrigger=2)
        decoded = telemetry.decode(stream)
        telemetry.decode_to_sinks(decoded, base, f"{base}/checkpoint").awaitTermination()
    parts = [
        telemetry.read_sink(spark, base, sink, decoded.schema).select("event_id", F.lit(sink).alias("sink"), "reason")
        for sink in ("readings", "rejects")
    ]
    return parts[0].unionByName(parts[1])


def _people_tallies(spark, sf):
    """Untidy people as JSON lines in several files, tallied a file at a time."""
    source = f"{land_raw(spark, sf)}/pessoa.jsonl"
    lines = readers.stream_lines(spark, source, maxFilesPerTrigger=1)
    kept = tallies.Tallies(spark, scratch_path(spark, "st3t"), PERSON_RAW, production.PEOPLE, 8)
    kept.start(lines, compact_every=3).awaitTermination()
    return kept.current()


@query(
    "st3_stream_counters",
    """WITH p AS (SELECT count(*) AS n, count(CASE WHEN c_custkey % 5 = 0 THEN 1 END) AS dup,
           count(CASE WHEN c_custkey % 13 = 0 THEN 1 END) AS nul, count(CASE WHEN c_custkey % 17 = 0 THEN 1 END) AS par,
           count(CASE WHEN c_custkey % 19 = 0 THEN 1 END) AS inv FROM customer)
       SELECT 'pessoa' AS dataset, n + dup + nul + par + inv AS lidos, n AS escritos, dup AS duplicatas,
         nul AS nulos_removidos, CAST(0 AS BIGINT) AS titulos_nulos, n AS correcoes, CAST(0 AS BIGINT) AS orfaos,
         par AS erros_parse, inv AS ids_invalidos FROM p""",
)
def st3_counters(spark, sf):
    return production.quality_report(_people_tallies(spark, sf), "pessoa")


@query("st3_stream_first_rows", "SELECT c_custkey AS id_pessoa, c_name AS nome FROM customer")
def st3_rows(spark, sf):
    return production.clean_rows(_people_tallies(spark, sf))


@query("st3_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def st3(spark, sf):
    stream = _events(spark, sf).withColumn(
        "event_type", F.concat(F.lit("  "), "event_type", F.lit(" "))
    )
    cleaned = cleaning.clean_stream(stream, ["user_id", "event_type"], ["event_type"])
    return _run(spark, cleaned, "st3").select("user_id", "event_type")


@query("st3_first_seen_within_watermark", "SELECT DISTINCT user_id, event_type FROM events")
def st3_watermark(spark, sf):
    stream = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    cleaned = cleaning.clean_stream(
        stream, ["user_id", "event_type"], ["event_type"], event_time="ts", delay="365 days"
    )
    return _run(spark, cleaned, "st3w").select("user_id", "event_type")


def _parents(spark, sf):
    known = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return known.select(F.col("c_custkey").alias("user_id"))


_KNOWN_SQL = "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"


@query("st4_with_parent", f"SELECT event_id, user_id FROM events WHERE user_id IN {_KNOWN_SQL}")
def st4(spark, sf):
    stream = _events(spark, sf).select("event_id", "user_id")
    return _run(spark, cleaning.with_parent(stream, _parents(spark, sf), "user_id"), "st4")


@query("st4_orphans", f"SELECT event_id, user_id FROM events WHERE user_id NOT IN {_KNOWN_SQL}")
def st4_orphans(spark, sf):
    stream = _events(spark, sf).select("event_id", "user_id")
    return _run(spark, cleaning.without_parent(stream, _parents(spark, sf), "user_id"), "st4o")
