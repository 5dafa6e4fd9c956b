import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marquetry.plans import production
from marquetry.schemas import CREW_RAW, PERSON_RAW, SENSOR_RAW
from marquetry.sources.readers import read_jsonl_tolerant, stream_lines
from marquetry.streaming import telemetry
from marquetry.streaming.tallies import Tallies


def land(folder, n, seed):
    rng = random.Random(seed)
    lines = []
    for _ in range(40):
        key = rng.choice([None, "x", *range(12)])
        lines.append(json.dumps({"id_pessoa": key, "nome": rng.choice(["Ana", " Ana  B ", "", None])}))
    lines += ["", "{", "[]"][: rng.randrange(4)]
    (folder / f"{n}.jsonl").write_text("\n".join(lines) + "\n")


def people(spark, folder, root):
    lines = stream_lines(spark, str(folder), maxFilesPerTrigger=1)
    return Tallies(spark, str(root), PERSON_RAW, production.PEOPLE, 4), lines


def test_counters_while_the_stream_runs(spark, tmp_path, rows):
    landed = tmp_path / "raw"
    landed.mkdir()
    seen = []

    def counters(batch):
        """Called when a batch is in: the counters are those of the files so far."""
        known = Tallies(spark, str(tmp_path / "out"), PERSON_RAW, production.PEOPLE, 4)
        seen.append(production.quality_report(known.current(), "pessoa").first()["lidos"])

    for start in (0, 3):  # the second time the job is started again, over new files
        for n in range(start, start + 3):
            land(landed, n, n)
        kept, lines = people(spark, landed, tmp_path / "out")
        kept.start(lines, compact_every=2, after=counters).awaitTermination()
        whole = production.people_by_key(read_jsonl_tolerant(spark, str(landed), PERSON_RAW))
        assert rows(production.quality_report(kept.current(), "pessoa")) == rows(production.quality_report(whole, "pessoa"))
        assert rows(production.rejected_lines(kept.current())) == rows(production.rejected_lines(whole))
        assert rows(production.clean_rows(kept.current())) == rows(production.clean_rows(whole))
    assert seen == sorted(seen) and len(seen) == 6 and len(set(seen)) == 6
    assert kept.log.mark()[1] == 6


def test_a_batch_that_is_broken_off_counts_once(spark, tmp_path, rows):
    landed = tmp_path / "raw"
    landed.mkdir()
    for n in range(3):
        land(landed, n, n)

    def fail(batch):
        if batch == 1:
            raise RuntimeError("killed")

    kept, lines = people(spark, landed, tmp_path / "out")
    with pytest.raises(StreamingQueryException):
        kept.start(lines, after=fail).awaitTermination()
    kept, lines = people(spark, landed, tmp_path / "out")
    kept.start(lines).awaitTermination()
    whole = production.people_by_key(read_jsonl_tolerant(spark, str(landed), PERSON_RAW))
    assert rows(production.quality_report(kept.current(), "pessoa")) == rows(production.quality_report(whole, "pessoa"))


def test_crew_with_orphans(spark, tmp_path, rows):
    landed = tmp_path / "raw"
    landed.mkdir()
    rng = random.Random(8)
    for n in range(3):
        crew = [{"id_producao": rng.choice([None, 1, 2, 9]), "id_pessoa": rng.randrange(5), "papel": rng.choice(["A", " A", None])} for _ in range(30)]
        (landed / f"{n}.jsonl").write_text("\n".join(map(json.dumps, crew)) + "\n")
    persons = spark.range(3).withColumnRenamed("id", "id_pessoa")
    works = spark.range(3).withColumnRenamed("id", "id_producao")
    lines = stream_lines(spark, str(landed), maxFilesPerTrigger=1)
    kept = Tallies(spark, str(tmp_path / "out"), CREW_RAW, production.CREW, 4)
    kept.start(lines).awaitTermination()
    flagged = production.flag_orphans(kept.current(), persons, works)
    whole = production.crew_by_key(read_jsonl_tolerant(spark, str(landed), CREW_RAW), persons, works)
    assert rows(production.quality_report(flagged, "equipe")) == rows(production.quality_report(whole, "equipe"))
    assert production.quality_report(flagged, "equipe").first()["orfaos"] > 0


def readings(spark, folder, files=4):
    columns = [F.lit(i).cast("int").alias(f.name) for i, f in enumerate(SENSOR_RAW.fields)]
    for n in range(files):
        df = spark.range(n * 10, n * 10 + 10).select("id", *columns)
        bad = F.when(F.col("id") % 4 == 0, 999).otherwise(F.col("ax_h"))
        df.withColumn("ax_h", bad.cast("int")).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.read.parquet(str(folder)).schema


def test_a_killed_run_gives_each_reading_once_in_one_sink(spark, tmp_path, monkeypatch):
    schema, out = readings(spark, tmp_path / "landed"), str(tmp_path / "out")

    def start():
        stream = telemetry.sensor_stream(spark, str(tmp_path / "landed"), schema, maxFilesPerTrigger=1)
        decoded = telemetry.decode(stream)
        return telemetry.decode_to_sinks(decoded, out, str(tmp_path / "checkpoint")), decoded

    # The second batch dies between its two sinks.
    blocked = tmp_path / "out" / "readings" / "batch=1"
    real = spark.range(0).write.__class__.save

    def save(self, path=None, *args, **kwargs):
        if path == str(blocked) and not (tmp_path / "again").exists():
            raise RuntimeError("killed")
        return real(self, path, *args, **kwargs)

    monkeypatch.setattr(spark.range(0).write.__class__, "save", save)
    query, _ = start()
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    assert (tmp_path / "out" / "rejects" / "batch=1").exists() and not blocked.exists()
    (tmp_path / "again").touch()
    query, decoded = start()
    query.awaitTermination()
    ok = [r["id"] for r in telemetry.read_sink(spark, out, "readings", decoded.schema).collect()]
    bad = [(r["id"], r["reason"]) for r in telemetry.read_sink(spark, out, "rejects", decoded.schema).collect()]
    assert sorted(ok) == [i for i in range(40) if i % 4]
    assert sorted(bad) == [(i, "ax_h") for i in range(40) if i % 4 == 0]
    told = [p["observedMetrics"]["readings"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(m["ok"] + m["rejected"] for m in told) == 30  # the batches behind the first one
