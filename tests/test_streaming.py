import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marquetry.schemas import AXES, SENSOR_RAW
from marquetry.streaming import cleaning, runner, telemetry

REGISTERS = [f"{a}_{h}" for a in AXES for h in ("h", "l")]


def reading(device, i, **bytes_):
    values = {r: 0 for r in REGISTERS} | bytes_
    return (device, dt.datetime(2024, 1, 1, 0, 0, i), *[values[r] for r in REGISTERS])


@pytest.fixture
def landed(spark, tmp_path):
    rows = [
        reading("ok", 0, ax_h=64, ay_h=192, gx_h=0, gx_l=131, gz_h=255, gz_l=255),
        reading("null", 1, ax_l=None),
        reading("range", 2, gz_h=256),
        reading("negative", 3, gy_l=-1),
        reading("edge", 4, ax_h=127, ax_l=255, ay_h=128),
    ]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, SENSOR_RAW).write.parquet(path)
    return path


def test_stream_equals_batch(spark, landed, tmp_path, rows):
    batch = telemetry.decode(spark.read.schema(SENSOR_RAW).parquet(landed))
    stream = telemetry.decode(telemetry.sensor_stream(spark, landed))
    got = runner.run_available(spark, stream, str(tmp_path / "out"), ["status"])
    assert rows(got, *batch.columns) == rows(batch)
    found = {r["device"]: r for r in batch.collect()}
    assert [found["ok"][a] for a in AXES] == [1.0, -1.0, 0.0, 1.0, 0.0, -0.01]
    assert (found["edge"]["ax"], found["edge"]["ay"]) == (2.0, -2.0)
    assert {d: r["reason"] for d, r in found.items() if r["status"] == "rejected"} == {
        "null": "ax_l", "range": "gz_h", "negative": "gy_l"
    }
    assert found["null"]["ay"] is None


def test_a_bad_reading_does_not_stop_the_stream(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    running = telemetry.decode_to_files(spark, landed, out, str(tmp_path / "cp"))
    running.processAllAvailable()
    late = [reading("late", 9, gz_l=None), reading("fine", 10)]
    spark.createDataFrame(late, SENSOR_RAW).write.mode("append").parquet(landed)
    running.processAllAvailable()
    assert running.isActive and running.exception() is None
    running.stop()
    got = {r["device"]: r["status"] for r in spark.read.parquet(out).collect()}
    assert len(got) == 7
    assert (got["late"], got["fine"], got["null"], got["ok"]) == ("rejected", "ok", "rejected", "ok")


def test_json_readings_on_a_running_stream(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    fields = {r: 0 for r in REGISTERS} | {"device": "d", "ts": "2024-01-01T00:00:00Z", "ax_h": 64}
    (tmp_path / "in" / "a.txt").write_text(json.dumps(fields) + "\nnoise\n")
    lines = spark.readStream.text(str(tmp_path / "in"))
    decoded = telemetry.decode(telemetry.readings_from_json(lines))
    running = runner.to_files(decoded, str(tmp_path / "out"), str(tmp_path / "cp"), every="1 second")
    running.processAllAvailable()
    (tmp_path / "in" / "b.txt").write_text(json.dumps(fields | {"device": "e"}) + "\n")
    running.processAllAvailable()
    running.stop()
    got = spark.read.schema(decoded.schema).parquet(str(tmp_path / "out"))
    assert rows(got, "device", "ax", "status") == sorted(
        [("d", 1.0, "ok"), ("e", 1.0, "ok"), (None, None, "rejected")], key=repr
    )


def feed(spark, path, rows):
    spark.createDataFrame(rows, "k string, v string, ts timestamp").write.mode("append").parquet(path)


def read_stream(spark, path):
    return spark.readStream.schema("k string, v string, ts timestamp").parquet(path)


T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("bounded", [False, True])
def test_seen_keys_stay_seen_across_runs(spark, tmp_path, rows, bounded):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    options = {"event_time": "ts", "delay": "1 day"} if bounded else {}

    def run():
        cleaned = cleaning.clean_stream(read_stream(spark, source), ["k", "v"], ["v"], **options)
        return runner.run_available(spark, cleaned, base)

    feed(spark, source, [("a", " x ", T0), ("a", "x", T0), (None, "x", T0), ("a", "  ", T0)] + [("hot", "y", T0)] * 50)
    assert sorted(rows(run(), "k", "v"), key=repr) == sorted([("a", "x"), ("a", None), ("hot", "y")], key=repr)
    feed(spark, source, [("a", "x  ", T0 + dt.timedelta(hours=1)), ("b", "z", T0)])
    assert len(rows(run(), "k", "v")) == 4


def test_watermark_forgets_old_keys(spark, tmp_path, rows):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        cleaned = cleaning.drop_seen(read_stream(spark, source), ["k"], "ts", "1 hour")
        return runner.run_available(spark, cleaned, base)

    feed(spark, source, [("a", "1", T0)])
    run()
    feed(spark, source, [("b", "2", T0 + dt.timedelta(days=2))])
    run()
    feed(spark, source, [("a", "3", T0 + dt.timedelta(days=2))])
    assert rows(run(), "k", "v") == [("a", "1"), ("a", "3"), ("b", "2")]


def test_a_parent_is_read_once_for_all_batches(spark, tmp_path, rows):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a",)], "k string").write.parquet(str(tmp_path / "parent"))
    parent = spark.read.parquet(str(tmp_path / "parent"))
    feed(spark, source, [("a", "1", T0), ("b", "2", T0)])
    kept = cleaning.with_parent(read_stream(spark, source), parent, "k")
    for part in (tmp_path / "parent").glob("*.parquet"):
        part.unlink()  # what the batches read is the copy made before the stream began
    assert rows(runner.run_available(spark, kept, base), "k", "v") == [("a", "1")]
    feed(spark, source, [("a", "3", T0)])
    assert rows(runner.run_available(spark, kept, base), "k", "v") == [("a", "1"), ("a", "3")]


def test_static_parents(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    feed(spark, source, [("a", "1", T0), ("b", "2", T0), (None, "3", T0)] + [("hot", "4", T0)] * 9)
    parent = spark.createDataFrame([("a",), ("hot",), ("a",)], "k string")
    kept = cleaning.with_parent(read_stream(spark, source), parent, "k")
    gone = cleaning.without_parent(read_stream(spark, source), parent, "k")
    kept = runner.run_available(spark, kept, str(tmp_path / "kept"))
    gone = runner.run_available(spark, gone, str(tmp_path / "gone"))
    assert rows(kept, "k", "v") == [("a", "1")] + [("hot", "4")] * 9
    assert rows(gone, "k", "v") == sorted([("b", "2"), (None, "3")], key=repr)
    assert kept.select(F.count(F.lit(1))).collect()[0][0] == 10
