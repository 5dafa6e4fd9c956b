import os
import random

import pytest
from pyspark.sql import functions as F

from marquetry.operators import changes
from marquetry.operators.buckets import BucketedTable
from marquetry.operators.snapshots import SnapshotLog
from marquetry.operators.windows import keep_last

FIELDS = "id string, value double"


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names}


@pytest.fixture
def held(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", float(i)) for i in range(200)], FIELDS)
    out = BucketedTable(spark, str(tmp_path / "t"), "id", rows.schema, 8)
    assert out.create(rows) == 1
    return out


def values(df):
    return {r["id"]: r["value"] for r in df.collect()}


def test_a_change_touches_its_buckets_alone(spark, held):
    before = files(held.root)
    assert held.change(spark.createDataFrame([("k7", None), ("new", 1.0)], FIELDS), lambda rows, new: changes.replace_rows(rows, new, "id", ["value"])) == 2
    assert values(held.read()) == {f"k{i}": float(i) for i in range(200)} | {"k7": None}
    after = files(held.root)
    assert {p: t for p, t in after.items() if p in before} == before
    buckets = {p.split("bucket=")[1].split("/")[0] for p in after if p not in before and "bucket=" in p and p.endswith(".parquet")}
    assert 1 <= len(buckets) <= 2
    assert values(held.read(1))["k7"] == 7.0


def test_changes_equal_those_of_a_whole_table(spark, held):
    rng, whole = random.Random(1), held.read()
    whole.write.parquet(f"{held.root}/../whole")
    whole = spark.read.parquet(f"{held.root}/../whole")
    for step in range(4):
        ids = [f"k{rng.randrange(220)}" for _ in range(9)]
        new = spark.createDataFrame([(i, float(step), n) for n, i in enumerate(ids)], f"{FIELDS}, seq int")
        apply = [
            lambda rows, ch: changes.replace_rows(rows, ch, "id", ["value"], seq="seq"),
            lambda rows, ch: changes.delete_rows(rows, ch, "id"),
            lambda rows, ch: changes.import_rows(rows, ch, "id", ["seq"]),
            lambda rows, ch: changes.patch_rows(rows, ch.withColumn("has_value", F.lit(True)), "id", ["value"], seq="seq"),
        ][step]
        held.change(new, apply)
        whole = apply(whole, new)
        assert values(held.read()) == values(whole)


def test_a_bucket_without_rows_is_empty(spark, held):
    held.change(held.read(), lambda rows, gone: changes.delete_rows(rows, gone, "id"))
    assert held.read().collect() == [] and held.get("k1").collect() == []
    held.change(spark.createDataFrame([("k1", 5.0)], FIELDS), lambda rows, new: changes.import_rows(rows, new, "id", ["value"]))
    assert values(held.read()) == {"k1": 5.0}


def test_what_was_broken_off_is_not_seen(spark, held):
    spark.createDataFrame([("k1", -1.0, 3)], f"{FIELDS}, bucket int").write.partitionBy("bucket").parquet(f"{held.root}/v=2")
    assert held.version() == 1 and values(held.read())["k1"] == 1.0
    held.change(spark.createDataFrame([("k1", 9.0)], FIELDS), lambda rows, new: changes.replace_rows(rows, new, "id", ["value"]))
    assert values(held.read()) == {f"k{i}": float(i) for i in range(200)} | {"k1": 9.0}


def test_no_change_makes_no_version(spark, held):
    assert held.change(spark.createDataFrame([], FIELDS), lambda rows, new: rows) == 1


def test_a_key_is_in_one_bucket(held):
    found = held.get("k12")
    assert values(found) == {"k12": 12.0}
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}) == 1


def test_old_versions_are_forgotten(spark, held):
    for i in (1, 2):
        held.change(spark.createDataFrame([(f"k{i}", -1.0)], FIELDS), lambda rows, new: changes.replace_rows(rows, new, "id", ["value"]))
    want = values(held.read())
    many = len(files(held.root))
    held.remove_before(3)
    assert values(held.read()) == want and len(files(held.root)) < many


def test_an_empty_table(spark, tmp_path):
    out = BucketedTable(spark, str(tmp_path / "t"), "id", spark.createDataFrame([], FIELDS).schema, 4)
    assert out.version() == 0 and out.read().collect() == []
    out.create(spark.createDataFrame([], FIELDS))
    assert out.read().collect() == [] and out.get("x").collect() == []


LOG = "key string, seq long, value string"


def test_snapshot_and_tail_equal_the_whole_log(spark, tmp_path):
    rng, every = random.Random(4), []
    log = SnapshotLog(spark, str(tmp_path / "log"), spark.createDataFrame([], LOG).schema, buckets=4)
    assert log.latest().collect() == [] and log.compact() == 0
    seqs = list(range(300))
    rng.shuffle(seqs)  # segments hold late writes
    for step in range(6):
        rows = [(f"k{rng.randrange(30)}" if rng.random() < 0.9 else None, s, f"v{s}") for s in seqs[step * 50 : step * 50 + 50]]
        every += rows
        log.append(spark.createDataFrame(rows, LOG))
        if step in (1, 2, 4):
            log.compact()
        want = sorted(map(tuple, keep_last(spark.createDataFrame(every, LOG), ["key"], "seq").collect()), key=repr)
        assert sorted(map(tuple, log.latest().collect()), key=repr) == want
        for key in ("k3", "k29", "absent"):
            assert [tuple(r) for r in log.get(key).collect()] == [r for r in want if r[0] == key]


def test_a_value_is_read_from_one_bucket_and_the_tail(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path / "log"), spark.createDataFrame([], LOG).schema, buckets=16)
    rows = spark.createDataFrame([(f"k{i}", i, "a") for i in range(400)], LOG)
    log.append(rows.filter("seq < 200"))
    log.append(rows.filter("seq >= 200"))
    log.compact()
    log.append(spark.createDataFrame([("k5", 1000, "b"), ("k6", 1, "late")], LOG))
    found = log.get("k5")
    assert [tuple(r) for r in found.collect()] == [("k5", 1000, "b")]
    assert len([f for f in found.inputFiles() if "/snapshot/" in f]) == 1
    scans = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert any("(segment#" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)
    assert [tuple(r) for r in log.get("k6").collect()] == [("k6", 6, "a")]


def test_a_repeated_segment_counts_once(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path / "log"), spark.createDataFrame([], LOG).schema)
    for _ in range(2):
        log.append(spark.createDataFrame([("a", 1, "x")], LOG), segment=1)
    assert log.last_segment() == 1 and log._log().count() == 1
