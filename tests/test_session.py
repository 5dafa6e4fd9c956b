from types import SimpleNamespace

import pytest

from marquetry.session import scratch_path, staged


def fake(master, checkpoint):
    conf = SimpleNamespace(get=lambda name, default: checkpoint)
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_uses_the_shared_folder():
    one = scratch_path(fake("spark://host:7077", "s3a://shared/"), "x")
    assert one.startswith("s3a://shared/marquetry/app-1/x-")
    assert one != scratch_path(fake("spark://host:7077", "s3a://shared/"), "x")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        scratch_path(fake("yarn", None), "x")


def test_staged_frames_keep_their_rows(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "b")], "i int, s string")
    again = staged(df, "t")
    assert again.schema == df.schema and rows(again) == rows(df)
    assert "Scan parquet" in again._jdf.queryExecution().executedPlan().toString()
