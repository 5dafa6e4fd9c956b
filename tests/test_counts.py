import random

from pyspark.sql import functions as F

from marquetry.sources import counts


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_footers_are_counted_without_a_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("part", F.col("id") % 3).repartition(4).write.partitionBy("part").parquet(path)
    one = counts.footer_count(spark, path)
    plan = executed(one)
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert "id" not in plan.split("BatchScan")[1].split("[")[1].split("]")[0]
    assert one.first()["n"] == 1000
    groups = counts.footer_count(spark, path, by="part")
    assert "PushedGroupBy: [part]" in executed(groups)
    assert {r["part"]: r["n"] for r in groups.collect()} == {0: 334, 1: 333, 2: 333}
    # The caller's own session is as it was.
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def lines_of(rng, n, longest):
    return "".join("x" * rng.randrange(1, longest) + "\n" for _ in range(n))


def test_all_files_read_give_the_exact_count(spark, tmp_path):
    for name, text in (("a b.jsonl", "{}\n\n  \n{}\n"), ("b.jsonl", "{}"), ("c.jsonl", "")):
        (tmp_path / name).write_text(text)
    row = counts.estimated_lines(spark, str(tmp_path)).first()
    assert (row["estimate"], row["low"], row["high"], row["files_read"], row["files"]) == (3, 3, 3, 2, 2)


def test_no_files(spark, tmp_path):
    (tmp_path / "empty.jsonl").write_text("")
    assert tuple(counts.estimated_lines(spark, str(tmp_path)).first()) == (0, 0, 0, 0, 0, 0)


def test_a_sample_of_files_bounds_the_count(spark, tmp_path):
    rng, total = random.Random(3), 0
    for i in range(60):
        n = rng.randrange(20, 60)
        total += n
        (tmp_path / f"{i}.jsonl").write_text(lines_of(rng, n, rng.choice([20, 30, 40])))
    for seed in range(3):
        row = counts.estimated_lines(spark, str(tmp_path), files=15, seed=seed).first()
        assert row["low"] <= total <= row["high"] and row["high"] - row["low"] < total
        assert (row["files_read"], row["files"]) == (15, 60)
    # The same seed gives the same answer.
    again = counts.estimated_lines(spark, str(tmp_path), files=15, seed=2).first()
    assert again == row


def test_bounds_hold_as_often_as_they_should():
    """Estimates from many samples of files with very different lines."""
    rng = random.Random(5)
    files = [(b, max(1, round(b / rng.uniform(50, 150)))) for b in (rng.randrange(2000, 90_000) for _ in range(300))]
    size, total = sum(b for b, _ in files), sum(n for _, n in files)
    held = {1.0: 0, 2.0: 0, 4.0: 0}
    for _ in range(400):
        sample = rng.sample(files, 30)
        for errors in held:
            _, low, high = counts._ratio_estimate(sample, len(files), size, errors)
            held[errors] += low <= total <= high
    assert 0.6 < held[1.0] / 400 < 0.75 and held[2.0] / 400 > 0.92 and held[4.0] / 400 > 0.995


def test_one_file_of_many_bounds_little():
    assert counts._ratio_estimate([(100, 10)], 3, 1000, 4.0) == (100, 10, 910)
