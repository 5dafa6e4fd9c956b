import datetime as dt
import os
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import bindings
from marquetry.operators import (
    aggregates,
    joins,
    ordering,
    positions,
    projections,
    quality,
    reshape,
    spines,
    windows,
)


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def facts(spark):
    """A third of the rows share one key and are equal; some have none."""
    rows = [("hot", 1)] * 40 + [(f"k{i % 20}", i) for i in range(60)] + [(None, i) for i in range(20)]
    return spark.createDataFrame(rows, "k string, v int").repartition(4)


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"n{i}") for i in range(10)], "k string, name string")


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffle"])
def broadcast_limit(spark, request):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_per_task", [1, 7, 1_000_000])
def test_salted_join_equals_plain_join(facts, dim, rows, how, rows_per_task, broadcast_limit):
    plain = facts.join(dim, "k", how)
    hot = joins.hot_keys(facts, [["k"]], rows_per_task)
    salted = joins.salted_join(facts, dim, ["k"], how, hot)
    assert rows(salted, *plain.columns) == rows(plain)
    assert rows(joins.salted_join(facts, dim, ["k"], how), *plain.columns) == rows(plain)


def test_a_hot_key_reaches_many_tasks(spark):
    """In a join that shuffles: a broadcast join leaves rows where they are."""
    equal = spark.range(0, 9000, 1, 16).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    known = spark.createDataFrame([("hot",)], "k string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.salted_join(equal, known, ["k"], "left_semi", joins.hot_keys(equal, [["k"]], 500))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sum(sizes) == 9000
    assert len(sizes) >= 4 and max(sizes) <= 4500


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from([None, 1, 1, 1, 2, 3]), st.integers(0, 2)), max_size=60),
    st.lists(st.tuples(st.sampled_from([None, 1, 2, 4]), st.integers(0, 2)), max_size=6),
    st.sampled_from(["inner", "left", "left_semi", "left_anti"]),
    st.integers(1, 9),
)
def test_salted_join_of_any_rows(spark, rows, left, right, how, rows_per_task):
    a = spark.createDataFrame(left, "k int, v int").repartition(3)
    b = spark.createDataFrame(right, "k int, w int")
    plain = a.join(b, "k", how)
    hot = joins.hot_keys(a, [["v"], ["k"]], rows_per_task)
    assert rows(joins.salted_join(a, b, ["k"], how, hot, key_set=1), *plain.columns) == rows(plain)


def test_hot_keys_of_several_joins_in_one_pass(spark, facts, monkeypatch):
    def parts(rows_per_task):
        return [r["parts"] for r in joins.hot_keys(facts, [["k"]], rows_per_task).collect()]

    assert parts(3) == [14]
    assert parts(1_000_000) == []
    monkeypatch.setattr(joins, "HOT_SHARE", 0.1)
    assert parts(1) == [4]  # 40 of 100 rows with a key, at least 10 to be hot
    df = spark.range(100).select((F.col("id") % 2).alias("a"), F.lit(7).alias("b"), F.lit(None).cast("int").alias("c"))
    found = joins.hot_keys(df, [["a"], ["b"], ["c"], ["a", "b"]], 10).groupBy("key_set").count().collect()
    assert {r["key_set"]: r["count"] for r in found} == {0: 2, 1: 1, 3: 2}
    plan = joins.hot_keys(spark.read.parquet(SF + "/orders.parquet"), [["o_custkey"], ["o_orderkey"]])
    assert len(re.findall("Scan parquet", plan._jdf.queryExecution().executedPlan().toString())) <= 2


def test_adaptive_execution_splits_a_key_with_half_of_all_rows(spark):
    """The plain join, which is what all callers get unless they ask for salting."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings if spark.conf.get(k, None) is not None}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for hot_side in ("left", "right"):
            wide = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.uuid().alias("v"))
            known = spark.range(0, 200_000, 3).select(F.col("id").alias("k"), F.lit("x").alias("w"))
            known = known.filter("k <> 7").union(spark.range(1).select(F.lit(7).cast("long"), F.lit("x")))
            left, right = (wide, known) if hot_side == "left" else (known, wide)
            joined = joins.match(left, right, ["k"])
            joined.collect()
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


@pytest.mark.parametrize("query, scans", [("j01_referential_integrity", 3), ("j02_orphans", 2), ("j05_left_alignment", 2), ("a19_quality_report", 3), ("entry_common_roles", 3)])
def test_joins_read_each_table_once(spark, query, scans):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = bindings.QUERIES[query](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(re.findall("FileScan parquet", plan)) == scans


def test_semi_and_anti_are_the_input(facts, dim, rows):
    kept = joins.keep_with_parents(facts, [(dim, "k")])
    gone = joins.orphans(facts, dim, "k", joins.hot_keys(facts, [["k"]], 5))
    assert rows(kept.unionByName(gone)) == rows(facts)
    report = dict(rows(joins.orphan_report(facts, [(dim, "k")])))
    assert report == {"none": kept.count(), "k": gone.count()}


def test_orphan_report_names_the_first_missing_parent(spark, rows):
    crew = spark.createDataFrame([(1, 1), (1, 9), (9, 9), (9, 1)], "a int, b int")
    one = spark.createDataFrame([(1,)], "x int")
    parents = [(one.toDF("a"), "a"), (one.toDF("b"), "b")]
    assert rows(joins.orphan_report(crew, parents)) == [("a", 2), ("b", 1), ("none", 1)]


def test_lookup_default_and_alignment(spark, facts, dim, rows):
    named = joins.lookup(facts.filter("v > 55 or k is null").limit(100), "k", dim, "k", {"name": "Outros"})
    assert {r["name"] for r in named.collect()} <= {f"n{i}" for i in range(10)} | {"Outros"}
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, one int")
    right = spark.createDataFrame([("b", 3), ("c", 4)], "k string, two int")
    assert rows(joins.align(left, right, ["k"])) == sorted(
        [("a", 1, None), ("b", 2, 3), ("c", None, 4)], key=repr
    )
    assert rows(joins.align_to(left, right, ["k"])) == sorted([("a", 1, None), ("b", 2, 3)], key=repr)
    assert rows(joins.match(left, right, ["k"])) == [("b", 2, 3)]
    assert rows(joins.absent_from(left, right, ["k"])) == [("a", 1)]


def numbered(values):
    """Positions by the order of Python, NULL first."""
    return {v: i for i, v in enumerate(sorted(values, key=lambda v: (v is not None, v)))}


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_positions(spark, partitions):
    data = [("a", s) for s in range(0, 40, 3)] + [(k, s) for k in ("b", None) for s in (5, -7, 9)]
    df = spark.createDataFrame(data, "k string, s int").repartition(5)
    placed = positions.with_position(df, ["k"], "s", partitions=partitions).collect()
    for key in ("a", "b", None):
        got = {r["s"]: r["pos"] for r in placed if r["k"] == key}
        assert got == numbered([s for k, s in data if k == key])


@pytest.mark.parametrize(
    "kind, values",
    [
        ("long", [i * 10**9 - 5 * 10**11 for i in range(900)]),
        ("long", [*range(900)]),
        ("string", [f"{i * 7919 % 900:05d}x" for i in range(900)]),
        ("timestamp", [dt.datetime(2000, 1, 1) + dt.timedelta(seconds=i * i) for i in range(900)]),
    ],
    ids=["sparse", "dense", "text", "timestamp"],
)
def test_positions_of_any_key_without_a_large_window(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in [None, *values]], f"s {kind}").repartition(4)
    placed = positions.with_position(df, [], "s", partitions=6)
    assert {r["s"]: r["pos"] for r in placed.collect()} == numbered([None, *values])
    ranges = positions.staged(df.repartitionByRange(6, "s").withColumn("r", F.spark_partition_id()), "r")
    assert ranges.select("r").distinct().count() <= 6


def test_a_missing_sequence_number_comes_first(spark, rows):
    df = spark.createDataFrame([("a", -5), ("a", None)], "k string, s int")
    assert rows(positions.with_position(df, ["k"], "s"), "s", "pos") == [(-5, 1), (None, 0)]


def test_numbering_reuses_the_shuffle_of_the_join(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, s int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = positions.with_position(df, ["k"], "s")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Exchange" not in plan[plan.index("Window [row_number") : plan.index("SortMergeJoin")]


def test_row_range_of_any_length_and_key(spark, rows):
    df = spark.range(30_000).select("id", F.concat(F.lit("n"), F.col("id") % 10).alias("name")).repartition(7)
    assert sorted(rows(projections.row_range(df.select("id"), "id", 30, 50))) == [(i,) for i in range(30, 50)]
    want = sorted((f"n{i % 10}", i) for i in range(30_000))
    for stop in (100, 20_000):
        assert rows(projections.row_range(df, "name", 10, stop), "name", "id") == sorted(want[10:stop], key=repr)
    assert rows(projections.row_range(df, "id", 5, 5)) == []


def test_keep_first_is_limited_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b"), (None, 1, "n"), (None, 2, "m")], "k int, o int, v string")
    first = windows.keep_first(df, ["k"], ["o"])
    assert rows(first, "k", "v") == sorted([(1, "a"), (2, "b"), (None, "n")], key=repr)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert rows(windows.keep_last(df, ["k"], "o"), "k", "v") == sorted([(1, "c"), (2, "b"), (None, "m")], key=repr)


def test_growth(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 15.0), ("a", 3, 0.0), ("a", 4, 5.0), ("b", 1, 4.0)], "g string, t int, v double")
    got = df.select("g", "t", windows.pct_change("v", "g", "t").alias("p")).collect()
    assert {(r["g"], r["t"]): r["p"] for r in got} == {
        ("a", 1): 0.0, ("a", 2): 50.0, ("a", 3): -100.0, ("a", 4): 0.0, ("b", 1): 0.0
    }


def test_ranks_and_extremes(spark, rows):
    df = spark.createDataFrame(
        [("MS", "CO", 13.0), ("GO", "CO", 7.0), ("MA", "NE", 13.0), ("PI", "NE", 7.0), ("XX", None, 99.0), ("YY", "NE", None)],
        "uf string, r string, s double",
    )
    assert windows.rank_of(df, "uf", "GO", "s").collect()[0]["position"] == 4
    assert aggregates.extreme_row(df.filter("uf <> 'XX'"), "s", "uf").collect()[0]["uf"] == "MA"
    assert aggregates.extreme_row(df, "s", "uf", largest=False).collect()[0]["uf"] == "GO"
    assert rows(windows.extreme_per_group(df, "r", "s", "uf"), "r", "uf") == [("CO", "MS"), ("NE", "MA")]
    assert rows(aggregates.group_mean(df, ["r"], "s")) == [("CO", 10.0), ("NE", 10.0)]
    best = rows(aggregates.extreme_groups(df, "r", "s"), "r", "which")
    assert best == [("CO", "highest"), ("CO", "lowest")]


def test_top_k_ties_and_nulls(spark, rows):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 9), (4, None)], "k int, v int")
    assert [r["k"] for r in ordering.top_k(df, "v", "k", 3).collect()] == [2, 1, 3]
    assert [r["k"] for r in ordering.top_k(df, "v", "k", 2, ascending=True).collect()] == [1, 3]
    plan = ordering.top_k(df, "v", "k", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    years = spark.createDataFrame([(y,) for y in (2001, 2001, 1999, 1999, 2000, None, None, None)], "ano int")
    assert [tuple(r) for r in ordering.most_common_by_label(years, "ano", 2).collect()] == [("1999", 2), ("2001", 2)]


def test_melt_and_split_are_inverse(spark, rows):
    wide = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "k string, x double, y double")
    long = reshape.melt(wide, ["k"], ["x", "y"], "label", "value")
    back = reshape.split_label(long, ["k"], "label", {"x": "x", "y": "y"}, F.col("value"))
    assert rows(back) == rows(wide)
    turned = reshape.transpose(wide, "k", ["a", "b"], "label")
    assert rows(turned, "label", "a", "b") == [("x", 1.0, 3.0), ("y", 2.0, 4.0)]


def test_transpose_of_repeated_missing_and_null_labels(spark, rows):
    wide = spark.createDataFrame([("a", 1.0), ("a", 5.0), (None, 2.0), ("other", 9.0)], "k string, x double")
    turned = reshape.transpose(wide, "k", ["a", None, "z"], "label")
    assert turned.columns == ["label", "a", "null", "z"]
    assert rows(turned) == [("x", 5.0, 2.0, None)]


def test_concat(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 1)], "s string, i int")
    assert rows(reshape.concat(a, b)) == [(1, "x"), (1, "y")]
    c = spark.createDataFrame([(2, True)], "i int, f boolean")
    assert rows(reshape.concat_loose(a, c)) == sorted([(1, "x", None), (2, None, True)], key=repr)


def test_projections(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "b")], "k int, v string")
    assert rows(projections.require_keys(df, "k", "v")) == [(1, "a")]
    assert rows(projections.equals_if(df, k=None, v="b")) == [(None, "b")]
    assert projections.reindex(df, {"v": "string", "z": "double"}).dtypes == [("v", "string"), ("z", "double")]
    rest, popped = projections.pop(df, "v")
    assert (rest.columns, popped.columns) == (["k"], ["v"])
    assert projections.trim_headers(df.toDF(" k ", "v  ")).columns == ["k", "v"]
    assert rows(projections.at_maximum(df, "k")) == [(2, None)]
    assert rows(projections.above_average(df, "k")) == [(2, None)]
    assert rows(projections.search(df, "v", "A|B", "k", 1)) == [(None, "b")]


def test_constraint_checks(spark, rows):
    df = spark.createDataFrame([(1, "receita", 5.0), (2, "x", 5.0), (3, None, 0.0), (3, "despesa", None)], "id int, t string, v double")
    rules = {**quality.not_null_rules(["t"]), "type known": F.col("t").isin("receita", "despesa"), "value positive": F.col("v") > 0}
    assert rows(quality.violations(df, "id", rules)) == [
        (2, "type known"), (3, "t not null"), (3, "type known"), (3, "value positive"), (3, "value positive")
    ]
    assert rows(quality.repeated_keys(df, "id")) == [(3, 2)]


def test_shares(spark, rows):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", 0.3)], "k string, v double")
    assert rows(aggregates.share_of_total(df, ["k"], "v")) == [("a", 0.3, 50.0), ("b", 0.3, 50.0)]
    assert rows(aggregates.share_of_total(df.limit(0), ["k"], "v")) == []
    profile = aggregates.profile(df).collect()[0]
    assert (profile["rows"], profile["cols"], profile["size"]) == (3, 2, 6)


def test_spines(spark, rows):
    assert spines.month_spine(spark, 1999, 2000).count() == 24
    assert rows(spines.trailing_months(spark, 2000, 2)) == [
        (1999, 10), (1999, 11), (1999, 12), (1999, 9), (2000, 1), (2000, 2)
    ]
    assert spines.day_spine(spark, "1996-02-01", "1996-02-29").count() == 29
