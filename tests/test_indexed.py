import random

import pytest
from pyspark.sql import functions as F

from marquetry.functions.numbers import money
from marquetry.functions.text import contains_any, matches
from marquetry.operators import bitmaps, changes, heavy, joins
from marquetry.operators.buckets import BucketedTable
from marquetry.operators.trigrams import TrigramIndex
from marquetry.plans import ledger_sums

EDGES = [0, 1, -1, 63, 64, 65, 7, 8, 32767, 32768, 32769, -32767, -32768, -32769, 2**40, -(2**40), 2**62]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most_bytes", [bitmaps.MOST_BYTES, 0], ids=["bitmaps", "joins"])
def test_ids_of_any_sign_and_distance(spark, most_bytes):
    rng = random.Random(2)
    asked = EDGES + [rng.randrange(-70000, 70000) for _ in range(800)]
    present = [i for i in asked if rng.random() < 0.5]
    facts = spark.createDataFrame([(n, i) for n, i in enumerate([*asked, None, *asked])], "n long, k long")
    parent = spark.createDataFrame([(i,) for i in [*present, None, *present[:9]]], "k long")
    known = {r["n"] for r in bitmaps.keep_with_parents(facts, [(parent, "k")], most_bytes).collect()}
    want = {n for n, i in enumerate([*asked, None, *asked]) if i in set(present) and i is not None}
    assert known == want
    lost = {r["n"] for r in bitmaps.orphans(facts, parent, "k", most_bytes).collect()}
    assert lost == set(range(2 * len(asked) + 1)) - want
    report = {r["missing"]: r["rows"] for r in bitmaps.orphan_report(facts, [(parent, "k")], most_bytes).collect()}
    assert report == {"none": len(want), "k": 2 * len(asked) + 1 - len(want)}


def test_facts_are_not_shuffled(spark):
    facts = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    parent = spark.createDataFrame([(0,), (2,)], "k int")
    found = bitmaps.keep_with_parents(facts, [(parent, "k")])
    assert found.count() == 667 and found.columns == facts.columns
    fact_side = plan_of(found).split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in fact_side and "Exchange hashpartitioning" not in fact_side


def test_keys_that_are_texts_are_joined(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    parent = spark.createDataFrame([("a",)], "k string")
    assert not bitmaps.fits(parent, "k")
    assert [r["n"] for r in bitmaps.keep_with_parents(facts, [(parent, "k")]).collect()] == [1]
    assert sorted(r["n"] for r in bitmaps.orphans(facts, parent, "k").collect()) == [2, 3]


def test_no_parents_at_all(spark):
    facts = spark.createDataFrame([(1,)], "k long")
    parent = spark.createDataFrame([], "k long")
    assert bitmaps.keep_with_parents(facts, [(parent, "k")]).collect() == []
    assert bitmaps.orphans(facts, parent, "k").count() == 1


def plain(df, keys, k, amount=None):
    total = F.count(F.lit(1)) if amount is None else F.sum(F.coalesce(amount, F.lit(0)))
    return [tuple(r) for r in df.groupBy(*keys).agg(total.alias("total")).orderBy(F.desc("total"), *keys).limit(k).collect()]


def zipf(spark, rows=20000):
    rng = random.Random(5)
    return spark.createDataFrame([(int(rng.paretovariate(0.7)) % 3000, f"t{i % 3}", rng.randrange(9)) for i in range(rows)], "k int, t string, w int")


def test_uneven_keys_are_found_by_candidates(spark):
    df = zipf(spark)
    chosen, bound = heavy.candidates(df, ["k"], 5, F.lit(1).cast("long"))
    assert chosen.count() < df.count()
    found = [tuple(r) for r in heavy.heaviest(df, ["k"], 5).collect()]
    assert found == plain(df, ["k"], 5) and found[-1][1] > bound


@pytest.mark.parametrize("keys, k, buckets", [(["k"], 20, 2048), (["k", "t"], 3, 256), (["t"], 5, 4096), (["k"], 600, 4096)])
def test_equal_to_counting_all(spark, keys, k, buckets):
    df = zipf(spark).unionByName(spark.createDataFrame([(None, None, None)] * 50, "k int, t string, w int"))
    assert [tuple(r) for r in heavy.heaviest(df, keys, k, buckets=buckets).collect()] == plain(df, keys, k)
    weight = money(F.col("w"))
    got = heavy.heaviest(df, keys, k, weight, buckets=buckets).collect()
    assert [tuple(r) for r in got] == plain(df, keys, k, weight)


def test_keys_of_like_frequency_and_ties(spark):
    flat = spark.range(6000).select((F.col("id") % 2000).alias("k"))
    assert [tuple(r) for r in heavy.heaviest(flat, ["k"], 4, buckets=256).collect()] == plain(flat, ["k"], 4)
    few = spark.range(6).select((F.col("id") % 3).alias("k"))
    assert [tuple(r) for r in heavy.heaviest(few, ["k"], 5).collect()] == [(0, 2), (1, 2), (2, 2)]
    assert heavy.heaviest(flat.filter("k < 0"), ["k"], 5).collect() == []


def test_negative_and_zero_weights(spark):
    df = zipf(spark, 4000).withColumn("w", F.when(F.col("k") > 40, 0).otherwise(F.col("w") - 4))
    assert [tuple(r) for r in heavy.heaviest(df, ["k"], 30, F.col("w"), buckets=2048).collect()] == plain(df, ["k"], 30, F.col("w"))
    zero = df.withColumn("w", F.lit(0))
    assert [tuple(r) for r in heavy.heaviest(zero, ["k"], 8, F.col("w"), buckets=512).collect()] == plain(zero, ["k"], 8, F.col("w"))


TEXTS = [
    "Aluguel de abril", "ALUGUEL", "aluguéis", "Padaria São João", "são", "", None, "ab", "abc", "abcabcabc", "xxabcx", "STRASSE straße",
    "İstanbul", "Kelvin kelvin", "ſtern stern", "100% a.b.c", "a b c d", "abXbc", "ΣΑΣ abc",
]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = spark.createDataFrame([(i, t, TEXTS[(i * 7 + 3) % len(TEXTS)]) for i, t in enumerate(TEXTS)], "id int, a string, b string")
    return TrigramIndex(rows, str(tmp_path_factory.mktemp("grams")), "id", ["a", "b"], 8)


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("term", ["", "ab", "abc", "ABCABC", "aluguel", "uguéi", "são", "SÃO JOÃO", "strasse", "straße", "kelvin", "stan", "ΣΑΣ", "a.b", "100%", "none here"])
def test_search_equals_a_scan(index, term):
    rows = index.table.read()
    assert ids(index.containing(term)) == ids(rows.filter(contains_any(term, F.col("a"), F.col("b"))))


@pytest.mark.parametrize("pattern", ["abc", "KELVIN", "stern", "istan", "ab", "a.*c", "a b c", "ALUGU(el|éis)"])
def test_patterns_equal_a_scan(index, pattern):
    rows, hit = index.table.read(), F.lit(False)
    for c in ("a", "b"):
        hit = hit | F.coalesce(matches(F.col(c), pattern), F.lit(False))
    assert ids(index.matching(pattern)) == ids(rows.filter(hit))


def test_a_search_reads_its_trigrams_buckets(index):
    read = {f.split("bucket=")[1].split("/")[0] for f in index.grams.of_keys(["abc"]).inputFiles()}
    every = {f.split("bucket=")[1].split("/")[0] for f in index.grams.read().inputFiles()}
    assert len(read) == 1 and len(every) > 1


LEDGER = "id long, date date, type string, category string, value double"


def entries(spark, rng, wanted):
    days = [f"2024-0{rng.randrange(1, 4)}-1{rng.randrange(10)}" for _ in wanted]
    rows = [
        (i, rng.choice([d, None]) if i % 11 == 0 else d, rng.choice(["receita", "despesa"]), rng.choice(["A", "B", None]), rng.choice([0.1, 0.004, -3.0, 1e6 / 3, None]))
        for i, d in zip(wanted, days)
    ]
    return spark.createDataFrame(rows, "id long, date string, type string, category string, value double").withColumn("date", F.col("date").cast("date"))


def sums(df):
    return sorted((tuple(r) for r in df.select("date", "type", "category", "total", "rows").collect()), key=repr)


def test_sums_follow_random_changes(spark, tmp_path):
    rng = random.Random(8)
    held = BucketedTable(spark, str(tmp_path / "ledger"), "id", spark.createDataFrame([], LEDGER).schema, 4)
    kept = ledger_sums.LedgerSums(spark, str(tmp_path / "sums"), held, 4)
    assert kept.refresh() == 0 and kept.sums.read().collect() == []
    held.create(entries(spark, rng, range(60)).select("id", "date", "type", "category", "value"))
    for step in range(4):
        some = entries(spark, rng, rng.sample(range(80), 7))
        apply = [
            lambda rows, new: changes.replace_rows(rows, new, "id", ["date", "type", "category", "value"]),
            lambda rows, new: changes.import_rows(rows, new, "id", ["value"]),
            lambda rows, new: changes.delete_rows(rows, new, "id"),
        ][step % 3]
        held.change(some, apply)
        if step != 1:  # two changes at once are taken in as well
            assert kept.refresh() == held.version() == kept.stands_for()
            assert sums(kept.sums.read()) == sums(ledger_sums.sums_of(held.read()))
    held.change(held.read(), lambda rows, gone: changes.delete_rows(rows, gone, "id"))
    kept.refresh()
    assert kept.sums.read().collect() == []


def test_a_refresh_that_was_broken_off_counts_once(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    held = BucketedTable(spark, str(tmp_path / "ledger"), "id", spark.createDataFrame([], LEDGER).schema, 4)
    held.create(entries(spark, rng, range(20)))
    kept = ledger_sums.LedgerSums(spark, str(tmp_path / "sums"), held, 4)
    kept.refresh()
    held.change(entries(spark, rng, range(15, 25)), lambda rows, new: changes.import_rows(rows, new, "id", ["value"]))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(kept.sums, "_commit", broken)
        with pytest.raises(RuntimeError):
            kept.refresh()
    assert kept.stands_for() == 1
    kept.refresh()
    kept.refresh()
    assert kept.stands_for() == 2 and sums(kept.sums.read()) == sums(ledger_sums.sums_of(held.read()))


def test_a_refresh_reads_changed_buckets_alone(spark, tmp_path):
    held = BucketedTable(spark, str(tmp_path / "ledger"), "id", spark.createDataFrame([], LEDGER).schema, 8)
    held.create(entries(spark, random.Random(1), range(100)))
    held.change(spark.createDataFrame([(5,)], "id long"), lambda rows, gone: changes.delete_rows(rows, gone, "id"))
    before, after = held.changed(1, 2)
    assert {f.split("bucket=")[1].split("/")[0] for f in before.inputFiles()} == {f.split("bucket=")[1].split("/")[0] for f in after.inputFiles()}
    assert before.count() == after.count() + 1 < 50


def test_joins_and_bitmaps_agree_on_reports(spark):
    facts = spark.createDataFrame([(1, 10), (2, 10), (3, 99), (None, 10)], "a long, b long")
    parents = [(spark.createDataFrame([(1,), (3,)], "a long"), "a"), (spark.createDataFrame([(10,)], "b long"), "b")]
    got, want = (sorted(map(tuple, f(facts, parents).collect())) for f in (bitmaps.orphan_report, joins.orphan_report))
    assert got == want == [("a", 2), ("b", 1), ("none", 1)]
