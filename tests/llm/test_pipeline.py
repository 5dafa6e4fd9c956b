import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from marquetry import session
from marquetry.llm import leaks, queries, simhash
from tools.check_queries import duck

SMALL = "/root/testdata/sf0.001"
NAMES = [f"op{n}" for n in range(1, 14)]


def test_every_numbered_operator_is_registered():
    found = [re.match(r"op\d+", n)[0] for n in contract.queries() if n.startswith("op") and re.match(r"op\d+_", n)]
    assert sorted(found) == sorted(NAMES)
    assert "pipeline" in contract.queries()
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    relation = duck(SMALL).sql(queries.SQL[name])
    at = [relation.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=repr)


def test_the_native_operator_runs_no_python(spark):
    plan = queries.QUERIES["op1_merkle_fingerprints"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and returned."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.staged(stage(spark, docs, SMALL), name)
        out[name] = docs, kept
        docs = kept
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for before, after in list(stages.values())[:-1]:
        assert after.columns == before.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]


def line_tokens(line):
    """Runs of five words; of a shorter line the whole word sequence."""
    words = line.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_line_stage_against_brute_force(stages):
    before, after = map(texts, stages["line_dedup"])
    earlier, want = [], {}
    for i in sorted(before):
        kept = []
        for line in before[i].split("\n"):
            own = line_tokens(line)
            if not any(len(own & o) >= 0.8 * len(own | o) - 1e-9 for o in earlier if own):
                kept.append(line)
            if own:
                earlier.append(own)
        want[i] = "\n".join(kept)
    assert after == want
    sizes = {r["doc_id"]: r["n_chars"] for r in stages["line_dedup"][1].collect()}
    assert sizes == {i: len(t) for i, t in want.items()}


def test_near_copy_stage_against_brute_force(stages):
    before, after = map(texts, stages["simhash_near_dedup"])
    prints = {i: simhash.fingerprint(t) for i, t in before.items()}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(after) == {find(i) for i in prints}


def test_leak_stage_against_brute_force(spark, stages):
    before, after = map(texts, stages["benchmark_decontamination"])
    items = [b" ".join(leaks.words_of(r["text"])) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    verbatim = {i for i, t in before.items() if any(x in b" ".join(leaks.words_of(t)) for x in items)}
    assert verbatim <= set(before) - set(after)
    assert len(set(before) - set(after)) <= len(verbatim) + 1


def test_packing_stage_holds_every_document(stages):
    before, after = stages["best_fit_packing"]
    held = {}
    for r in after.collect():
        held.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    assert set(held) == set(texts(before))
    for pieces in held.values():
        pieces.sort()
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
        assert [s for _, s, _ in pieces] == np.cumsum([0, *(n for _, _, n in pieces[:-1])]).tolist()


def test_run_is_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, SMALL).count() == stages["best_fit_packing"][1].count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SMALL), name)
        assert docs.count() == 0


def test_stages_send_whole_texts_in_small_batches(spark):
    """Each stage by itself, as each can be run alone; by default 10,000 rows go to Python at once, whatever their length."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    before = spark.conf.get(session.BATCH_BYTES, None)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(session.BATCH_BYTES)
            stage(spark, docs, SMALL)
            texts = spark.range(0, 1500, 1, 1).select(F.repeat(F.lit("x"), 20_000))
            found = texts.mapInArrow(sizes, "bytes long, rows long").collect()
            assert sum(r["rows"] for r in found) == 1500
            assert max(r["bytes"] for r in found) < 1.5 * corpus_pipeline.BATCH
    finally:
        spark.conf.unset(session.BATCH_BYTES) if before is None else spark.conf.set(session.BATCH_BYTES, before)


def test_a_session_keeps_its_own_size_of_batches(spark):
    before = spark.conf.get(session.BATCH_BYTES, None)
    try:
        spark.conf.set(session.BATCH_BYTES, "1000000")
        session.bounded_batches(spark, corpus_pipeline.BATCH)
        assert spark.conf.get(session.BATCH_BYTES) == "1000000"
    finally:
        spark.conf.unset(session.BATCH_BYTES) if before is None else spark.conf.set(session.BATCH_BYTES, before)
