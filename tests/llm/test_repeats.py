import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquetry.llm import repeats


def brute(texts, length):
    """Bytes that remain and runs removed, by counting all strings."""
    counts = {}
    data = [(t or "").encode() for t in texts]
    for d in data:
        for i in range(len(d) - length + 1):
            counts[d[i : i + length]] = counts.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(d) else 0
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, texts, length=80, **options):
    got = repeats.remove_repeats(docs, length=length, **options).collect()
    want = sorted(zip([i for i, _ in texts], brute([t for _, t in texts], length)), key=repr)
    assert sorted(((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got), key=repr) == want


def passages(prose, n):
    shared = [prose(i, 30) for i in range(4)]
    rng = random.Random(3)
    texts = []
    for i in range(n):
        parts = [prose(100 + i, rng.randrange(0, 40)), rng.choice(shared), prose(200 + i, rng.randrange(0, 20))]
        if i % 3 == 0:
            parts.append(rng.choice(shared)[: rng.randrange(60, 160)])
        texts.append((i, " ".join(parts)))
    return texts + [(1000 + i, texts[0][1]) for i in range(3)]


@pytest.mark.parametrize("crowded, index_bytes", [(256, 4 << 20), (1, 4 << 20), (256, 2000)], ids=["index", "counted", "many indexes"])
def test_against_brute_force(documents, prose, crowded, index_bytes):
    texts = passages(prose, 25)
    check(documents(texts), texts, crowded=crowded, index_bytes=index_bytes)


def test_repeats_within_a_text_and_of_one_byte(documents):
    texts = [(1, "a" * 300), (2, "xyz" * 90), (3, "b" * 79), (4, "q" * 50 + "a" * 90), (5, "é" * 60)]
    check(documents(texts), texts)


def test_a_hot_passage_in_different_surroundings(documents, prose):
    hot = prose(7, 40)
    texts = [(i, f"{i:08d}" * 9 + hot + f"{i * 7:07d}" * 9) for i in range(3000)]
    check(documents(texts), texts, length=100)


def test_a_hot_passage_is_counted_in_blocks(documents, prose, monkeypatch):
    """Its strings aren't a row for each start in each of its surroundings."""
    made, staged = [], repeats.staged

    def counting(df, name, *more):
        out = staged(df, name, *more)
        if name in ("bytes", "blocks"):
            made.append((name, out.count(), out))
        return out

    hot = prose(7, 90)[:450]
    texts = [(i, prose(900 + i, 60, 3000) + hot + prose(5000 + i, 60, 3000)) for i in range(300)]
    monkeypatch.setattr(repeats, "staged", counting)
    check(documents(texts), texts, length=400, crowded=16)
    starts = sum(len(r["bytes"]) - 399 for name, _, df in made if name == "bytes" for r in df.filter("kinds > 16").collect())
    rows = [n for name, n, _ in made if name == "blocks"]
    assert len(rows) > 1 and starts > 20_000 and max(rows) < starts / 10 and sum(rows) < starts / 4


def test_the_join_of_a_hot_anchor_is_split(spark, documents, prose, monkeypatch):
    """Rows that share the anchors of a common passage don't meet in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "24",
    }
    before = {k: spark.conf.get(k) for k in settings if spark.conf.get(k, None) is not None}
    plans, staged = {}, repeats.staged

    def seen(df, name, *more):
        if name == "repeated":
            df.collect()
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name, *more)

    hot = prose(7, 40)
    texts = [(i, hashlib.sha512(b"%d" % i).hexdigest() + hot + hashlib.sha512(b"-%d" % i).hexdigest()) for i in range(3000)]
    monkeypatch.setattr(repeats, "staged", seen)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        check(documents(texts), texts, length=100)
    finally:
        for k in settings:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)
    assert "skew=true" in plans["repeated"]


def test_no_table_is_left_in_the_catalogue(spark, documents, prose):
    before = {t.name for t in spark.catalog.listTables()}
    texts = passages(prose, 5)
    check(documents(texts), texts)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_messy_rows(messy, prose):
    rows = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    check(messy, rows, length=400)


def test_empty_table(documents):
    assert repeats.remove_repeats(documents([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=40), min_size=1, max_size=6), st.integers(1, 8))
def test_statistics_of_the_run_length_index(contexts, length):
    data = [c.encode() for c in contexts if len(c) >= length]
    if not data:
        return
    starts = [d[i : i + length] for d in data for i in range(len(d) - length + 1)]
    want = [[i for i in range(len(d) - length + 1) if starts.count(d[i : i + length]) > 1] for d in data]
    assert [f.tolist() for f in repeats.repeated_starts(data, length)] == want


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=12, max_size=200))
def test_equal_strings_have_equal_anchors(data):
    double = np.frombuffer(data + b"--" + data, dtype=np.uint8)
    anchor_of = {}
    for hashes, first, last, place in repeats.anchors(double, length=10, width=4):
        for h, a, b, p in zip(hashes, first, last, place):
            anchor_of |= {s: (int(h), int(p) - s) for s in range(a, b + 1)}
    assert sorted(anchor_of) == list(range(len(double) - 9))
    for s in range(len(data) - 9):
        assert anchor_of[s] == anchor_of[s + len(data) + 2]
