import random

import pytest
import xxhash

from marquetry.llm import simhash
from marquetry.llm.components import components


def plain(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if len(words) >= width else [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values):
    """The smallest value reachable over links of at most two bits, for each of ``values``."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def test_fingerprints(prose):
    for text in [None, "", "  ", "One", "one TWO", "a b c", "É b c d", prose(1, 700), prose(2, 70_000)]:
        assert simhash.fingerprint(text) == plain(text)


@pytest.mark.parametrize("crowded", [0, 2, 1000])
def test_links_have_the_components_of_all_pairs(spark, crowded):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(8):
            flipped = centre
            for bit in rng.sample(range(64), rng.randrange(0, 5)):
                flipped ^= 1 << bit
            values.add(flipped)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), crowded).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges)
    joined = groups_of_edges(values, [(a % (1 << 64), b % (1 << 64)) for a, b in edges])
    want = groups(sorted(values))
    assert {frozenset(v for v in want if want[v] == r) for r in want.values()} == joined


def groups_of_edges(values, edges):
    near = {v: {v} for v in values}
    for a, b in edges:
        merged = near[a] | near[b]
        for v in merged:
            near[v] = merged
    return {frozenset(s) for s in near.values()}


def test_near_duplicates(documents, prose):
    text = prose(4, 900)
    changed = text.replace(" ", " x ", 1)
    rows = [(9, text), (2, changed), (5, prose(6, 100)), (7, None), (3, ""), (8, text.upper())]
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(documents(rows)).collect()}
    assert {i: f for i, (f, _) in got.items()} == {i: plain(t) for i, t in rows}
    want = groups([plain(t) for _, t in rows])
    for i, t in rows:
        same = [j for j, u in rows if want[plain(u)] == want[plain(t)]]
        assert got[i][1] == min(same)
    kept = {r["doc_id"] for r in simhash.keep_first_of_each(documents(rows)).collect()}
    assert kept == {c for _, c in got.values()}


def test_messy_rows(messy):
    got = simhash.near_duplicates(messy).collect()
    assert len(got) == 10
    of = {(r["doc_id"], r["fp"] == 0): r["component_id"] for r in got}
    assert of[2, True] == of[3, True] == of[4, True] == of[None, True] == 2
    assert of[1, False] == of[7, False] == of[None, False] == 1
    kept = simhash.keep_first_of_each(messy)
    assert kept.columns == messy.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 1, 2, None, None, 5, 6], key=repr)


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.keep_first_of_each(documents([])).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 150), (150, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(30)}, 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_of_one_id_with_different_texts(documents, prose):
    a, b = prose(1, 50), prose(2, 50)
    kept = simhash.keep_first_of_each(documents([(1, a), (2, a), (2, b), (2, b), (None, a)]))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted([(1, a), (2, b), (2, b), (0, a)])
