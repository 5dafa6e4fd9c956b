import random

import numpy as np
import pytest

from marquetry.llm import leaks


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_common_length():
    rng = random.Random(2)
    for _ in range(60):
        a = [rng.choice([b"x", b"y", b"z", b"w"]) for _ in range(rng.randrange(1, 90))]
        b = [rng.choice([b"x", b"y", b"q"]) for _ in range(rng.randrange(0, 90))]
        assert leaks.common_length(leaks.word_masks(a), len(a), b) == lcs(a, b)


@pytest.fixture(scope="module")
def world(spark, prose):
    items = [(i, prose(9000 + i, 15 + i * 3 % 40, 3000)) for i in range(25)]
    clean = [(i, prose(i, 30 + i * 7 % 300, 3000)) for i in range(160)]
    docs = spark.createDataFrame([(*d, "k", "i") for d in clean], "doc_id long, text string, key string, id string").repartition(4)
    bench = spark.createDataFrame([(*i, "b") for i in items] + [(99, None, ""), (98, "", ""), (None, "no id here", "")], "item_id long, text string, body string")
    return items, clean, docs, bench, leaks.fit(docs, bench)


def planted(items, clean, prose, rate):
    rng = random.Random(4)
    rows = []
    for n, (i, text) in enumerate(clean):
        item, words = items[n % len(items)][0], items[n % len(items)][1].split()
        words = [prose(rng.randrange(10**6), 1, 3000) if rng.random() < rate else w for w in words]
        own = text.split()
        at = rng.randrange(len(own))
        rows.append((i, " ".join([*own[:at], *words, *own[at:]]), item))
    return rows


@pytest.mark.parametrize("rate, recall", [(0, 1.0), (0.1, 0.97), (0.2, 0.85)])
def test_recall_of_planted_items(spark, world, prose, rate, recall):
    items, clean, _, bench, index = world
    rows = planted(items, clean, prose, rate)
    found = leaks.search(spark.createDataFrame(rows, "doc_id long, text string, item long"), bench, index).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    want = {(i, item) for i, _, item in rows}
    assert len(pairs & want) >= recall * len(want)
    assert len(pairs - want) <= 2


def test_candidates_against_brute_force(world, prose):
    """Of all (text, item) pairs that the verification accepts somewhere, the index finds nine tenths."""
    items, clean, _, _, index = world
    texts = [t for _, t, _ in planted(items, clean, prose, 0.15)]
    searcher = leaks.Searcher(items, index.weights, index.basis)
    truth = set()
    for n, text in enumerate(texts):
        words = leaks.words_of(text)
        for item in searcher._items:
            size = len(item.words)
            if any(item.is_in(*item.shares(words[at : at + size])) for at in range(0, max(1, len(words) - size + 1))):
                truth.add((n, item.item_id))
    found = {(n, searcher._items[i].item_id) for n, i, *_ in searcher.candidates([leaks.slots_of(t) for t in texts])}
    assert len(truth) > 100 and len(found & truth) >= 0.9 * len(truth)


def test_clean_documents_stay(world):
    _, clean, docs, bench, index = world
    assert leaks.search(docs, bench, index).collect() == []
    kept = leaks.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(clean)


def test_items_in_parts(spark, world, prose):
    items, clean, _, bench, index = world
    df = spark.createDataFrame(planted(items, clean, prose, 0), "doc_id long, text string, item long")
    whole = {tuple(r)[:2] for r in leaks.search(df, bench, index).collect()}
    assert {tuple(r)[:2] for r in leaks.search(df, bench, index, at_once=4).collect()} == whole
    again = bench.union(bench.filter("item_id < 3"))
    assert {tuple(r)[:2] for r in leaks.search(df, again, index, at_once=2).collect()} == whole
    left = leaks.drop_leaks(df, bench, at_once=7)
    assert left.count() == 0


def test_messy_rows(messy, world, spark):
    items, _, _, bench, index = world
    assert leaks.search(messy, bench, index).collect() == []
    assert leaks.drop_leaks(messy, bench).count() == 10
    leaked = messy.limit(0).unionByName(messy).withColumn("text", messy["text"])
    assert leaks.drop_leaks(leaked, bench.limit(0)).count() == 10
    assert leaks.drop_leaks(messy.limit(0), bench).collect() == []


def test_the_basis_spans_the_leading_directions(spark):
    rng = np.random.default_rng(0)
    names = [f"t{i}" for i in range(12)]
    texts = [" ".join(rng.choice(names[3 * (i % 4) : 3 * (i % 4) + 3], 64)) for i in range(200)]
    weights = np.ones(leaks.SLOTS, dtype=np.float32)
    basis = leaks.basis_of(spark.createDataFrame([(t,) for t in texts], "text string"), weights, rank=4)
    rows = []
    for t in texts:
        row = np.zeros(leaks.SLOTS)
        np.add.at(row, leaks.slots_of(t), 1)
        rows.append(row / np.linalg.norm(row))
    right = np.linalg.svd(np.array(rows), full_matrices=False)[2][:4]
    unit = basis / np.linalg.norm(basis, axis=0)
    assert np.linalg.norm(right @ unit, axis=0).min() > 0.99


def test_every_document_takes_part_in_the_basis(spark):
    """A word of any two documents is known to the basis, however many documents there are."""
    texts = [f"w{i // 2} v{i // 2}" for i in range(1400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = leaks.fit(docs, docs.select("text").limit(1))
    own = np.unique(np.concatenate([leaks.slots_of(t) for t in texts]))
    assert not (np.abs(index.basis[own]).max(axis=1) == 0).any()


def reworded(words, rate, rng, names):
    """``words`` with that share of them replaced, in the first three quarters."""
    words, open_ = list(words), range(len(words) - max(3, len(words) // 4))
    for at in rng.sample(open_, min(len(open_), int(rate * len(words)))):
        words[at] = rng.choice(names)
    return words


KINDS = [(400, 0), (300, 0.45), (120, 0.4), (40, 0.45), (40, 0.3), (4, 0), (2, 0)]


def test_every_planted_run_that_passes_is_found(spark, prose):
    """Recall against comparisons without windows and cosines, on more documents than the sample has."""
    rng, names = random.Random(3), prose(77, 4000, 3000).split()
    items = [(i, prose(70_000 + i, KINDS[i % 7][0], 3000)) for i in range(28)]
    rows, truth = [], set()
    for i in range(700):
        own = prose(80_000 + i, 90, 3000).split()
        at, (item_id, text), (size, rate) = rng.randrange(len(own)), items[i % 28], KINDS[i % 7]
        leak = reworded(text.split(), rate, rng, names) if i < 84 else []
        rows.append((i, " ".join([*own[:at], *leak, *own[at:]])))
        tail = max(3, size // 4)
        if leak and lcs(text.split(), leak) >= 0.55 * size and lcs(text.split()[-tail:], leak) >= 0.6 * tail * (size >= 8):
            truth.add((i, item_id))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in leaks.search(docs, bench, leaks.fit(docs, bench)).collect()}
    missed = {k: sum(i % 7 == n for i, _ in truth - found) for n, k in enumerate(KINDS)}
    assert len(truth) >= 80 and not any(missed.values()), missed
    assert len({(i, item) for i, item in found - truth if KINDS[item % 7][0] >= 8}) <= 2


def test_a_short_item_is_found_verbatim_only():
    weights, basis = np.ones(leaks.SLOTS, np.float32), np.random.default_rng(1).standard_normal((leaks.SLOTS, 8))
    searcher = leaks.Searcher([(1, "alpha beta gamma"), (2, "solo"), (3, None)], weights, basis.astype(np.float32))
    texts = ["x Alpha, beta gamma. y", "alpha x beta gamma", "alpha beta", "gamma solo", None, ""]
    assert [r[:2] for r in searcher.search(texts)] == [(0, 1), (3, 2)]


def test_every_text_of_one_id_is_searched(spark):
    rows = [(5, f"text {i}") for i in range(7)] * 2 + [(6, "other"), (None, "no id"), (7, None)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    index = leaks.Index(np.ones(leaks.SLOTS, np.float32), np.zeros((leaks.SLOTS, 2), np.float32))

    def texts(item_id):
        found = leaks._searchers(bench, index, item_id, "text", 3)
        return sorted(i.text for part in found for i in part.value._items)

    every = sorted([f"text {i}" for i in range(7)] + ["other"])
    assert texts("item_id") == every and texts(None) == sorted([*every, "no id"])


def test_texts_hashed_together(prose):
    texts = [prose(i, i * 13 % 90, 3000) for i in range(60)] + [None, "", " ", "é É", "x" * 70_000 + " y"]
    found = [part for hashes, n in leaks.hashes_of_all(texts) for part in np.split(hashes, np.cumsum(n)[:-1])]
    assert [f.tolist() for f in found] == [leaks.hashes_of(t).tolist() for t in texts]


def test_candidates_are_all_windows_that_are_near(world, prose):
    items, clean, _, _, index = world
    texts = [leaks.slots_of(t) for _, t, _ in planted(items, clean[:40], prose, 0.3)] + [leaks.slots_of("")] * 2
    searcher, want = leaks.Searcher(items, index.weights, index.basis), {}
    for n, slots in enumerate(texts):
        for window in leaks.WINDOWS:
            for first in range(0, len(slots), max(leaks.WORDS_IN_BLOCK, window // 2)):
                for item in range(len(searcher._items)):
                    want[n, item, first, window] = searcher._cosine(slots[first : first + window], item)
    found = {f[:4]: f[4] for f in searcher.candidates(texts)}
    assert {k for k, cosine in want.items() if cosine >= leaks.COSINE + 1e-5} <= found.keys() and len(found) > 40
    assert all(abs(want[k] - cosine) < 1e-5 and want[k] >= leaks.COSINE - 1e-5 for k, cosine in found.items())


def test_a_round_multiplies_by_the_transpose():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 3, (40, 90)) * (rng.random((40, 90)) < 0.2)
    rows[3] = 0
    weights, basis = rng.random(leaks.SLOTS).astype(np.float32), rng.standard_normal((leaks.SLOTS, 6)).astype(np.float32)
    out = np.zeros((leaks.SLOTS, 6), dtype=np.float32)
    own = [np.flatnonzero(r) for r in rows]
    leaks._add_gram(out, [o.astype(np.uint16).tobytes() for o in own], [r[o].astype(np.uint32).tobytes() for r, o in zip(rows, own, strict=True)], weights, basis)
    a = rows * weights[:90]
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    assert np.allclose(out[:90], a.T @ (a @ basis[:90]), atol=1e-4) and not out[90:].any()


def test_runs_without_enough_words_are_not_compared_in_order(monkeypatch):
    def compared(*_):
        raise AssertionError

    item = leaks.Item(1, "the a of to in one two three four five six seven")
    monkeypatch.setattr(leaks, "common_length", compared)
    assert list(item.runs(b"the the the a a a of of to to in in the of a".split(), 0, 15)) == []
    with pytest.raises(AssertionError):
        list(item.runs(item.words, 0, len(item.words)))
