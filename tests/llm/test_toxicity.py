import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from marquetry.llm import toxicity

BAD = [f"bad{i}" for i in range(6)]


def corpus(prose, n=900, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(seed * 10_000 + i, rng.randrange(5, 60)).split()
        toxic = int(i % 5 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, prose):
    rows, labels = corpus(prose)
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, label int")
    known = spark.createDataFrame([*labels, (0, 1), (5, None), (None, 1), (10**6, 1)], "doc_id long, toxic int")
    return toxicity.train(docs, known)


def test_held_out_accuracy(model, prose):
    rows, labels = corpus(prose, seed=7)
    predicted = [model.score(t) >= toxicity.THRESHOLD for _, t in rows]
    truth = [bool(y) for _, y in labels]
    assert sum(p and not y for p, y in zip(predicted, truth)) == 0
    assert sum(p and y for p, y in zip(predicted, truth)) >= 0.95 * sum(truth)


def test_the_model_is_compact(model):
    assert 0 < len(model.names) < 2000
    assert (np.diff(model.names) > 0).all()


def test_features_are_words_pairs_and_skips():
    assert len(toxicity.features("a b c")) == 3 + 2 + 1
    assert len(toxicity.features("A, a. a!")) == 1 + 1 + 1
    assert len(toxicity.features("")) == len(toxicity.features(" .,")) == 0
    assert (toxicity.features("Éa b") == toxicity.features("éA  B")).all()


def test_messy_rows(messy, model):
    got = toxicity.score(messy, model).collect()
    assert len(got) == 10 and all(0 <= r["score"] <= 1 for r in got)
    kept = toxicity.drop_toxic(messy, model)
    assert kept.columns == messy.columns and kept.count() == 10


def test_toxic_rows_go(documents, model):
    df = documents([(1, "x bad1 y bad2 z bad3"), (2, "x y z"), (3, None)])
    assert sorted(r["doc_id"] for r in toxicity.drop_toxic(df, model).collect()) == [2, 3]


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(documents([(1, "a")]), none)
    assert [r["score"] for r in toxicity.score(documents([(1, "a"), (2, None)]), model).collect()] == [0.5, 0.5]
    assert toxicity.score(documents([]), model).collect() == []
    only = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert 0 <= toxicity.train(documents([(1, "a")]), only).score("a") <= 1


@pytest.mark.parametrize("clean_in", [2, 5], ids=["balanced", "mostly toxic"])
def test_learns_at_any_base_rate(spark, prose, clean_in):
    def rows(seed):
        every = [(i, prose(seed + i, 20), int(i % clean_in > 0)) for i in range(400)]
        return [(i, f"{t} {BAD[i % 6]} {BAD[(i // 6) % 6]}" if y else t, y) for i, t, y in every]

    docs = spark.createDataFrame(rows(0), "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.drop("text"))
    found = [(model.score(t) >= toxicity.THRESHOLD, bool(y)) for _, t, y in rows(50_000)]
    assert sum(p and y for p, y in found) >= 0.95 * sum(y for _, y in found)
    assert sum(p and not y for p, y in found) <= 0.05 * sum(not y for _, y in found)


def plain_ftrl(rows, labels, l1, epochs):
    """The published update, a coordinate at a time."""
    z, n = {-1: 0.0}, {-1: 0.0}
    for _ in range(epochs):
        for row, label in zip(rows, labels):
            own, w = [*row, -1], {}
            for i in own:
                zi, ni = z.setdefault(i, 0.0), n.setdefault(i, 0.0)
                sign = 1.0 if zi > 0 else -1.0
                rate = (toxicity.BETA + ni**0.5) / toxicity.ALPHA + toxicity.L2
                w[i] = 0.0 if abs(zi) <= l1 else -(zi - sign * l1) / rate
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i in own:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return z, n


def test_a_shard_against_a_plain_loop():
    rng = random.Random(3)
    rows = [sorted(rng.sample(range(40), rng.randrange(0, 12))) for _ in range(60)]
    labels = [float(7 in r or rng.random() < 0.1) for r in rows]
    names, z, n = toxicity.train_shard([np.array(r, dtype=np.int64) for r in rows], np.array(labels), 0.5, 4)
    want_z, want_n = plain_ftrl(rows, labels, 0.5, 4)
    assert set(names.tolist()) == set(want_z)
    assert np.allclose(z, [want_z[i] for i in names.tolist()]) and np.allclose(n, [want_n[i] for i in names.tolist()])


def test_l1_is_raised_until_weights_fit(spark, prose, model):
    rows, labels = corpus(prose)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    small = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), most=4)
    assert 0 < len(small.names) <= 4 and set(small.names) <= set(model.names)
    assert set(small.names) <= {int(h) for b in BAD for h in toxicity.features(b)}


def test_every_labelled_row_is_learned_from(spark):
    """The rows that stand last by a hash of the id, beyond 40,000, are the only toxic ones."""
    ids = spark.range(41_000).orderBy(F.xxhash64("id")).select("id").toPandas()["id"].tolist()
    late = set(ids[40_000:])
    rows = [(i, f"plain {i % 50} {BAD[i % 6]}" if i in late else f"plain {i % 50} words", int(i in late)) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.drop("text"))
    assert model.score("plain 3 bad1") >= toxicity.THRESHOLD > 0.1 > model.score("plain 3 words")


def test_telling_features_against_counts(spark, prose):
    rows, labels = corpus(prose, 200)
    truth = dict(labels)
    learned = spark.createDataFrame([(t, float(truth[i])) for i, t in rows], "text string, label double")
    counts = {0: {}, 1: {}}
    for i, text in rows:
        for name in toxicity.features(text).tolist():
            counts[truth[i]][name] = counts[truth[i]].get(name, 0) + 1
    toxic = sum(truth.values())
    want = {n for n, k in counts[1].items() if k > 1 and k * (200 - toxic) > toxicity.LIFT * counts[0].get(n, 0) * toxic}
    assert {r["name"] for r in toxicity._telling(learned, toxic, 200 - toxic).collect()} == want


def test_calibration_against_the_margins(spark):
    """At the optimum the mean probability is that of Platt's targets."""
    rng = np.random.default_rng(5)
    margins = rng.normal(size=3000) * 3
    labels = (rng.random(3000) < 1 / (1 + np.exp(1 - 0.5 * margins))).astype(float)
    pairs = spark.createDataFrame([*zip(labels.tolist(), margins.tolist())], "label double, margin double")
    toxic = int(labels.sum())
    slope, offset = toxicity.calibration(pairs, toxic, 3000 - toxic)
    p = 1 / (1 + np.exp(-(slope * margins + offset)))
    target = np.where(labels > 0, (toxic + 1) / (toxic + 2), 1 / (3000 - toxic + 2))
    assert abs((p - target).sum()) < 1e-3 and abs(((p - target) * margins).sum()) < 1e-3
    assert 0.4 < slope < 0.6 and -1.2 < offset < -0.8
    assert toxicity.calibration(pairs, toxic, 0) == (1.0, 0.0)


def test_ids_that_are_no_numbers_give_the_same_model(spark, prose):
    """Bitmaps of ids and the plain join."""
    rows, labels = corpus(prose, 200)
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    a = toxicity.train(docs, known)
    b = toxicity.train(*(df.withColumn("doc_id", F.col("doc_id").cast("string")) for df in (docs, known)))
    assert a.names.tolist() == b.names.tolist() and len(a.names)
    assert np.allclose(a.weights, b.weights, atol=1e-6) and abs(a.bias - b.bias) < 1e-6
