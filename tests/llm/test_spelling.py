import random
import re
import zlib
from collections import Counter

import pytest

from marquetry.llm import spelling


def within_one(a, b):
    """Exactly one inserted, deleted or replaced letter, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, typo_every):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if typo_every and i is not None and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def brute(rows, typo_every=None):
    words, out = counted(rows, typo_every), {}
    for w, n in words.items():
        near = [v for v in words if within_one(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, None, n, len(near), None if form is None else words[form]]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row[1] = root
    return {w: tuple(row) for w, row in out.items()}


def got(df):
    return {r["word"]: tuple(r)[1:] for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def corpus(seed=3, n=40):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abé", k=rng.randrange(4, 9))) for _ in range(25)]
    chain = ["kkkkk", "kkkkl", "kkkll", "kklll", "kllll", "lllll"]
    rows = [(-1, " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2**i)))]
    for i in range(n):
        words = []
        for _ in range(60):
            w = list(rng.choice(base))
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice(["", "a", "É", "b"])
            words.append("".join(w))
        rows.append((i, ", ".join(words)))
    return rows


@pytest.mark.parametrize("typo_every", [None, 5])
def test_against_brute_force(documents, typo_every):
    rows = corpus()
    want = brute(rows, typo_every)
    assert got(spelling.variants(documents(rows), typo_every=typo_every)) == want
    assert any(r[0] for r in want.values()) and any(r[1] not in (w, r[0]) for w, r in want.items())


@pytest.mark.parametrize("index, group", [(1, 1), (1, 7), (64, 3)])
def test_small_indexes_and_split_groups(spark, index, group, monkeypatch):
    monkeypatch.setattr(spelling, "QUERIES_HELD", 3)
    words = counted(corpus(5), None)
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = [tuple(r) for r in spelling.near_words(table, index, group).collect()]
    assert sorted(found) == sorted((a, b, words[b]) for a in words for b in words if within_one(a, b))


def test_one_edit_of_all_lengths(monkeypatch):
    monkeypatch.setattr(spelling, "QUERIES_AT_ONCE", 5)
    rng = random.Random(1)
    words = list({"".join(rng.choices("ab", k=rng.randrange(1, 9))) for _ in range(200)})
    words += [w * 30 for w in words if w] + [w * 30 + "a" for w in words if w]
    words = sorted({w.encode() for w in words})
    query, word = spelling.one_edit(words, words)
    want = {(a, b) for a in words for b in words if len(b) >= len(a) and within_one(a, b)}
    assert {(words[i], words[k]) for i, k in zip(query, word, strict=True)} == want
    assert len(query) == len(want)
    assert spelling.one_edit([], words)[0].tolist() == [] == spelling.one_edit(words, [])[0].tolist()


def test_messy_rows(messy):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert got(spelling.variants(messy, typo_every=7)) == brute(rows, 7)


def test_very_long_words(documents):
    a, b = "ab" * 6000, "ab" * 2999 + "xb" + "ab" * 3000
    rows = [(i, f"{a} {b} {a}x {b}yy ABCDE") for i in range(3)] + [(9, a), (10, b), (11, b), (12, b), (13, b)]
    assert got(spelling.variants(documents(rows))) == brute(rows)


def test_ties_go_to_the_smallest(documents):
    rows = [(1, "worda wordz " * 8 + "wordk " * 4 + "wordé " * 3 + "other " * 3)]
    found = got(spelling.variants(documents(rows)))
    assert found["wordk"] == ("worda", "worda", 4, 3, 8)
    assert found["wordé"] == ("worda", "worda", 3, 3, 8)
    assert found["worda"] == (None, "worda", 8, 3, None) and found["other"] == (None, "other", 3, 0, None)


def test_empty_table(documents):
    assert spelling.variants(documents([])).collect() == []
    assert spelling.variants(documents([(1, None), (2, ""), (3, "a b")])).collect() == []
