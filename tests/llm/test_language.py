import random
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from marquetry.llm import language

SYLLABLES = {"aa": "ba bo bu ta to tu", "bb": "ki ke ko ri re ro", "cc": "ña ño çu ßa ŝe ŝi"}


def text_in(name, seed, words=30):
    rng = random.Random(f"{name}{seed}")
    return " ".join("".join(rng.choices(SYLLABLES[name].split(), k=rng.randrange(1, 4))) for _ in range(words))


@settings(max_examples=60, deadline=None)
@given(st.text("abc ", max_size=60), st.text("abcd ", max_size=60))
def test_phrases_are_longest_matches(sample, text):
    parser = language.CrossParser({"x": sample})

    def letters(t):
        return " ".join("".join(c if c.isalpha() else " " for c in t).split())

    own, rest, phrases = letters(sample), letters(text), 0
    while rest:
        n = next((k for k in range(len(rest), 0, -1) if rest[:k] in own), 1)
        rest, phrases = rest[n:], phrases + 1
    got, chars, _ = parser.phrases([text])
    assert chars[0] == len(letters(text))
    assert got[0, 0] == phrases


def test_accuracy_on_other_texts():
    parser = language.CrossParser({n: " ".join(text_in(n, i) for i in range(60)) for n in SYLLABLES})
    texts = [(n, text_in(n, 1000 + i, words=3 + i)) for n in SYLLABLES for i in range(40)]
    found = list(parser.predict([t.upper() + " 123 %%%" for _, t in texts]))
    assert np.mean([f == n for (f, _), (n, _) in zip(found, texts)]) > 0.97
    assert all(0 <= s <= 1 for _, s in found)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 10**12), st.integers(0, 10**6), max_size=40), st.lists(st.integers(0, 10**12), max_size=20))
def test_edges_are_a_map(known, asked):
    keys, values = (np.array(list(x), dtype=np.int64) for x in (known.keys(), known.values()))
    asked = [*asked, *known]
    got = language.Edges(keys, values).find(np.array(asked, dtype=np.int64))
    assert got.tolist() == [known.get(k, -1) for k in asked]


def test_languages_of_thousands_of_letters():
    letters = [chr(c) for c in range(0x4E00, 0x9000) if chr(c).isalpha()]
    # Words of two to four letters: single letters drawn evenly would be a phrase each in every language.
    words = {}
    for i in range(3):
        rng, own = random.Random(i), letters[i * 4000 : i * 4000 + 5000]
        words[f"l{i}"] = ["".join(rng.choices(own, k=rng.randrange(2, 5))) for _ in range(6000)]

    def said(name, seed, n):
        return "".join(random.Random(f"{name}{seed}").choices(words[name], k=n))[:n]

    tracemalloc.start()
    parser = language.CrossParser({n: said(n, 0, language.SAMPLE_CHARS) for n in words})
    texts = [(n, said(n, 1 + i, 300)) for n in words for i in range(20)]
    found = list(parser.predict([t for _, t in texts]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f for f, _ in found] == [n for n, _ in texts]
    assert peak < 500e6 and parser.edges.nbytes < 64e6


def test_long_texts_are_parsed_whole():
    parser = language.CrossParser({n: text_in(n, 1, 400) for n in SYLLABLES})
    mixed = text_in("aa", 5, 50) + " " + text_in("bb", 6, 5000)
    assert [f for f, _ in parser.predict([mixed])] == ["bb"]


def test_messy_rows(messy, spark):
    rows = [(100 + i, text_in(n, i), n) for n in SYLLABLES for i in range(8)] + [(1, None, "aa"), (2, "x", None)]
    samples = language.learn(spark.createDataFrame([(*r, "n", 3, 4) for r in rows], "doc_id long, text string, lang string, name string, rank int, key int"))
    assert sorted(samples) == sorted(SYLLABLES)
    got = language.predict(messy, samples).collect()
    assert len(got) == 10
    unknown = [r for r in got if r["lang_pred"] == "und"]
    assert sorted((r["doc_id"] for r in unknown), key=repr) == sorted([2, 3, 4, None], key=repr)
    assert all(r["score"] == 0 for r in unknown)


def test_nothing_learned(documents):
    none = language.learn(documents([]))
    assert none == {}
    assert [tuple(r) for r in language.predict(documents([(1, "a")]), none).collect()] == [(1, "und", 0.0)]
    assert language.predict(documents([]), {"aa": "ba"}).collect() == []
    assert [f for f, _ in language.CrossParser({"aa": "", "bb": "1 2"}).predict(["a", None])][1] == "und"


def test_bounds(spark):
    rows = [(i, "w" * 50, "aa") for i in range(30)]
    samples = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=4, chars=120)
    assert len(samples["aa"]) == 120
