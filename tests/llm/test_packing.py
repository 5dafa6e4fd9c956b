import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquetry.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize(
    "text",
    [
        "", " \n\t", "It's THE end, isn't it?! (yes) 12a3", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>",
        "a\x1cb\x85c d́ ́x ΑΣ. İstanbul ﬁ é É Å \U0001d54f 你好", "x" * 5000, "a,,b --- ###$$$ thing### $$$thing don't'll",
        " nbsp em ​zero", "'s 's' 're'd it'S",
    ],
)
def test_ids_by_word_are_the_tokenizers(tokenizer, text):
    got = np.frombuffer(packing.WordIds(PATH).of(text), dtype="<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    if not hasattr(test_ids_of_any_text, "both"):
        test_ids_of_any_text.both = packing.WordIds(PATH, remembered=20), Tokenizer.from_file(PATH)
    words, plain = test_ids_of_any_text.both
    assert np.frombuffer(words.of(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def check(df, tokenizer, sequence):
    """Every piece is where it should be, sequences are gapless and full enough."""
    pieces = packing.pack(df, PATH, sequence=sequence, with_ids=True, open_bins=8).collect()
    held = {}
    for r in pieces:
        ids = np.frombuffer(r["ids"], dtype="<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        assert r["start"] == r["piece"] * sequence and r["length"] <= sequence
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
    found = sorted(((r["doc_id"], r["piece"], r["ids"]) for r in pieces), key=repr)
    want = []
    for row in df.select("doc_id", "text").collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [0]
        for n, start in enumerate(range(0, len(ids), sequence)):
            want.append((row["doc_id"], n, np.asarray(ids[start : start + sequence], dtype="<u4").tobytes()))
    assert [(i, n, bytes(d)) for i, n, d in found] == sorted(want, key=repr)
    return held


@pytest.mark.parametrize("sequence", [8, 64, 2048])
def test_pieces(documents, prose, tokenizer, sequence):
    rows = [(i, prose(i, 3 + i * 13 % 90)) for i in range(120)]
    held = check(documents(rows), tokenizer, sequence)
    total = sum(n for places in held.values() for _, n in places)
    if sequence == 64:
        # Nearly as few as could be, counting the few bins each partition leaves.
        assert len(held) <= 1.1 * total / sequence + 3


def test_messy_rows(messy, tokenizer):
    check(messy, tokenizer, 2048)


def test_empty_table(documents):
    assert packing.pack(documents([]), PATH).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80), st.integers(1, 6))
def test_open_bins_against_a_plain_best_fit(lengths, most):
    """The tightest open bin that takes the piece; the fullest closes when there are too many."""
    bins, plain = packing.OpenBins(20, most), {}
    for length in lengths:
        number, offset = bins.place(length)
        fits = [free for free in plain.values() if free >= length]
        if fits:
            assert plain[number] == min(fits)
        else:
            assert number not in plain and offset == 0
            plain[number] = 20
        assert offset == 20 - plain[number]
        plain[number] -= length
        if not plain[number]:
            del plain[number]
        if len(plain) > most:
            open_now = bins.still_open()
            (gone,) = set(plain) - open_now
            assert plain.pop(gone) <= min(plain.values())
        assert set(plain) == bins.still_open()
