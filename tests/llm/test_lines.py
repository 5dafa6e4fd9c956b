import random

import numpy as np
import pytest

from marquetry.llm import common, lines


def brute(rows, similarity=0.8):
    """Lines to remove, by comparing all."""
    every = [
        (i, n, set(lines.tokens(x).tolist()))
        for i, t in sorted(r for r in rows if r[0] is not None and r[1])
        for n, x in enumerate(t.encode().lower().split(b"\n"))
    ]
    out = {}
    for k, (i, n, own) in enumerate(every):
        if own and any(o and len(own & o) >= similarity * len(own | o) - 1e-9 for _, _, o in every[:k]):
            out.setdefault(i, []).append(n)
    return out


def corpus(prose, n=30):
    rng = random.Random(9)
    base = [prose(i, 60) for i in range(6)]
    rows = []
    for i in range(n):
        own = []
        for _ in range(rng.randrange(1, 6)):
            words = rng.choice(base).split()
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = "zz"
            own.append(" ".join(words) if rng.random() < 0.6 else prose(rng.randrange(10**6), rng.randrange(1, 30)))
        rows.append((i * 3, "\n".join(own)))
    return rows


@pytest.mark.parametrize("group", [0, 2, 16], ids=["leaders only", "small groups", "pairs"])
def test_against_brute_force(documents, prose, group):
    rows = corpus(prose)
    got = {r["doc_id"]: r["lines"] for r in lines.removed_lines(documents(rows), group=group).collect()}
    assert got == brute(rows)
    assert got


def test_kept_text(documents, prose):
    a, b = prose(1, 20), prose(2, 20)
    rows = [(1, f"{a}\nshort\n{b}"), (2, f"short\n{b.upper()}\n\n{a} "), (3, None), (4, ""), (5, a)]
    df = documents(rows)
    got = lines.drop_lines(df)
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: rows[0][1], 2: "short\n", 3: None, 4: "", 5: ""}


def test_messy_rows(messy):
    got = lines.drop_lines(messy).select("doc_id", "text").collect()
    assert len(got) == 10
    texts = {}
    for r in got:
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert texts[7] == [""] and texts[2] == [None] and texts[4] == ["   \n \t"]
    assert sorted(len(t or "") > 0 for t in texts[None]) == [False, True]
    assert [bool(t) for t in texts[5]] == [True]


def test_empty_table(documents):
    assert lines.drop_lines(documents([])).collect() == []
    assert lines.removed_lines(documents([(1, "a b c")])).collect() == []


def test_long_texts_go_through_in_parts(prose, monkeypatch):
    text = "\n".join(prose(i, 12) for i in range(300)) + "\n\n" + prose(5, 500)

    def sets():
        return {
            (int(at[low + k]), int(number[low + k])): sorted((key[starts[k] : starts[k + 1]] & lines._TOKEN).tolist())
            for at, number, low, key, starts in lines._sets_of([text, "", "x", text], 5, None)
            for k in range(len(starts) - 1)
        }

    whole = sets()
    monkeypatch.setattr(lines, "BYTES_AT_ONCE", 700)
    monkeypatch.setattr(lines, "LINES_AT_ONCE", 7)
    assert sets() == whole and len(whole) == 2 * 302 + 2


def test_copies_of_short_lines_go(documents):
    """Against whole word sequences, without lines.tokens."""
    rows = [(1, "Of.\nAND!! ORND.\na b c d\n\nz"), (2, "of.\n\nand!!  ornd.\nd c b a\na b c"), (3, "a b c d\nOF. of.\nz\n "), (4, "of.")]
    seen, want = set(), {}
    for i, text in rows:
        for n, line in enumerate(text.lower().split("\n")):
            words = tuple(line.split())
            if words in seen:
                want.setdefault(i, []).append(n)
            seen |= {words} if words else set()
    got = lines.removed_lines(documents(rows), short=True).collect()
    assert {r["doc_id"]: r["lines"] for r in got} == want == {2: [0, 2], 3: [0, 2], 4: [0]}


def test_rows_of_one_id_with_different_texts(documents, prose):
    a, b, c = prose(1, 20), prose(2, 20), prose(3, 20)
    rows = [(1, a), (2, f"{a}\n{b}"), (2, f"{c}\n{prose(4, 20)}"), (2, None)]
    got = sorted((r["doc_id"], r["text"] or "") for r in lines.drop_lines(documents(rows)).collect())
    assert got == sorted([(1, a), (2, b), (2, rows[2][1]), (2, "")])


def test_slots_counted_many_at_once():
    """More slots found than there are, in pieces of all sizes, are counted as one by one."""
    rng = np.random.default_rng(5)
    found = [rng.integers(0, 50, n) for n in (0, 1, 7, 400, 3)]
    want = np.zeros(50, dtype=np.uint32)
    for part in found:
        np.add.at(want, part, 1)
    assert (common.counted(found, 50) == want).all() and not common.counted([], 50).any()


def test_slot_counts_of_all_rows(spark):
    texts = [f"{i} " * (i % 9) for i in range(900)] + [None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)

    def slots(part):
        for text in part:
            yield np.array([int(w) % 40 for w in (text or "").split()], dtype=np.int64)

    want = np.bincount(np.concatenate(list(slots(texts))), minlength=40)
    assert (common.slot_counts(docs, "text", slots, 40) == want).all()


def test_tables_are_as_large_as_what_is_asked_for(spark, documents, prose, monkeypatch):
    """No table of 16 MB goes through the driver for a few lines; rarities are made in tasks."""
    sizes = []
    real = lines.bit_table
    monkeypatch.setattr(lines, "bit_table", lambda slots, n_bits: sizes.append(n_bits) or real(slots, n_bits))
    rows = corpus(prose)
    got = {r["doc_id"]: r["lines"] for r in lines.removed_lines(documents(rows)).collect()}
    assert got == brute(rows) and sizes and max(sizes) == common.LEAST_BITS
    assert common.bits_for(10**12) == common.MOST_BITS and common.bits_for(10**5) >= 64 * 10**5
    sent = []
    summed = common.summed
    monkeypatch.setattr(common, "summed", lambda *args: sent.append(summed(*args)) or sent[-1])
    rarity = lines.token_rarity(documents(rows))
    assert rarity.dtype == np.uint8 and sum(part.nbytes for part in sent[0].values()) == lines.SLOTS


def test_bit_tables_of_several_blocks(spark, monkeypatch):
    slots = [0, 7, 8, 1023, 1024, 4095, 4095]
    monkeypatch.setattr(common, "BLOCK_BITS", 1024)
    table = common.bit_table(spark.createDataFrame([(s,) for s in slots], "slot int"), 4096)
    assert np.flatnonzero(common.is_set(table.value, np.arange(4096))).tolist() == sorted(set(slots))
