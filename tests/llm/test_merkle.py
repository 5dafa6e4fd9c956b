import hashlib

from marquetry.llm import merkle


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_edits_of_the_next_document(documents, prose):
    texts = [(i, prose(i, 40).replace(" ", "\n", 2)) for i in (3, 10, 7, 900)] + [(8, "ab"), (9, None)]
    got = by_id(merkle.with_edits(documents(texts)))
    known = {i: t or "" for i, t in texts}
    order = sorted(known)
    for i, after in zip(order, order[1:] + order[:1]):
        text, cut = known[i], len(known[i]) // 4
        edited = text[: len(text) - cut] + known[after][:cut]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i]["fingerprint"] == got[i]["edited_fingerprint"]) == (text == edited)
        if len(text) > 40:
            assert 0.5 < got[i]["near_edited"] < 1 and got[i]["near_next"] < 0.2


def test_messy_rows(messy):
    rows = merkle.with_edits(messy).collect()
    assert len(rows) == 10
    prints = {}
    for r in rows:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert prints[1] == prints[7] and prints[1] <= prints[None]
    assert prints[2] == prints[3] != prints[4]


def test_ties_follow_one_another_and_the_last_is_followed_by_the_first(documents):
    got = merkle.with_edits(documents([(1, "aaaa"), (1, "aaaa"), (2, "bbbb")])).collect()
    assert sorted((r["doc_id"], r["near_next"]) for r in got) == [(1, 0.0), (1, 1.0), (2, 0.0)]


def test_empty_and_single(documents):
    assert merkle.with_edits(documents([])).collect() == []
    one = merkle.with_edits(documents([(4, "x y z w")])).collect()[0]
    assert one["near_next"] == 1.0 and one["fingerprint"] != one["edited_fingerprint"]


def brute_root(text):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    paragraphs, lowest = [], set()
    for line in text.split("\n"):
        pieces = []
        for at, word in enumerate(line.split(" ")):
            if at and hashlib.md5(word.encode()).hexdigest()[-1] not in "012":
                pieces[-1] += f" {word}"
            else:
                pieces.append(word)
        assert " ".join(pieces) == line
        lowest |= {sha(p) for p in pieces}
        paragraphs.append(sha(" ".join(map(sha, pieces))))
    sections = [[]]
    for node in paragraphs:
        sections[-1].append(node)
        if node[-1] in "08":
            sections.append([])
    sections = [s for s in sections if s]
    return sha(" ".join(sha(" ".join(s)) for s in sections)), lowest


def test_nodes_against_brute_force(documents, prose):
    texts = [(i, "\n".join(prose(100 * i + j, 1 + j % 9) for j in range(40))) for i in range(4)] + [(9, " a  b\n\n ")]
    got = by_id(merkle.with_edits(documents(texts)))
    trees = {i: brute_root(t) for i, t in texts}
    for (i, _), (after, _) in zip(texts, texts[1:] + texts[:1]):
        (root, own), (_, other) = trees[i], trees[after]
        assert got[i]["fingerprint"] == root
        assert abs(got[i]["near_next"] - 2 * len(own & other) / (len(own) + len(other))) < 1e-12
    assert {i: r["fingerprint"] for i, r in by_id(merkle.tree(documents(texts))).items()} == {i: r for i, (r, _) in trees.items()}


def test_a_word_in_front_keeps_likeness(documents, prose):
    text = prose(3, 400)
    got = by_id(merkle.with_edits(documents([(1, text), (2, f"inserted {text}")])))
    assert 0.9 < got[1]["near_next"] < 1


def test_descent_locates_edits(documents, prose):
    lines = [prose(i, 60) for i in range(50)]
    edited = lines[20].split(" ")
    edited[30] = "changed"
    after = ["in front", *lines[:20], " ".join(edited), *lines[21:40], *lines[41:]]
    texts = [(2, "same"), (None, "x"), (4, "only here")]
    before = merkle.tree(documents([(1, "\n".join(lines)), (3, "a\na\nb"), *texts[:2], texts[2]]))
    rows = merkle.changed(before, merkle.tree(documents([(1, "\n".join(after)), (3, "a\nb"), (2, "same"), (None, "y")]))).collect()
    named = {i: [r for r in rows if r["doc_id"] == i] for i in (1, 3, None)}
    assert sum(map(len, named.values())) == len(rows)
    assert [(r["side"], r["node"]) for r in named[3]] == [("before", hashlib.sha256(b"a").hexdigest())]
    assert sorted(r["side"] for r in named[None]) == ["after", "before"]
    one_sided = {r["node"] for r in named[1]}
    trees = [brute_root("\n".join(x))[1] for x in (lines, after)]
    assert trees[0] ^ trees[1] <= one_sided
    assert len(one_sided - brute_root(lines[40])[1]) <= 8


def test_a_paragraph_in_front_is_one_leaf(documents, prose):
    lines = [prose(i, 6) for i in range(51)]
    before = merkle.tree(documents([(1, "\n".join(lines))]))
    rows = merkle.changed(before, merkle.tree(documents([(1, "\n".join(["first", *lines]))]))).collect()
    assert [(r["side"], r["section"], r["paragraph"], r["piece"]) for r in rows] == [("after", 0, 0, 0)]


def test_one_id_of_many_rows(documents):
    rows = merkle.with_edits(documents([(i, f"text {i}") for i in range(5)] + [(7, f"row {i % 40}") for i in range(200)])).collect()
    assert len(rows) == 205 and sum(r["near_next"] == 1 for r in rows) == 160
