import hashlib
import random
import zlib
from itertools import product

import pytest

from marquetry.llm import conversations
from marquetry.llm.conversations import CUT, solve

INITIALS = "sua."


def legal(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return not roles or (rest != "" and rest == "ua" * (len(rest) // 2))


def cheapest(codes, most_inserts=4):
    """(cost, letters) over all edits with few rows put in."""
    best = None
    for letters in (x for n in range(len(codes), len(codes) + most_inserts + 1) for x in product("DIKR", repeat=n)):
        if sum(x != "I" for x in letters) != len(codes):
            continue
        cost, row, roles = 0, 0, [""]
        for x in letters:
            if x == "I":
                cost, roles = cost + 2, [r + c for r in roles for c in "ua"]
                continue
            fault, initial = codes[row] >> 2, INITIALS[codes[row] & 3]
            row += 1
            if x == "D":
                cost += 3
            elif fault in (1, 2):
                break
            else:
                cost += (2 if x == "R" else 0) + (fault == CUT)
                roles = [r + c for r in roles for c in ("ua" if x == "R" else initial)]
        else:
            if any(map(legal, roles)):
                found = (cost, "".join(letters))
                best = found if best is None else min(best, found)
    return best


def codes_of(rng, n):
    return bytes(rng.choice([0, 1, 1, 2, 2, 3]) + 4 * rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_edits_against_all_edits(n):
    rng = random.Random(n)
    for _ in range(60 if n < 4 else 25):
        codes = codes_of(rng, n)
        assert solve(codes) == cheapest(codes), list(codes)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
def test_chunks_change_nothing(chunk):
    rng = random.Random(chunk)
    for n in [0, 1, 2, 5, 8, 13, 40, 90]:
        for _ in range(12):
            codes = codes_of(rng, n)
            assert solve(codes, chunk) == solve(codes, 1000), list(codes)


def test_a_long_conversation_is_solved_in_parts():
    cost, audit = solve(codes_of(random.Random(0), 20_000))
    assert cost > 0 and sum(x != "I" for x in audit) == 20_000


def by_hand(rows):
    """Reports of (conv, turn, role, text) rows that are already damaged."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, codes = set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\v\f\r")
            fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append((INITIALS.index(role[:1]) if role[:1] in ("s", "u", "a") else 3) + 4 * fault)
        turns = [t for t, _, _ in own if t is not None]
        cost, audit = solve(bytes(codes))
        kept, state, row = [], "", 0
        for x in audit:
            new = "assistant" if state == "u" else "user"
            if x == "I":
                kept.append(f"{new}:")
                state = new[0]
                continue
            _, role, text = own[row]
            row += 1
            if x != "D":
                role = role if x == "K" else new
                kept.append(f"{role}:{text}")
                state = role[0]
        pairs = [own[i][1][:1] + own[i + 1][1][:1] for i in range(len(own) - 1)]
        faults = [c >> 2 for c in codes]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in (1, 2, 3)),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return out


def found(df):
    return {r["conv"]: tuple(r)[1:] for r in df.collect()}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, conv string, n string, report string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def talk(rng, convs=60):
    texts = ["Yes.", "No!", "cut off", "", " \t\n", None, "Well?\n ", "你好.", "a\nb", "Yes. "]
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", "ü"]
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(0, 9)):
            rows.append((c if c else None, None if rng.random() < 0.1 else t + (t > 4), rng.choice(roles), rng.choice(texts)))
    return rows


def test_damage_and_repair_against_one_by_one(spark):
    rows = talk(random.Random(2))
    rows += rows[:9]
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: none for c, *_ in rows} | by_hand(damaged(rows))
    got = found(conversations.repair_reports(conversations.damage(table(spark, rows))))
    assert got == want
    assert none in want.values()


def test_a_conversation_of_many_rows(spark):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(400)}.") for t in range(3000)]
    rows += [(7, 5, "user", "same!")] * 500 + [(8, 1, "user", "x" * 200_000 + "."), (8, 2, "assistant", "ok.")]
    shown = table(spark, rows).selectExpr("conv_id conv", "turn", "role", "text", "true present")
    assert found(conversations.repair_reports(shown, chunk=100)) == by_hand(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (2, 0, "user", "q"), (2, 1, "user", "Q?"), (2, 2, "assistant", ""), (None, 1, "user", None)]
    got = sorted((tuple(r) for r in conversations.repaired(table(spark, rows)).collect()), key=repr)
    assert got == [
        (1, 0, "system", "S."), (1, 1, "user", ""), (1, 2, "assistant", "A."),
        (2, 0, "user", "q"), (2, 1, "assistant", "Q?"),
    ]


def test_empty_table(spark):
    empty = table(spark, [(1, 1, "user", "x")]).limit(0)
    assert conversations.repair_reports(conversations.damage(empty)).collect() == []
    assert conversations.repaired(empty).collect() == []
