"""Repair of conversation structure by an integer-weighted shortest path.

A conversation is read row by row by the automaton of ``(s?(ua)+)?``, the initials of roles. Every row is
kept, given another role or deleted, and empty rows may be put in anywhere; the cheapest edits win, and of
equally cheap ones those whose letters (D, I, K, R) come first.

1. Columns alone find each row's first fault; equal rows of a turn are counted as one before the shuffle. What
   goes on are a row's initial, its fault and a digest of its text.
2. A task streams its conversations in order of turns and holds a byte for each row, fewer than the audit has.
   Edits are paths in a graph without rings, from the last row to the first. A path's weight is one
   integer: high digits are its cost, then a digit of three bits for each letter, first letter first, with
   zeros behind the last one. Of two weights the smaller is cheaper or, at the same cost, has the
   smaller letters; so plain minima of integers decide everything. A letter put in front moves the others one
   place down and leaves the cost where it is.
3. Rows with their texts meet their conversation's edits as a stream in the same order; a digest of the
   repaired text is a matter of one pass, of which nothing but the current batch is held.

Conversations of over CHUNK rows go chunk by chunk, so that integers stay short: what follows a chunk is one
more digit, the rank of its letters. No letters of a chunk are the beginning of another path's through it,
as rows put in belong to the row after them; the rank only decides between equal ones.

Contract. A null role or text is one space. Rows are ordered by turn (nulls first), role and the MD5 of the text;
equal rows are neighbours. A row is blank without a character other than ASCII white space, a duplicate if an
earlier row has its role and text, truncated if its last such character is none of ``.!?``; its first fault in
this order counts. Null conversation ids are one conversation. Without rows: zeros, no edits. Texts of any length are
streamed. An empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marquetry.session import staged

WHITE = " \t\n\v\f\r"
ENDS = (".", "!", "?")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows that are solved with one set of integers.
CHUNK = 256
#: Solved conversations of at most so many rows that a task remembers.
REMEMBERED, REMEMBERED_ROWS = 1 << 14, 64

# Letters of edits by their digit; 0 is no letter.
LETTERS = ".DIKR"
_D, _I, _K, _R = range(1, 5)
# States: nothing read, the last initial was s, u, a. What the next user or assistant row leads to.
_NEXT = (2, 2, 3, 2)
# Where keeping a row leads, by its initial (s, u, a, other) and the state.
_KEEP = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
_NEVER = 1 << 40
NONE, BLANK, DUPLICATE, CUT = range(4)


def _prepended(weight: int, cost: int, letter: int, top: int) -> int:
    """``weight`` with a letter in front; costs stand above ``top`` bits."""
    low = weight & ((1 << top) - 1)
    return weight - low + (cost << top) + (letter << (top - 3)) + (low >> 3)


def _with_inserts(weights: list[int], top: int) -> list[int]:
    """Up to two rows put in; after two more the state is one that fewer reach."""
    out = weights
    for _ in range(2):
        out = [min(w, _prepended(out[_NEXT[s]], INSERT, _I, top)) for s, w in enumerate(weights)]
    return out


def _chunk(codes: bytes, ends: list[tuple[int, int]] | None) -> tuple[list[tuple[int, int]], list[str]]:
    """Costs and ranks of the four states before ``codes``, and their letters through it.

    ``ends`` are those after it; None after the last chunk.
    """
    top = 3 * (3 * len(codes) + 3)
    if ends is None:
        weights = _with_inserts([0, _NEVER << top, _NEVER << top, 0], top)
    else:
        weights = [(cost << top) + (rank << (top - 3)) for cost, rank in ends]
    for code in reversed(codes):
        keep, fault = _KEEP[code & 3], code >> 2
        more = TRUNCATED if fault == CUT else 0
        before = []
        for state in range(4):
            best = _prepended(weights[state], DELETE, _D, top)
            if fault in (NONE, CUT):
                best = min(best, _prepended(weights[_NEXT[state]], REROLE + more, _R, top))
                if keep[state] is not None:
                    best = min(best, _prepended(weights[keep[state]], more, _K, top))
            before.append(best)
        weights = _with_inserts(before, top)
    lows = [w & ((1 << top) - 1) for w in weights]
    ranks = {low: i + 1 for i, low in enumerate(sorted(set(lows)))}
    # Octal digits are letters; the last one is the rank of what follows.
    texts = [f"{low:0{top // 3}o}".rstrip("0") for low in lows]
    texts = [(t if ends is None else t[:-1]).translate(_DIGITS) for t in texts]
    return [(w >> top, ranks[low]) for w, low in zip(weights, lows, strict=True)], texts


_DIGITS = str.maketrans("1234", LETTERS[1:])


def solve(codes: bytes, chunk: int = CHUNK) -> tuple[int, str]:
    """Cost and letters of the cheapest edits; a code is a row's initial (s, u, a, other) and four times its fault."""
    starts = list(range(0, len(codes), chunk)) or [0]
    ends, texts = None, []
    for start in reversed(starts):
        ends, letters = _chunk(codes[start : start + chunk], ends)
        texts.append(letters)
    state, audit = 0, []
    for start, letters in zip(starts, reversed(texts), strict=True):
        audit.append(letters[state])
        for _, _, state in _steps(letters[state], codes[start : start + chunk], state):
            pass
    return ends[0][0], "".join(audit)


def _steps(letters: str, codes: bytes, state: int) -> Iterator[tuple[str, int | None, int]]:
    """Each letter, the number of the row that it is about, and the state behind it."""
    row = 0
    for letter in letters:
        if letter in "IR":
            state = _NEXT[state]
        elif letter == "K":
            state = _KEEP[codes[row] & 3][state]
        yield letter, None if letter == "I" else row, state
        row += letter != "I"


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, present): rows with faults put in by a checksum of conversation and turn.

    Dropped rows stay as rows that are not present, so that their conversations are still known.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn, role, text)]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    damaged = rows.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(shown[2]).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(shown[3], "".join(ENDS), "")).otherwise(shown[3]).alias("text"),
        (kind != 0).alias("present"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return damaged.select("*", F.explode("copies").alias("copy")).drop("copies", "copy")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, n, code, more): ``n`` equal rows, the first one's code and that of the others."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    flagged = rows.select(
        "conv",
        F.when(F.col("present"), F.col("turn")).alias("turn"),
        F.when(F.col("present"), F.col("role")).otherwise("").alias("role"),
        F.when(F.col("present"), _digest(F.col("text"))).otherwise(F.lit(b"")).alias("digest"),
        F.col("present").cast("long").alias("n"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(*ENDS)).alias("cut"),
    )
    counted = flagged.groupBy("conv", "turn", "role", "digest").agg(
        F.sum("n").alias("n"), F.max("blank").alias("blank"), F.max("cut").alias("cut")
    )
    counted = counted.repartition("conv")
    first = F.min(F.struct("turn")).over(W.partitionBy("conv", "role", "digest"))
    again = first != F.struct("turn")
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("cut"), CUT).otherwise(NONE)
    more = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
    initial = _initial(F.col("role"))
    # Rows that aren't present make no group of their own beside rows that are: their role is empty, n is 0.
    return counted.select(
        "conv", "turn", "role", "digest", "n", (initial + 4 * fault).alias("code"), (initial + 4 * more).alias("more")
    )


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _reports(faults: DataFrame, kind: str, chunk: int) -> DataFrame:
    """(conv and REPORT) for every conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {}
        conv, codes, turns, begun = None, bytearray(), [], False
        out: list[tuple] = []

        def report() -> tuple:
            own = bytes(codes)
            if own in known:
                cost, audit = known[own]
            else:
                cost, audit = solve(own, chunk)
                if len(own) <= REMEMBERED_ROWS and len(known) < REMEMBERED:
                    known[own] = cost, audit
            initials = own.translate(_TO_INITIAL)
            legal = initials.count(b"su") + initials.count(b"ua") + initials.count(b"au")
            faults = own.translate(_TO_FAULT)
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            counts = [faults.count(bytes([f])) for f in (BLANK, DUPLICATE, CUT)]
            return (conv, gaps, *counts, max(0, len(own) - 1) - legal, cost, audit)

        def sent() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            arrays = [pa.array(columns[0], conv_type), *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["conv", *(f.split(" ")[0] for f in REPORT.split(", "))])

        conv_type = None
        for batch in batches:
            conv_type = batch.column(0).type
            for key, turn, n, code, more in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if not begun or key != conv:
                    if begun:
                        out.append(report())
                    conv, codes, turns, begun = key, bytearray(), [], True
                if n:
                    codes.append(code)
                    codes.extend(bytes([more]) * (n - 1))
                    if turn is not None:
                        turns = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
            yield sent()
            out = []
        if begun:
            out.append(report())
            yield sent()

    chosen = faults.sortWithinPartitions("conv", "turn", "role", "digest").select("conv", "turn", "n", "code", "more")
    return chosen.mapInArrow(run, f"conv {kind}, {REPORT}")


_TO_INITIAL = bytes(b"sua."[c & 3] for c in range(256))
_TO_FAULT = bytes(c >> 2 & 3 for c in range(256))


def _applied(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows."""
    state = 0
    for letter in audit:
        if letter == "I":
            state = _NEXT[state]
            yield ("user" if state == 2 else "assistant"), ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = _KEEP["sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3][state]
            yield role, text
        elif letter == "R":
            state = _NEXT[state]
            yield ("user" if state == 2 else "assistant"), text


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """Each conversation's report, and its rows as they come."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    held = next(rows, None)
    while held is not None:
        report = held[2]

        def own() -> Iterator[tuple[str, str]]:
            nonlocal held
            while (held := next(rows, None)) is not None and held[2] is None:
                yield held[:2]

        texts = own()
        yield report, texts
        for _ in texts:
            pass


def _with_reports(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """A conversation's report, then its rows in order, all in one partition."""
    kinds = {f: rows.schema[f].dataType for f in ("turn", "role", "text")}
    # The report holds the id, so that it is there for a conversation without one.
    heads = reports.select(
        "conv", F.lit(0).alias("part"), *(F.lit(None).cast(k).alias(f) for f, k in kinds.items()),
        F.lit(None).cast("binary").alias("digest"), F.struct(*reports.columns).alias("report"),
    )
    none = F.lit(None).cast(heads.schema["report"].dataType).alias("report")
    own = rows.filter("present").select("conv", F.lit(1).alias("part"), "turn", "role", "text", _digest(F.col("text")).alias("digest"), none)
    both = heads.unionByName(own).repartition("conv")
    return both.sortWithinPartitions("conv", "part", "turn", "role", "digest").select("role", "text", "report")


def _filled(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    shown = [F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    return rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), *shown, F.lit(True).alias("present"))


def reports(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Faults, cost and edits of every conversation of ``rows`` (conv, turn, role, text, present), staged."""
    return staged(_reports(_faults(rows), rows.schema["conv"].dataType.simpleString(), chunk), "reports")


def repair_reports(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``reports`` and ``repaired_sha256``, the digest of the repaired ``role:text`` lines."""
    found = reports(rows, chunk)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for report, texts in _streamed(batches):
            digest, first = hashlib.sha256(), True
            for role, text in _applied(report["audit"], texts):
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            out.append(report | {"repaired_sha256": digest.hexdigest()})
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    fields = StructType([*found.schema.fields, StructField("repaired_sha256", StringType())])
    schema = to_arrow_schema(fields)
    return _with_reports(rows, found).mapInArrow(run, fields)


_PLACED = [StructField("place", LongType()), StructField("role", StringType()), StructField("text", StringType())]


def repaired(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """(conv, place, role, text): the rows of every repaired conversation."""
    own = _filled(rows, conv_id, turn, role, text)
    found = reports(own, chunk)
    fields = StructType([found.schema["conv"], *_PLACED])
    schema = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for report, texts in _streamed(batches):
            for place, (r, t) in enumerate(_applied(report["audit"], texts)):
                out.append({"conv": report["conv"], "place": place, "role": r, "text": t})
                size += len(t)
                if len(out) == 1000 or size > 1 << 24:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _with_reports(own, found).mapInArrow(run, fields)
