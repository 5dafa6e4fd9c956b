"""Line deduplication by an exact set-similarity join.

A line's tokens are its runs of WIDTH words. A line is removed if an earlier one, by (doc_id, line
number), has a token set of Jaccard similarity SIMILARITY or more; matches are judged on the input,
also with lines that are themselves removed.

1. Tokens are counted in SLOTS slots over all lines; a line's tokens are ordered by rarity (the
   count's logarithm, then hash). Similar sets share a token among their first |x| - ceil(t |x|) + 1 ones.
2. Lines with equal sets are similar; all but the first are removed, and the first stands for them.
3. Prefix tokens that more than one set has bring sets together. Pairs whose sizes or token places
   rule out the overlap that t asks for are dropped; the rest are verified on whole sets.

Large groups (near copies in great number) are not expanded into pairs. In a token group of more
than GROUP sets every set is first held against the earliest one alone; only sets that no such
comparison removes are then held against all earlier sets of the group.

Contract. Lines are parted by line feeds; words are runs without ASCII white space, compared with
A-Z in lower case. Lines of fewer than WIDTH words are never removed and remove none, unless ``short``
is asked for: then such a line has its whole word sequence as its one token, and copies of it go. Lines
without words always stay. Null texts
stay null, empty ones empty; a text of removed lines alone becomes empty. Rows with a null doc_id
stay as they are. A row is told by its doc_id and a hash of its text, and rows of one doc_id are
ordered by that hash; rows that share both are one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.session import staged

from .common import bit_table, bits_for, in_batches, is_set, slot_counts, word_hashes

WIDTH = 5
SIMILARITY = 0.8
SLOTS = 1 << 20
GROUP = 16
# How far apart the places of neighbouring lines are in such a table.
LINE_STEP = 1_000_003
#: Bytes that are worked on at once, if lines are no longer, and lines that are sorted at once.
BYTES_AT_ONCE = 1 << 20
LINES_AT_ONCE = 1000

# A token is a hash of 46 bits; below its line's number and its rarity it makes one sortable number.
_TOKEN_BITS, _RARITY_BITS = 46, 8
_TOKEN = np.uint64((1 << _TOKEN_BITS) - 1)
_LINE_SHIFT = np.uint64(_TOKEN_BITS + _RARITY_BITS)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _runs(data: bytes, width: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``width`` words in the lines of ``data``, and the number of each one's line.

    With ``short``, also the whole word sequences of the lines that have fewer words.
    """
    flat = np.frombuffer(data, dtype=np.uint8)
    own, starts = word_hashes(flat)
    line = np.searchsorted(np.flatnonzero(flat == 10), starts)
    n = max(0, len(own) - width + 1)
    runs = own[:n].copy()
    for i in range(1, width):
        runs = (runs ^ (runs >> np.uint64(29))) * _ODD + own[i : i + n]
    runs = (runs ^ (runs >> np.uint64(32))) * _ODD
    whole = line[:n] == line[len(own) - n :]
    runs, at = ((runs ^ (runs >> np.uint64(29))) & _TOKEN)[whole], line[:n][whole]
    return _with_short(runs, at, own, line, width) if short else (runs, at)


def _with_short(
    runs: np.ndarray, at: np.ndarray, own: np.ndarray, line: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """``runs`` and their lines ``at``, and those of the lines with one to ``width`` - 1 of the words ``own``."""
    lines, first, sizes = np.unique(line, return_index=True, return_counts=True)
    for size in range(1, width):
        chosen = sizes == size
        found = np.full(int(chosen.sum()), size, dtype=np.uint64)
        for i in range(size):
            found = (found ^ (found >> np.uint64(29))) * _ODD + own[first[chosen] + i]
        found = (found ^ (found >> np.uint64(32))) * _ODD
        runs = np.concatenate((runs, (found ^ (found >> np.uint64(29))) & _TOKEN))
        at = np.concatenate((at, lines[chosen]))
    order = np.argsort(at, kind="stable")
    return runs[order], at[order]


def _chunks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """Bytes with whole lines of some texts, and of each line the text and its number there."""
    held: list[tuple[int, int, bytes]] = []

    def joined() -> tuple[np.ndarray, np.ndarray, bytes]:
        counts = [piece.count(b"\n") + 1 for _, _, piece in held]
        at = np.repeat([h[0] for h in held], counts)
        number = np.concatenate([h[1] + np.arange(n) for h, n in zip(held, counts, strict=True)])
        return at, number, b"\n".join(h[2] for h in held)

    size = 0
    for at, text in enumerate(texts):
        raw, start, number = (text or "").encode().lower(), 0, 0
        while start <= len(raw):
            end = len(raw)
            if end - start > BYTES_AT_ONCE:
                end = raw.rfind(b"\n", start, start + BYTES_AT_ONCE)
                end = end if end >= 0 else raw.find(b"\n", start + BYTES_AT_ONCE)
                end = end if end >= 0 else len(raw)
            if held and size + end - start > BYTES_AT_ONCE:
                yield joined()
                held, size = [], 0
            held.append((at, number, raw[start:end]))
            size += end - start
            number += raw.count(b"\n", start, end) + 1
            start = end + 1
    if held:
        yield joined()


def tokens(line: bytes, width: int = WIDTH) -> np.ndarray:
    """The set of a line's tokens, sorted; none if it has fewer than ``width`` words."""
    return np.unique(_runs(line, width)[0])


def prefix_size(size, similarity: float = SIMILARITY):
    return size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1


def token_rarity(docs: DataFrame, text: str = "text", width: int = WIDTH, short: bool = False) -> np.ndarray:
    """Of each slot the logarithm of how often its tokens occur, in eighths; a table of fixed size."""

    def slots(texts: list[str | None]) -> Iterator[np.ndarray]:
        for _, _, data in _chunks(texts):
            yield (_runs(data, width, short)[0] % SLOTS).astype(np.int64)

    def rarity(counts: np.ndarray) -> np.ndarray:
        return np.minimum(8 * np.log2(1.0 + counts), (1 << _RARITY_BITS) - 1)

    return slot_counts(docs, text, slots, SLOTS, rarity, np.uint8)


def _sets(
    data: bytes, width: int, rarity: np.ndarray | None, short: bool = False
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The tokens of lines, by line, rarity and hash, each once in a line, and where lines begin.

    Some lines at a time, with the number of the first.
    """
    own, line = _runs(data, width, short)
    n_lines = data.count(b"\n") + 1
    for low in range(0, n_lines, LINES_AT_ONCE):
        high = min(low + LINES_AT_ONCE, n_lines)
        part = slice(*np.searchsorted(line, [low, high]))
        key = (line[part] - low).astype(np.uint64) << _LINE_SHIFT | own[part]
        if rarity is not None:
            key |= rarity[(own[part] % SLOTS).astype(np.int64)].astype(np.uint64) << np.uint64(_TOKEN_BITS)
        key.sort()
        key = key[np.concatenate((key[:1] == key[:1], key[1:] != key[:-1]))]
        yield low, key, np.searchsorted(key, np.arange(high - low + 1, dtype=np.uint64) << _LINE_SHIFT)


def _sets_of(texts: list[str | None], width: int, rarity: np.ndarray | None, short: bool = False) -> Iterator[tuple]:
    for at, number, data in _chunks(texts):
        for low, key, starts in _sets(data, width, rarity, short):
            yield at, number, low, key, starts


def _line_sets(docs: DataFrame, doc_id: str, text: str, width: int, similarity: float, short: bool) -> DataFrame:
    """(doc_id, line, set, size, prefix) of every line that has tokens; ``prefix`` is in order of rarity. Staged."""
    rarity = docs.sparkSession.sparkContext.broadcast(token_rarity(docs, text, width, short))
    below = (np.uint64(1) << _LINE_SHIFT) - np.uint64(1)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, number, digest, size, first = [], [], [], [], [np.zeros(0, np.int64)]
        for text_at, line_at, low, key, starts in _sets_of(batch.column(1).to_pylist(), width, rarity.value, short):
            key &= below
            sizes = np.diff(starts)
            place = np.arange(len(key)) - np.repeat(starts[:-1], sizes)
            head = np.repeat(prefix_size(sizes, similarity), sizes)
            first.append((key[place < head] & _TOKEN).view(np.int64))
            own = np.flatnonzero(sizes)
            at += text_at[low + own].tolist()
            number += line_at[low + own].tolist()
            size += sizes[own].tolist()
            data, ends = memoryview(key.tobytes()), (8 * starts).tolist()
            digest += [hashlib.md5(data[ends[i] : ends[i + 1]]).digest() for i in own.tolist()]
        sizes = np.array(size, dtype=np.int64)
        ends = np.concatenate(([0], np.cumsum(prefix_size(sizes, similarity)))).astype(np.int32)
        columns = [
            batch.column(0).take(pa.array(at, pa.int64())),
            pa.array(number, pa.int32()),
            pa.array(digest, pa.binary()),
            pa.array(sizes, pa.int32()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first))),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "line", "set", "size", "prefix"])

    known = docs.filter(F.col(doc_id).isNotNull())
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, line int, set binary, size int, prefix array<long>"
    return _released(staged(in_batches(known, [doc_id, text], step, schema), "lines"), rarity)


def _released(df: DataFrame, *shared: Broadcast) -> DataFrame:
    """``df``, which is staged, so that the tables it was made with are no longer needed."""
    for table in shared:
        table.destroy()
    return df


def _can_overlap(similarity: float) -> Column:
    """Whether the sizes and places of a common token leave room for the overlap needed (sides a and b)."""
    need = similarity / (1 + similarity)
    room = 1 + F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place")) - 1
    return (
        (F.col("a.size") >= similarity * F.col("b.size") - 1e-9)
        & (F.col("b.size") >= similarity * F.col("a.size") - 1e-9)
        & (room >= need * (F.col("a.size") + F.col("b.size")) - 1e-9)
    )


def _earlier() -> Column:
    """Whether side a stands before side b."""
    return (F.col("a.doc_id") < F.col("b.doc_id")) | (
        (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.line") < F.col("b.line"))
    )


def _pairs(a: DataFrame, b: DataFrame, similarity: float) -> DataFrame:
    found = a.alias("a").join(b.alias("b"), F.col("a.token") == F.col("b.token"))
    found = found.filter(_can_overlap(similarity) & _earlier())
    return found.select(
        F.col("a.doc_id").alias("doc_a"), F.col("a.line").alias("line_a"), F.col("b.doc_id").alias("doc_b"), F.col("b.line").alias("line_b")
    ).distinct()


def _verified(
    pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, width: int, similarity: float, short: bool
) -> DataFrame:
    """Those of ``pairs`` whose whole token sets are similar, with their similarity. Token sets are staged."""
    ends = [pairs.select(F.col(f"doc_{s}").alias("doc_id"), F.col(f"line_{s}").alias("line")) for s in "ab"]
    asked = staged(ends[0].union(ends[1]).distinct(), "asked")
    n_bits = bits_for(asked.count())
    of_doc = F.xxhash64("doc_id").bitwiseAND(F.lit(n_bits - 1)).cast("int")
    both = (F.col("slot") + F.col("line") * LINE_STEP).bitwiseAND(F.lit(n_bits - 1)).cast("int")
    slots = asked.select(of_doc.alias("slot"), F.col("line").cast("long").alias("line"))
    docs_asked, lines_asked = (bit_table(slots.select(c.alias("slot")), n_bits) for c in (F.col("slot"), both))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        slot = batch.column(2).to_numpy()
        wanted = np.flatnonzero(is_set(docs_asked.value, slot))
        at, number, sets = [], [], []
        texts = [batch.column(1)[int(i)].as_py() for i in wanted]
        for text_at, line_at, low, key, starts in _sets_of(texts, width, None, short):
            key = (key & _TOKEN).view(np.int64)
            own = np.flatnonzero(np.diff(starts))
            of_line = slot[wanted[text_at[low + own]]].astype(np.int64) + line_at[low + own] * LINE_STEP
            own = own[is_set(lines_asked.value, of_line & (n_bits - 1))]
            at += wanted[text_at[low + own]].tolist()
            number += line_at[low + own].tolist()
            sets += [key[starts[i] : starts[i + 1]] for i in own.tolist()]
        columns = [
            batch.column(0).take(pa.array(at, pa.int64())),
            pa.array(number, pa.int32()),
            pa.array(sets, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "line", "tokens"])

    kind = docs.schema[doc_id].dataType.simpleString()
    known = docs.filter(F.col(doc_id).isNotNull())
    columns = [F.col(doc_id), F.col(text), F.xxhash64(doc_id).bitwiseAND(F.lit(n_bits - 1)).cast("int").alias("slot")]
    sent = in_batches(known, columns, step, f"doc_id {kind}, line int, tokens array<long>")
    sets = staged(sent.join(asked, ["doc_id", "line"], "left_semi"), "sets")
    _released(sets, docs_asked, lines_asked)
    out = pairs
    for s in "ab":
        side = sets.select(F.col("doc_id").alias(f"doc_{s}"), F.col("line").alias(f"line_{s}"), F.col("tokens").alias(s))
        out = out.join(side, [f"doc_{s}", f"line_{s}"])
    common = F.size(F.array_intersect("a", "b"))
    jaccard = common / (F.size("a") + F.size("b") - common)
    return out.select("doc_a", "line_a", "doc_b", "line_b", jaccard.alias("jaccard")).filter(
        F.col("jaccard") >= similarity - 1e-9
    )


def _postings(firsts: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, line, size, place, token, sets) of the prefix tokens that are in ``counts``. Staged."""
    n_bits = bits_for(counts.count())
    slot = F.col("token").bitwiseAND(F.lit(n_bits - 1)).cast("int")
    table = bit_table(counts.select(slot.alias("slot")), n_bits)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(3)
        token = lists.flatten().to_numpy()
        sizes = lists.value_lengths().to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        kept = np.flatnonzero(is_set(table.value, token & (n_bits - 1)))
        at = pa.array(row[kept])
        columns = [batch.column(i).take(at) for i in range(3)]
        columns += [pa.array(place[kept].astype(np.int32)), pa.array(token[kept])]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "line", "size", "place", "token"])

    kind = firsts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, line int, size int, place int, token long"
    sent = in_batches(firsts, ["doc_id", "line", "size", "prefix"], step, schema, rows=10_000)
    return _released(staged(sent.join(counts, "token"), "postings"), table)


def text_hash(text: str) -> Column:
    """What tells rows of one doc_id apart."""
    return F.xxhash64(F.col(text))


def later_matches(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    similarity: float = SIMILARITY,
    group: int = GROUP,
    short: bool = False,
) -> DataFrame:
    """(doc_id, line): every line that an earlier one is similar to; ``doc_id`` is a struct of the id and the text's hash."""
    key = F.struct(F.col(doc_id).alias("id"), text_hash(text).alias("hash"))
    docs = docs.filter(F.col(doc_id).isNotNull()).select(key.alias("doc_id"), F.col(text).alias("text"))
    doc_id, text = "doc_id", "text"
    of_lines = _line_sets(docs, doc_id, text, width, similarity, short)
    first = F.min(F.struct("doc_id", "line", "size", "prefix")).alias("f")
    firsts = staged(of_lines.groupBy("set").agg(first).select("set", "f.*"), "firsts")
    told = of_lines.select("set", "doc_id", "line").join(
        firsts.select("set", F.struct("doc_id", "line").alias("first")), "set"
    )
    copies = told.filter(F.struct("doc_id", "line") != F.col("first")).select("doc_id", "line")
    counts = firsts.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("sets"))
    counts = staged(counts.filter("sets > 1"), "tokens")
    shared = _postings(firsts, counts)
    few, many = shared.filter(F.col("sets") <= group), shared.filter(F.col("sets") > group)
    leaders = many.groupBy("token").agg(F.min(F.struct("doc_id", "line", "size", "place")).alias("l")).select("token", "l.*")
    near = staged(_pairs(few, few, similarity).union(_pairs(leaders, many, similarity)).distinct(), "pairs")
    ids = [F.col("doc_b").alias("doc_id"), F.col("line_b").alias("line")]
    found = staged(_verified(near, docs, doc_id, text, width, similarity, short).select(*ids).distinct(), "found")
    rest = many.join(found, ["doc_id", "line"], "left_anti")
    more = staged(_pairs(many, rest, similarity), "pairs")
    if not more.isEmpty():
        found = found.union(_verified(more, docs, doc_id, text, width, similarity, short).select(*ids))
    return copies.union(found).distinct()


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, lines, text_hash): the sorted numbers of the lines to remove, for rows that have any."""
    found = later_matches(docs, doc_id, text, **options)
    found = found.groupBy("doc_id").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    return found.select(F.col("doc_id.id").alias("doc_id"), "lines", F.col("doc_id.hash").alias("text_hash"))


def drop_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the lines that an earlier one is similar to; columns and rows stay."""
    found = staged(removed_lines(docs, doc_id, text, **options), "removed")
    rows = docs.select(
        F.col(doc_id).alias("key"), text_hash(text).alias("text_hash"), F.struct(*docs.columns).alias("row")
    )
    marked = rows.join(found.withColumnRenamed("doc_id", "key"), ["key", "text_hash"], "left").select("row", "lines")
    schema, at = docs.schema, docs.columns.index(text)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = batch.column(0).flatten()
        kept = []
        for value, gone in zip(columns[at].to_pylist(), batch.column(1).to_pylist(), strict=True):
            if gone and value is not None:
                gone = set(gone)
                value = "\n".join(x for i, x in enumerate(value.split("\n")) if i not in gone)
            kept.append(value)
        columns[at] = pa.array(kept, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return in_batches(marked, ["row", "lines"], step, schema)
