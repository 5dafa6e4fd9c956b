"""Removal of long byte strings that occur more than once, by run-length BWT indexes.

Every byte covered by a LENGTH-byte string that also starts anywhere else is removed; strings are
judged on the input and never cross texts.

1. Texts are told apart by digest; equal ones are one text. One that occurs twice is covered whole.
2. Each start of a LENGTH-byte string has an anchor: the place of the least hash of the ANCHOR-byte
   strings in it. Equal strings have equal anchors, so strings are compared with strings of the same
   anchor only. The starts that share an anchor place stand in a row; their strings make a context.
3. Contexts are counted by digest before anything is gathered. A context that occurs twice is
   covered whole. Only contexts that share their anchor with other contexts need their bytes.
4. These go into indexes by anchor, a bounded number of bytes at a time. An index is the run-length
   compressed Burrows-Wheeler transform of the contexts with the places of run ends. At a run's end
   the longest match with the neighbour is found by comparison; along the text it falls by one a
   byte until the next run end, so one pass streams the matching statistics of all places. Places
   with LENGTH or more are marked.
5. Contexts of an anchor with more than CROWDED different ones are not gathered. Laid over each other
   at their anchors, equal strings start at one offset. Offsets are cut into blocks: if no other context
   has the bytes that all strings of a block share, none of them is repeated; if another has all
   their bytes, all are. Other blocks are cut into SPLIT parts, down to single starts; so is one of those that
   are equal, for others that share some of its strings. Both are counted by digest, with counts combined before
   the shuffle.

Contract. A null text is empty; texts shorter than LENGTH lose bytes never. Rows with equal ids are
rows of their own. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.session import scratch_path, staged

from .common import BYTE, in_batches, mixed, power_tables, whole_text

LENGTH = 400
ANCHOR = 64
#: Different contexts of an anchor beyond which strings are counted rather than indexed.
CROWDED = 256
#: Parts of a block of starts that is neither repeated as a whole nor alone.
SPLIT = 4
#: Bytes of contexts in one index.
INDEX_BYTES = 4 << 20
#: Starts of strings that are anchored at once; a long text goes through in overlapping parts.
STARTS_AT_ONCE = 1 << 18

_BITS = 20


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each ``width``-byte string of ``data``, equal for equal strings."""
    up, down = power_tables(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * up[: len(data)], dtype=np.uint64)))
    return mixed((sums[width:] - sums[:-width]) * down[: len(data) - width + 1])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, length: int = LENGTH, width: int = ANCHOR) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, first start, last start) of the rows of starts that share an anchor, part by part.

    Of equal hashes in a string the first counts. A row that a part's border cuts is two rows.
    """
    low = np.uint64((1 << _BITS) - 1)
    for at in range(0, len(data) - length + 1, STARTS_AT_ONCE):
        part = data[at : at + STARTS_AT_ONCE + length - 1]
        hashes = window_hashes(part, width)
        placed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        place = (_sliding_least(placed, length - width + 1) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((first[1:], [len(place)])) - 1
        yield hashes[place[first]].view(np.int64), first + at, last + at, place[first] + at


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of ``text`` in the order of their suffixes, by doubling; its last number is unique."""
    n, bits = len(text), int(text.max() + 1).bit_length()
    step = 62 // bits
    key = np.zeros(n, dtype=np.int64)
    for i in range(step):
        key <<= bits
        key[: max(0, n - i)] += text[i:] + 1
    order = np.argsort(key, kind="stable")
    while True:
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        # Rank of a place and of the one ``step`` on, as one number.
        key = rank * (n + 1)
        key[: max(0, n - step)] += rank[step:] + 1
        order = order[np.argsort(key[order], kind="stable")]
        step *= 2


class RunLengthIndex:
    """A run-length compressed Burrows-Wheeler transform with the places of its run ends."""

    def __init__(self, text: np.ndarray):
        """``text``: numbers, with one that occurs nowhere else after each of the joined strings."""
        self.text = text
        order = _suffix_order(text)
        before = text[order - 1]
        breaks = np.flatnonzero(before[1:] != before[:-1]) + 1
        heads, tails = np.concatenate(([0], breaks)), np.concatenate((breaks, [len(text)])) - 1
        self.letters, self.lengths = before[heads], tails - heads + 1
        # Where a run begins or ends, the place there and its neighbour's place.
        self.ends = np.concatenate((order[heads[1:]], order[tails[:-1]]))
        self.neighbours = np.concatenate((order[heads[1:] - 1], order[tails[:-1] + 1]))

    def _match(self, most: int) -> np.ndarray:
        """Lengths of the matches at run ends with their neighbours, up to ``most``."""
        n, size = len(self.text), np.zeros(len(self.ends), dtype=np.int64)
        open_at = np.arange(len(self.ends))
        a, b = self.ends.copy(), self.neighbours.copy()
        while len(open_at):
            inside = np.maximum(a, b) < n
            open_at, a, b = open_at[inside], a[inside], b[inside]
            same = self.text[a] == self.text[b]
            open_at, a, b = open_at[same], a[same] + 1, b[same] + 1
            size[open_at] += 1
            go_on = size[open_at] < most
            open_at, a, b = open_at[go_on], a[go_on], b[go_on]
        return size

    def statistics(self, most: int) -> np.ndarray:
        """For each place the longest match that starts elsewhere, exact below ``most``.

        Away from run ends a match is one shorter than that of the place before.
        """
        reach = np.zeros(len(self.text), dtype=np.int64)
        np.maximum.at(reach, self.ends, self.ends + self._match(most))
        return np.maximum.accumulate(reach) - np.arange(len(self.text))


def repeated_starts(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Of each context the starts of ``length``-byte strings that start elsewhere in ``contexts`` too."""
    sizes = np.array([len(c) for c in contexts])
    text = np.zeros(int(sizes.sum()) + len(contexts), dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    text[:] = -1
    text[ends - 1] = 256 + np.arange(len(contexts))
    text[text < 0] = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    # A place's match can grow past the cut at ``most`` only where it is long enough anyway.
    found = RunLengthIndex(text).statistics(int(sizes.max()) + 1) >= length
    return [np.flatnonzero(found[e - s - 1 : e - length]) for e, s in zip(ends, sizes, strict=True)]


def _runs(starts: np.ndarray) -> list[dict[str, int]]:
    """Runs of following numbers as first and last."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return [
        {"first": int(a), "last": int(b)}
        for a, b in zip(starts[np.concatenate(([0], cut + 1))], starts[np.concatenate((cut, [len(starts) - 1]))], strict=True)
    ]


_RUNS = "array<struct<first: long, last: long>>"
_ARROW_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _anchored(texts: DataFrame, length: int) -> DataFrame:
    """(key, anchor, context, first, last): the rows of starts of every text, with a digest of their bytes."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, hashes, digests, firsts, lasts = [], [], [], [], []
        for i, text in enumerate(batch.column(1)):
            raw = text.as_py().encode()
            view = memoryview(raw)
            for anchor, first, last, _ in anchors(np.frombuffer(raw, dtype=np.uint8), length):
                at.append(np.full(len(anchor), i))
                hashes.append(anchor)
                firsts.append(first)
                lasts.append(last)
                digests += [_digest(view[a : b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        flat = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (at, hashes, firsts, lasts)]
        columns = [
            batch.column(0).take(pa.array(flat[0])),
            pa.array(flat[1]),
            pa.array(digests, pa.binary()),
            pa.array(flat[2]),
            pa.array(flat[3]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "context", "first", "last"])

    long_enough = texts.filter(F.octet_length("text") >= length)
    return in_batches(
        long_enough, ["key", "text"], step, "key binary, anchor long, context binary, first long, last long"
    )


def _with_bytes(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (key, first, last and more) with the bytes of its contexts."""
    joined = wanted.join(texts.select("key", "text"), "key")
    more = [f for f in wanted.schema if f.name not in ("key", "first", "last")]
    names = [f.name for f in more]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in more] + ["bytes binary"])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        places = [batch.column(c).to_pylist() for c in ("first", "last")]
        cut = [t.as_py().encode()[a : b + length] for t, a, b in zip(batch.column("text"), *places, strict=True)]
        columns = [batch.column(n) for n in names] + [pa.array(cut, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[*names, "bytes"])

    return in_batches(joined, joined.columns, step, schema)


def _indexed(contexts: DataFrame, length: int, index_bytes: int) -> DataFrame:
    """(anchor, context, runs): repeated starts of contexts (anchor, context, bytes), by indexes."""
    size = contexts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    partitions = max(1, -(-size // index_bytes))
    dealt = contexts.repartition(partitions, "anchor").sortWithinPartitions("anchor")

    def of(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_starts([r[2] for r in rows], length)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.binary()),
                pa.array([_runs(f) for f in found], _ARROW_RUNS),
            ],
            names=["anchor", "context", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                # Contexts of one anchor stay together.
                if size >= index_bytes and row[0] != held[-1][0]:
                    yield of(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield of(held)

    return dealt.select("anchor", "context", "bytes").mapInArrow(run, f"anchor long, context binary, runs {_RUNS}")


def _blocks(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """(anchor, context, block, first, last, core, hull): blocks of ``width`` starts of each of ``contexts``.

    ``contexts`` has (anchor, context, bytes, blocks); of the last, blocks of SPLIT times the width, the parts are made,
    of null all blocks. Starts are counted from the context's begin. Core and hull are digests of the block with the
    bytes that its strings all have, and with all bytes of its strings that are in this context.
    """
    most = length - ANCHOR
    low_bits = np.uint64((1 << _BITS) - 1)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, out = [], []
        columns = (batch.column(c).to_pylist() for c in ("anchor", "bytes", "blocks"))
        for i, (anchor, data, asked) in enumerate(zip(*columns, strict=True)):
            hashes = window_hashes(np.frombuffer(data, dtype=np.uint8, count=length), ANCHOR)
            # Offsets are those of starts before the anchor, the earliest possible one is 0.
            low = most - int(np.argmin(hashes & ~low_bits))
            high = low + len(data) - length
            chosen = range(low // width, high // width + 1)
            if asked is not None:
                chosen = [b for a in asked for b in range(a * SPLIT, (a + 1) * SPLIT) if b in chosen]
            for block in chosen:
                begin, end = block * width, (block + 1) * width - 1
                first, last = max(begin, low), min(end, high)
                name = b"%d %d " % (anchor, block)
                core = _digest(name + data[end - low : begin + length - low])
                hull = _digest(b"%s%d %d " % (name, first, last) + data[first - low : last + length - low])
                at.append(i)
                out.append((block, first - low, last - low, core, hull))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("anchor", "context")]
        columns += [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "context", "block", "first", "last", "core", "hull"])

    schema = "anchor long, context binary, block int, first long, last long, core binary, hull binary"
    return in_batches(contexts, ["anchor", "context", "bytes", "blocks"], step, schema)


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """(anchor, context, runs) as ``_indexed`` has them, by counting digests of blocks of starts.

    Counts combine before the shuffle, so what many contexts have is a few rows. The join with the counts is a plain
    one, whose hot keys adaptive execution splits. Blocks on the border of what contexts share are cut further.
    """
    contexts = contexts.select("anchor", "context", "bytes")
    widths = [1]
    while widths[0] * SPLIT <= length - ANCHOR + 1:
        widths.insert(0, widths[0] * SPLIT)
    left, decided = contexts.withColumn("blocks", F.lit(None).cast("array<int>")), []
    for width in widths:
        every = staged(_blocks(left, length, width), "blocks")
        kinds = every.groupBy("core", "hull").agg(F.count("*").alias("times"), F.min("context").alias("one"))
        shared = kinds.groupBy("core").agg(F.sum("times").alias("sharing"), F.count("*").alias("hulls")).filter("sharing > 1")
        known = kinds.join(shared, "core").select("hull", "one", (F.col("times") > 1).alias("whole"), (F.col("hulls") > 1).alias("mixed"))
        judged = every.drop("core").join(known, "hull").withColumn("cut", F.expr("mixed AND (NOT whole OR context = one)"))
        judged = staged(judged.select("anchor", "context", "block", "first", "last", "whole", "cut"), "judged")
        decided.append(judged.filter("whole").select("anchor", "context", F.struct("first", "last").alias("run")))
        rest = judged.filter("cut")
        # A block of one start has one string: it is repeated as a whole or alone.
        if width == 1 or rest.isEmpty():
            break
        left = contexts.join(rest.groupBy("anchor", "context").agg(F.collect_list("block").alias("blocks")), ["anchor", "context"])
    # Runs that touch are merged where bytes are removed.
    found = reduce(DataFrame.unionByName, decided)
    return found.groupBy("anchor", "context").agg(F.collect_list("run").alias("runs"))


def _kept(texts: DataFrame, spans: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) and the kept bytes if asked for."""
    joined = texts.join(spans, "key", "left").select("key", "rows", "text", "spans")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("rows", "text", "spans"))
        for rows, text, found in zip(*columns, strict=True):
            data = text.encode()
            if rows > 1 and len(data) >= length:
                found = [{"first": 0, "last": len(data)}]
            merged: list[list[int]] = []
            for first, last in sorted((s["first"], s["last"]) for s in found or ()):
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], last)
                else:
                    merged.append([first, last])
            kept, at = [], 0
            for first, last in merged:
                kept.append(data[at:first])
                at = last
            left = b"".join([*kept, data[at:]])
            row = (len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest())
            out.append((*row, left) if with_bytes else row)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_bytes
        found = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *found], names=names)

    names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes
    schema = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return in_batches(joined, joined.columns, step, schema)


def _bucketed(df: DataFrame, key: str, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder in buckets by ``key``, so that joins by it move the other side only.

    Buckets are known from the catalogue alone; the second result is the table's name there, to be dropped.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"marquetry_{path.rsplit('-', 1)[-1]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).option("compression", "zstd").saveAsTable(table)
    return spark.table(table), table


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    crowded: int = CROWDED,
    index_bytes: int = INDEX_BYTES,
    with_bytes: bool = False,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), and the kept bytes if asked for, by row."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    keyed = keyed.withColumn("key", F.unhex(F.md5("text")))
    whole = keyed.groupBy("key").agg(F.count("*").alias("rows"), F.first("text").alias("text"))
    texts, table = _bucketed(whole, "key", "texts")
    placed = staged(_anchored(texts, length), "anchors")
    # Counts are staged before they are joined: a join of two shuffles and nothing else is one whose hot keys Spark splits.
    again = staged(placed.groupBy("anchor").count().filter("count > 1").select("anchor"), "again")
    placed = staged(placed.join(again, "anchor"), "repeated")
    contexts = placed.groupBy("anchor", "context").agg(
        F.count("*").alias("times"), F.min(F.struct("key", "first", "last")).alias("one")
    )
    contexts = staged(contexts, "contexts")
    kinds = staged(contexts.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "kinds")
    # Contexts that occur twice are decided, yet others may share strings with them.
    wanted = contexts.join(kinds, "anchor").select("anchor", "context", "kinds", "one.*")
    cut = staged(_with_bytes(texts, wanted, length), "bytes")
    found = _indexed(cut.filter(F.col("kinds") <= crowded), length, index_bytes).unionByName(
        _counted(cut.filter(F.col("kinds") > crowded), length)
    )
    found = staged(found, "found")
    every = F.array(F.struct(F.lit(0).cast("long").alias("first"), (F.col("one.last") - F.col("one.first")).alias("last")))
    decided = contexts.join(found, ["anchor", "context"], "left").select(
        "anchor", "context", F.when(F.col("times") > 1, every).otherwise(F.col("runs")).alias("runs")
    )
    decided = staged(decided.filter(F.size("runs") > 0), "decided")
    spans = (
        placed.join(decided, ["anchor", "context"])
        .select(
            "key",
            F.transform(
                "runs",
                lambda r: F.struct(
                    (F.col("first") + r["first"]).alias("first"), (F.col("first") + r["last"] + length).alias("last")
                ),
            ).alias("spans"),
        )
        .groupBy("key")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )
    kept = staged(_kept(texts, spans, length, with_bytes), "kept")
    # Its name is given back; its files stay with the other copies.
    docs.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    return keyed.select("doc_id", "key").join(kept, "key").drop("key")
