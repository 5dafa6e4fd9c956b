"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit set where over half of the hashes of a text's word shingles have it. Two
fingerprints at 2 or fewer differing bits are linked; a text's component is the smallest doc_id
that links reach.

Search: a fingerprint is kept in two tables, one for each 32-bit half. If two fingerprints differ
in at most two bits, their upper halves differ in at most one bit or their lower halves are equal.
So each fingerprint looks up the 33 values of the Hamming ball of radius 1 around its upper half
and the value of its lower half, and full distances are verified.

A table entry with many different fingerprints (large groups of near copies share a half) is not
expanded into pairs. Fingerprints that look such an entry up are linked through midpoints: two
values differ in at most two bits exactly when a third is within one bit of both. Each emits the
65 values within one bit of it; at most 65 fingerprints meet at a value, any two of them linked.

Contract. Null and empty texts have fingerprint zero. Rows with equal doc_id are separate rows. A
null doc_id is never a component's id unless all its rows have none. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.session import staged

from .common import in_batches, whole_text
from .components import components

SHINGLE = 3
SEED = 42
HALF = 32
#: Different fingerprints in a table entry beyond which midpoints replace pairs.
CROWDED = 16

_LOW = np.uint64(0x0101010101010101)


def bit_majority(hashes: np.ndarray) -> int:
    """The 64-bit number with the bits that over half of ``hashes`` have."""
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        blocks = np.zeros((-(-len(part) // 255)) * 255, dtype=np.uint64)
        blocks[: len(part)] = part
        blocks = blocks.reshape(-1, 255)
        for shift in range(8):
            # Eight byte-wide counters a word: bit ``shift`` of each byte, up to 255 a block.
            sums = ((blocks >> np.uint64(shift)) & _LOW).sum(axis=1, dtype=np.uint64)
            counts[shift::8] += sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > len(hashes)))


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of ``text``: A-Z lower-cased, words split at ASCII white space, shingles with repeats."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    n = max(1, len(words) - width + 1)
    return bit_majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a long."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return in_batches(docs, [F.col(doc_id), whole_text(text)], step, f"doc_id {kind}, fp long")


def _flipped(column: str, bits: int):
    """``column`` and every value that differs from it in one of its lowest ``bits`` bits."""
    masks = [F.lit(0).cast("long")] + [F.shiftleft(F.lit(1).cast("long"), i) for i in range(bits)]
    return F.explode(F.transform(F.array(*masks), lambda m: F.col(column).bitwiseXOR(m)))


def links(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Edges (a, b) between different values of ``fps`` (fp) whose components are those of all links.

    Pairs of linked values are returned themselves unless they meet in a crowded entry; there a
    value is tied to the smallest one it shares a midpoint with.
    """
    halves = fps.select(
        "fp",
        F.shiftrightunsigned("fp", HALF).alias("upper"),
        F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1)).alias("lower"),
    )
    lower = halves.select("fp", F.lit(1).alias("half"), F.col("lower").alias("entry"))
    entries = halves.select("fp", F.lit(0).alias("half"), F.col("upper").alias("entry")).union(lower)
    lookups = halves.select("fp", F.lit(0).alias("half"), _flipped("upper", HALF).alias("entry")).union(lower)
    full = entries.groupBy("half", "entry").count().filter(F.col("count") > crowded).select("half", "entry")
    full = staged(full, "crowded")
    few = entries.join(full, ["half", "entry"], "left_anti").withColumnRenamed("fp", "b")
    pairs = (
        lookups.withColumnRenamed("fp", "a")
        .join(few, ["half", "entry"])
        .filter("a < b AND bit_count(a ^ b) <= 2")
        .select("a", "b")
    )
    close = lookups.join(full, ["half", "entry"], "left_semi").select("fp").distinct()
    meet = close.select("fp", _flipped("fp", 64).alias("midpoint"))
    ties = meet.join(meet.groupBy("midpoint").agg(F.min("fp").alias("a")), "midpoint")
    return pairs.union(ties.filter("a <> fp").select("a", F.col("fp").alias("b")))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, crowded: int = CROWDED
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    of_docs = staged(fingerprints(docs, doc_id, text, width), "fingerprints")
    values = staged(of_docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "values")
    roots = components(links(values.select("fp"), crowded))
    rooted = values.join(roots, values["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return of_docs.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose component has an earlier row, by doc_id and a hash of the text.

    Rows that share a doc_id and a text are one document and stay or go together. Rows with a null
    doc_id stay: nothing tells which of them is first.
    """
    key = F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"))
    keyed = docs.select(F.when(F.col(doc_id).isNotNull(), key).alias("row_key"), F.col(text).alias("text"))
    found = near_duplicates(keyed, "row_key", "text")
    late = found.filter("doc_id > component_id").select("doc_id.*").distinct()
    same = (docs[doc_id] == late["id"]) & (F.xxhash64(docs[text]) == late["hash"])
    return docs.join(late, same, "left_anti")
