"""What the operators of this package share: tables, whole-text columns, batches, staged copies."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows that a Python step works on at once, whatever the size of the Arrow batch it gets.
ROWS_AT_ONCE = 256
#: Numbers in a block of a table that tasks fill and add up.
BLOCK = 1 << 16
BLOCKS_SCHEMA = "block int, part binary"
#: Bits of a bit table for each name asked for, at least and at most. It spares shuffles what nobody asks for;
#: where it fills up, more is sent than needed and the joins sort it out.
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 27
#: Bits of a bit table that a task fills as one.
BLOCK_BITS = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def in_batches(
    df: DataFrame,
    columns: Sequence[str | Column],
    step: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | StructType,
    rows: int = ROWS_AT_ONCE,
) -> DataFrame:
    """Apply ``step`` to small Arrow batches of the chosen columns, partition by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield step(batch.slice(start, rows))

    return df.select(*columns).mapInArrow(run, schema)


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    out = np.ones(n, dtype=np.uint64)
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    return out


_BASE = 0x9E3779B97F4A7C15
#: A number for each byte, so that a string's hash is a polynomial with these as coefficients.
BYTE = powers(0xD6E8FEB86659FD93, 257)[1:] ^ np.uint64(0xA0761D6478BD642F)
_tables: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of a base and of its inverse."""
    if not _tables or len(_tables[0]) < n:
        size = max(n, 1 << 18)
        _tables[:] = [powers(_BASE, size), powers(pow(_BASE, -1, 1 << 64), size)]
    return _tables[0], _tables[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread values over all bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\v\f\r")] = True


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in some bytes (runs without ASCII white space), and where they begin."""
    space = np.concatenate(([True], _SPACE[data], [True]))
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    up, down = power_tables(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * up[: len(data)], dtype=np.uint64)))
    return mixed((sums[ends] - sums[starts]) * down[starts]), starts


def summed(
    parts: DataFrame,
    dtype: type,
    out: type = np.float64,
    then: Callable[[np.ndarray], np.ndarray] = lambda sums: sums,
) -> dict[int, np.ndarray]:
    """Sums by block, returned as ``out``, of ``parts`` (block int, part binary of ``dtype``), added up as they stream by.

    There are as many blocks as the caller made, each of fixed size, so the driver gets a bounded table. What
    ``then`` makes of the sums is made in the tasks.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.frombuffer(part.as_buffer(), dtype=dtype).astype(np.float64)
                sums[block] = sums[block] + values if block in sums else values
        yield blocks({block: then(values) for block, values in sums.items()}, out)

    return {b: np.frombuffer(p, dtype=out) for b, p in parts.repartition("block").mapInArrow(add, BLOCKS_SCHEMA).collect()}


def blocks(parts: dict[int, np.ndarray], dtype: type) -> pa.RecordBatch:
    names = sorted(parts)
    values = [parts[b].astype(dtype).tobytes() for b in names]
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(values, pa.binary())], ["block", "part"])


def counted(found: list[np.ndarray], n_slots: int) -> np.ndarray:
    """How often each of ``n_slots`` slots is in ``found``."""
    return np.bincount(np.concatenate([*found, np.zeros(0, np.int64)]), minlength=n_slots).astype(np.uint32)


def slot_counts(
    docs: DataFrame,
    text: str,
    slots: Callable[[list[str | None]], Iterator[np.ndarray]],
    n_slots: int,
    then: Callable[[np.ndarray], np.ndarray] = lambda counts: counts,
    out: type = np.int64,
) -> np.ndarray:
    """How often each of ``n_slots`` slots comes out of ``slots(texts)``, over all rows, some at a time.

    With ``then`` what it makes of the counts, in the tasks, so that the driver gets no more than ``out`` needs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task sees fewer than 2**32 of anything.
        total = np.zeros(n_slots, dtype=np.uint32)
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                for found in slots(batch.column(0).slice(start, ROWS_AT_ONCE).to_pylist()):
                    held.append(found)
                    size += len(found)
                    # As many as there are slots are counted at once.
                    if size >= n_slots:
                        total += counted(held, n_slots)
                        held, size = [], 0
        total += counted(held, n_slots)
        yield blocks({i: total[at : at + BLOCK] for i, at in enumerate(range(0, n_slots, BLOCK))}, np.uint32)

    sums = summed(docs.select(text).mapInArrow(count, BLOCKS_SCHEMA), np.uint32, out, then)
    sizes = [min(BLOCK, n_slots - at) for at in range(0, n_slots, BLOCK)]
    return np.concatenate([sums[i] if i in sums else then(np.zeros(n)).astype(out) for i, n in enumerate(sizes)])


def is_set(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def bits_for(asked: int) -> int:
    """How many bits a table for ``asked`` names has: a power of two, more for more names up to MOST_BITS."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * asked).bit_length()))


def bit_table(slots: DataFrame, n_bits: int) -> Broadcast:
    """A table of ``n_bits`` bits (a power of two, 8 or more) with those of ``slots`` (slot) set, filled block by block in tasks."""
    size = min(BLOCK_BITS, n_bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(1).to_numpy()
            for block in np.unique(slot // size):
                own = slot[slot // size == block] % size
                bits = held.setdefault(int(block), np.zeros(size // 8, dtype=np.uint8))
                np.bitwise_or.at(bits, own >> 3, (1 << (own & 7)).astype(np.uint8))
        yield blocks(held, np.uint8)

    keyed = slots.select((F.col("slot") / size).cast("int").alias("block"), "slot").distinct()
    bits = np.zeros(n_bits // 8, dtype=np.uint8)
    for block, part in keyed.repartition("block").mapInArrow(fill, BLOCKS_SCHEMA).collect():
        bits[block * size // 8 : (block + 1) * size // 8] = np.frombuffer(part, dtype=np.uint8)
    return slots.sparkSession.sparkContext.broadcast(bits)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, also where it isn't installed on them."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parents[2]
    if getattr(context, "_marquetry_shipped", False) or str(root) in os.environ.get("PYTHONPATH", "").split(":"):
        return
    # Spark's own file server hands the archive to the executors.
    archive = f"{tempfile.mkdtemp(prefix='marquetry-')}/marquetry.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.glob("marquetry/**/*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(archive)
    context._marquetry_shipped = True
