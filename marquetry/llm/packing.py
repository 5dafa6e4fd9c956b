"""Packing of tokenised documents into sequences by bounded-space online best-fit.

Each task packs the documents of its partition as they come, without a shuffle. It holds a fixed
number of open bins. A bit set has a bit for each amount of free space that an open bin has, so the
tightest bin that takes a piece is the lowest set bit from the piece's length on. When there are
too many open bins the fullest is closed: the lowest set bit of all. Pieces of one Arrow batch are
placed longest first, which fills bins better and stays online from batch to batch.

Bins still open when a partition ends are packed again, whole and by the same rule, with those of
the 63 partitions next to it; only their pieces are joined to the places found.

A document is the ids of its text and then ``end_id``. Longer ones than a sequence are cut into
whole sequences and a rest. Ids of words (runs without ASCII white space, which the tokenizer
drops and never joins across) are remembered in a table of bounded size.

Contract. Null and empty texts are ``end_id`` alone. Repeated rows and ids are packed each for
itself. No rows: no rows. The tokenizer's file is a path that all executors can read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from marquetry.session import staged

from .common import whole_text

SEQUENCE = 2048
END_ID = 0
OPEN_BINS = 256
#: Words whose ids are remembered, per Python worker.
REMEMBERED = 250_000
#: Partitions whose last open bins are packed together.
NEIGHBOURS = 64

_ENDED_WORD = re.compile(rb"([A-Za-z]+)([.,;:!?()%$#&*\"\-]*)")


class WordIds(dict):
    """Ids of words as little-endian unsigned 32-bit numbers, found once and remembered."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._remembered = remembered
        self._before: dict[bytes, bytes] = {}

    def _ids(self, word: bytes, plain: bool = False) -> bytes:
        """``plain``: lower-case a to z alone, which all steps before the model leave as they are."""
        if plain:
            ids = [t.id for t in self._model.tokenize(word.decode())]
        else:
            ids = self._tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        """Letters are told from what follows them, and their case is dropped, as the tokenizer does."""
        if len(self) > self._remembered:
            # What is met again comes back from the table before.
            self._before = dict(self)
            self.clear()
        if (ids := self._before.get(word)) is not None:
            self[word] = ids
            return ids
        if m := _ENDED_WORD.fullmatch(word):
            stem, tail = m[1].lower(), m[2]
            ids = self[stem] if stem != word else self._ids(stem, plain=True)
            if tail:
                ids += self[tail]
        else:
            ids = self._ids(word)
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        # bytes.split() knows ASCII white space only, all of which the tokenizer drops.
        return b"".join(map(self.__getitem__, text.encode().split()))


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


class OpenBins:
    """At most ``most`` open bins of ``size``; bins are numbered from 0 as they are opened."""

    def __init__(self, size: int, most: int):
        self._size, self._most = size, most
        self._by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self._frees = 0  # bit f: a bin with f free places is open
        self._open = 0
        self.opened = 0

    def _take(self, free: int) -> int:
        bins = self._by_free[free]
        number = bins.pop()
        if not bins:
            self._frees ^= 1 << free
        self._open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin for a piece and the piece's offset there."""
        fitting = self._frees >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self._size, self.opened
            self.opened += 1
        left = free - length
        if left:
            self._by_free[left].append(number)
            self._frees |= 1 << left
            self._open += 1
            if self._open > self._most:
                self._take((self._frees & -self._frees).bit_length() - 1)
        return number, self._size - free

    def still_open(self) -> set[int]:
        return {n for bins in self._by_free for n in bins}


def _again(group: pd.DataFrame, sequence: int, open_bins: int) -> pd.DataFrame:
    """Places of whole bins in other bins; a bin's new number is that of the first bin put there."""
    group = group.sort_values(["used", "bin"], ascending=[False, True])
    bins, names, out = OpenBins(sequence, open_bins), [], []
    for old, used in zip(group["bin"], group["used"], strict=True):
        number, shift = bins.place(int(used))
        if number == len(names):
            names.append(old)
        out.append((old, names[number], shift))
    return pd.DataFrame(out, columns=["bin", "into", "shift"])


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) and the piece's ids if asked for."""
    end = np.asarray([end_id], dtype="<u4").tobytes()
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, bin long, offset long"
        + ", ids binary" * with_ids
    )

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        encode, bins = _word_ids(tokenizer), OpenBins(sequence, open_bins)
        for batch in batches:
            rows = []  # (length, row, piece, start, checksum, ids)
            for at, text_at in enumerate(batch.column(1)):
                ids = encode.of(text_at.as_py()) + end
                for start in range(0, len(ids), 4 * sequence):
                    part = ids[start : start + 4 * sequence]
                    row = (len(part) // 4, at, start // (4 * sequence), start // 4, zlib.crc32(part))
                    rows.append((*row, part if with_ids else None))
            rows.sort(key=lambda r: -r[0])
            placed = [bins.place(r[0]) for r in rows]
            columns = [
                batch.column(0).take(pa.array([r[1] for r in rows], pa.int64())),
                pa.array([r[2] for r in rows], pa.int32()),
                pa.array([r[3] for r in rows], pa.int64()),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[4] for r in rows], pa.int64()),
                pa.array([first + n for n, _ in placed], pa.int64()),
                pa.array([o for _, o in placed], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array([r[5] for r in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        left = pa.array(sorted(first + n for n in bins.still_open()), pa.int64())
        markers = [left if f.name == "bin" else pa.nulls(len(left), f.type) for f in arrow]
        yield pa.RecordBatch.from_arrays(markers, schema=arrow)

    placed = staged(docs.select(doc_id, whole_text(text)).mapInArrow(run, schema), "pieces")
    pieces = placed.filter("piece IS NOT NULL")
    left = placed.filter("piece IS NULL").select("bin")
    used = pieces.join(left, "bin", "left_semi").groupBy("bin").agg(F.sum("length").alias("used"))
    # Each partition leaves ``open_bins`` at most, so a group is bounded.
    loose = used.withColumn("near", F.floor(F.shiftright("bin", 32) / NEIGHBOURS))
    moved = staged(
        loose.groupBy("near").applyInPandas(
            lambda g: _again(g, sequence, open_bins), "bin long, into long, shift long"
        ),
        "moved",
    )
    out = pieces.join(moved, "bin", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        *(["ids"] if with_ids else []),
    )
    return out
