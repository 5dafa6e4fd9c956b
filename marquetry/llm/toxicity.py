"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its words, pairs of neighbours and pairs with one word between, each hashed
to HASH_BITS bits and counted once. Every coordinate has its own learning rate; L1 leaves most
weights at exactly zero, so the model is a short sorted list of hashes and weights.

Training. All labelled rows are learned from. Features are counted exactly; those of two toxic rows or
more whose share of the toxic rows is over LIFT times that of the other rows are learned from, at any
base rate. They are counted and joined as rows; tasks get a table of bits of them, of bounded size, so that
few other features are sent. Rows are dealt by hash into shards of about SHARD_ROWS rows; each shard
runs FTRL over its rows for EPOCHS passes in a task of its own. The accumulators (z, n) of a feature are
averaged over the shards that met it, and the weight follows from them. At last the log odds are
calibrated on all labelled rows by a slope and an offset, from sums over the rows.

Bounds. No row is left out. Where more than WEIGHTS weights would be left, L1 is raised until they fit.
Every text is scored whole.

Contract. A null text is empty. An empty text has the score of the bias alone. Without labelled
rows every score is 0.5. Rows with a null label are not learned from. Repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from marquetry.operators import bitmaps
from marquetry.session import staged

from .common import ROWS_AT_ONCE, bit_table, bits_for, in_batches, is_set, mixed, whole_text, word_hashes

SHARD_ROWS = 8_192
EPOCHS = 6
ALPHA, BETA, L2 = 10.0, 1.0, 0.1
#: L1 for each row of a shard, and the least L1.
L1_PER_ROW, LEAST_L1 = 3e-4, 0.5
LIFT = 2.0
HASH_BITS = 40
WEIGHTS = 1 << 18
THRESHOLD = 0.7
#: Features of some texts that a task counts at once.
FEATURES_AT_ONCE = 1 << 20

_BIAS = -1  # no feature's hash
_LOW_BITS = 20


_MASK = np.uint64((1 << HASH_BITS) - 1)
_PUNCTUATION = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def features(text: str) -> np.ndarray:
    """Sorted hashes of the words, neighbour pairs and skip pairs of ``text``."""
    own = word_hashes(np.frombuffer(text.lower().encode().translate(_PUNCTUATION), dtype=np.uint8))[0]
    once, again = own * np.uint64(0x9E3779B97F4A7C15), own * np.uint64(0xC2B2AE3D27D4EB4F)
    pairs = once[:-1] + again[1:] + np.uint64(1)
    skips = once[:-2] + again[2:] + np.uint64(2)
    return np.unique(mixed(np.concatenate((once, pairs, skips))) & _MASK).astype(np.int64)


def weights_of(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    """The proximal step: zero within ``l1``, else against the sign of z by the coordinate's own rate."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train_shard(
    rows: list[np.ndarray], labels: np.ndarray, l1: float, epochs: int = EPOCHS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of ``rows``, and the bias (-1), with their z and n."""
    names, places = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]), return_inverse=True)
    parts = np.split(places, np.cumsum([len(r) for r in rows])[:-1]) if rows else []
    rows = [np.append(p, len(names)) for p in parts]
    z, n = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for _ in range(epochs):
        for row, label in zip(rows, labels, strict=True):
            zr, nr = z[row], n[row]
            w = weights_of(zr, nr, l1)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[row] = zr + gradient - (np.sqrt(nr + gradient**2) - np.sqrt(nr)) / ALPHA * w
            n[row] = nr + gradient**2
    return np.append(names, _BIAS), z, n


def _bits_of(names: DataFrame) -> tuple[Broadcast, int]:
    """A table of bits with those of the staged ``names`` set, shared with all tasks, and how many bits it has.

    Other features can have the same bit.
    """
    n_bits = bits_for(names.count())
    slot = F.col("name").bitwiseAND(F.lit(n_bits - 1)).cast("int")
    return bit_table(names.select(slot.alias("slot")), n_bits), n_bits


def _counted(texts: DataFrame, wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(name, rows): how many rows of ``texts`` have each feature, of those that ``wanted`` leaves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counts() -> pa.RecordBatch:
            names, rows = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(rows)], names=["name", "rows"])

        for batch in batches:
            for text in batch.column(0):
                own = features(text.as_py())
                held.append(own if wanted is None else wanted(own))
                size += len(held[-1])
                if size >= FEATURES_AT_ONCE:
                    yield counts()
                    held, size = [], 0
        if held:
            yield counts()

    return texts.select("text").mapInArrow(count, "name long, rows long").groupBy("name").agg(F.sum("rows").alias("rows"))


def _telling(learned: DataFrame, toxic_rows: int, other_rows: int) -> DataFrame:
    """(name) of the features of two toxic rows or more, LIFT times as common in toxic rows as in others. Staged."""
    known = staged(_counted(learned.filter("label > 0")).filter("rows > 1"), "known")
    bits, n_bits = _bits_of(known)
    other = _counted(learned.filter("label <= 0"), lambda own: own[is_set(bits.value, own & (n_bits - 1))])
    joined = known.join(other.withColumnRenamed("rows", "other"), "name", "left")
    commoner = F.col("rows") * float(other_rows) > F.coalesce("other", F.lit(0)) * LIFT * float(toxic_rows)
    found = staged(joined.filter(commoner).select("name"), "telling")
    bits.destroy()
    return found


def _chosen(learned: DataFrame, telling: DataFrame, shards: int) -> DataFrame:
    """(shard, dealt, key, label, own): every row of ``learned`` with those of its features that are in ``telling``. Staged."""
    bits, n_bits = _bits_of(telling)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                found = [features(t) for t in part.column(1).to_pylist()]
                found = [f[is_set(bits.value, f & (n_bits - 1))] for f in found]
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                columns = [part.column(0).take(pa.array(at)), pa.array(np.concatenate(found))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "name"])

    sent = learned.select("row", "text").mapInArrow(pairs, "row long, name long")
    own = sent.join(telling, "name").groupBy("row").agg(F.sort_array(F.collect_list("name")).alias("own"))
    shard = F.pmod("dealt", F.lit(shards)).cast("long")
    rows = learned.select("row", shard.alias("shard"), "dealt", "key", "label").join(own, "row", "left")
    none = F.array().cast("array<long>")
    chosen = staged(rows.select("shard", "dealt", "key", "label", F.coalesce("own", none).alias("own")), "features")
    bits.destroy()
    return chosen


@dataclass
class Model:
    """Sorted feature hashes, their weights, and the bias."""

    names: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self._low = np.zeros(1 << _LOW_BITS, dtype=bool)
        self._low[self.names & ((1 << _LOW_BITS) - 1)] = True

    def __reduce__(self):
        return Model, (self.names, self.weights, self.bias)

    def margin(self, own: np.ndarray) -> float:
        """The log odds of a text with the features ``own``."""
        own = own[self._low[own & ((1 << _LOW_BITS) - 1)]]
        at = np.searchsorted(self.names, own)
        hit = at < len(self.names)
        hit[hit] = self.names[at[hit]] == own[hit]
        return self.bias + float(self.weights[at[hit]].sum())

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(features(text)), -35, 35))))


def calibration(pairs: DataFrame, toxic_rows: int, other_rows: int, steps: int = 50) -> tuple[float, float]:
    """Slope and offset (Platt's) that make the margins of ``pairs`` (label, margin) log odds; (1, 0) if only one label is there.

    Each step of Newton's method adds up the loss and its derivatives over all rows.
    """
    if not toxic_rows or not other_rows:
        return 1.0, 0.0
    high, low = (toxic_rows + 1) / (toxic_rows + 2), 1 / (other_rows + 2)
    names = ["loss", "by_slope", "by_offset", "slopes", "mixed", "offsets"]

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                target = np.where(batch.column(0).to_numpy() > 0, high, low)
                margin = batch.column(1).to_numpy()
                odds = margin * w[0] + w[1]
                p = 1 / (1 + np.exp(-np.clip(odds, -35, 35)))
                each = [np.logaddexp(0, odds) - target * odds, margin * (p - target), p - target]
                each += [margin * margin * p * (1 - p), margin * p * (1 - p), p * (1 - p)]
                yield pa.RecordBatch.from_arrays([pa.array([float(x.sum())]) for x in each], names=names)

        every = pairs.select("label", "margin").mapInArrow(add, ", ".join(f"{n} double" for n in names))
        loss, a, b, aa, ab, bb = every.agg(*(F.sum(n) for n in names)).first()
        return loss, np.array([a, b]), np.array([[aa, ab], [ab, bb]])

    w = np.array([1.0, 0.0])
    loss, gradient, hessian = sums(w)
    for _ in range(steps):
        step, size = np.linalg.solve(hessian + 1e-6 * np.eye(2), gradient), 1.0
        there = sums(w - step)
        while size > 1e-6 and there[0] > loss:
            size /= 2
            there = sums(w - size * step)
        if there[0] > loss:
            break
        w, gain = w - size * step, loss - there[0]
        loss, gradient, hessian = there
        if gain <= 1e-12 * loss:
            break
    return float(max(w[0], 1e-6)), float(w[1])


def _labelled(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, text, label) of the ``texts`` with one of the staged ``labels``.

    Texts stay where they are if bitmaps of the ids can be broadcast; otherwise a plain join.
    """
    if not isinstance(texts.schema["key"].dataType, IntegralType) or not bitmaps.fits(labels, "key"):
        return texts.join(labels, "key")
    known = bitmaps.keep_with_parents(texts, [(labels, "key")])
    marked = bitmaps.with_known(known, labels.filter("label > 0"), "key", "marked")
    return marked.select("key", "text", F.col("marked").cast("double").alias("label"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most: int = WEIGHTS,
) -> Model:
    """Learn ``label`` (0 or 1) of ``labels`` from the texts of ``docs`` with the same id.

    All labelled rows are learned from, and the model has at most ``most`` weights.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("key"))
        .agg(F.max(label).cast("double").alias("label"))
    )
    texts = docs.select(F.col(doc_id).alias("key"), whole_text(text).alias("text"))
    learned = _labelled(texts, staged(known, "labels")).select(
        F.monotonically_increasing_id().alias("row"), F.xxhash64("key", "text", F.lit(1)).alias("dealt"), "key", "label", "text"
    )
    learned = staged(learned, "labelled")
    toxic_rows, other_rows = learned.agg(F.count_if(F.col("label") > 0), F.count_if(F.col("label") <= 0)).first()
    shards = max(1, round((toxic_rows + other_rows) / SHARD_ROWS))
    l1 = max(LEAST_L1, L1_PER_ROW * (toxic_rows + other_rows) / shards)
    chosen = _chosen(learned, _telling(learned, toxic_rows, other_rows), shards)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(order=[zlib.crc32(str(k).encode()) for k in group["key"]]).sort_values(["order", "key", "dealt"])
        own = [np.asarray(f, dtype=np.int64) for f in group["own"]]
        names, z, n = train_shard(own, group["label"].to_numpy(), l1)
        return pd.DataFrame({"name": names, "z": z, "n": n})

    found = (
        chosen.groupBy("shard")
        .applyInPandas(run, "name long, z double, n double")
        .groupBy("name")
        .agg(F.avg("z").alias("z"), F.avg("n").alias("n"))
        .filter((F.abs("z") > l1) | (F.col("name") == _BIAS))
        .orderBy(F.col("name") != _BIAS, F.desc(F.abs("z")), "name")
        # The bias, the weights that fit, and the first that doesn't.
        .limit(most + 2)
        .toPandas()
    )
    fits = l1 if len(found) < most + 2 else float(found["z"].abs().iloc[-1])
    found = found.sort_values("name")
    names, z, n = (found[c].to_numpy() for c in ("name", "z", "n"))
    weights, bias = weights_of(z, n, fits), weights_of(z, n, l1)[names == _BIAS]
    own = (names != _BIAS) & (weights != 0)
    raw = Model(names[own].astype(np.int64), weights[own], float(bias.sum()))
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def margins(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.margin(np.asarray(f, dtype=np.int64)) for f in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["label", "margin"])

    pairs = staged(in_batches(chosen, ["label", "own"], margins, "label double, margin double"), "margins")
    shared.destroy()
    slope, offset = calibration(pairs, toxic_rows, other_rows)
    return Model(raw.names, slope * raw.weights, slope * raw.bias + offset)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.score(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return in_batches(docs, [F.col(doc_id), whole_text(text)], step, f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        return batch.filter(pa.array([shared.value.score(t or "") < threshold for t in texts], pa.bool_()))

    return in_batches(docs, docs.columns, step, schema)
