"""Benchmark decontamination by latent semantic retrieval.

Fit. Words are hashed into SLOTS slots and weigh the square of their idf, which is counted over all
documents. The right singular vectors of the TF-IDF matrix of all documents and items, a row for each
whole text, are found by randomised subspace iteration. It begins with a sketch: every row, with a sign,
is added to one of as many sums as the basis has columns, by a hash of the row. In each round every task
multiplies its rows by the current basis and by their own transpose, the products are added up block by
block, and the driver makes the sum of fixed size orthonormal. Texts are counted once; sketch and rounds
read the counts. Coordinates are scaled by the inverse singular values, so that what nearly all texts
share does not hide what tells them apart.

Index. Every passage of every document is projected: windows of WINDOWS words, half overlapping.
A word's vector is looked up once and summed over blocks, from which all windows are made.

Search. A window is a candidate for an item if their cosine is COSINE or more; there is no limit on
candidates. A candidate is verified on the words around it: the item's longest common subsequence
must have VERBATIM of its words, or REWORDED of them while the item's answer (its last quarter,
three words at least) is there with ANSWER of its words.

Exact path. No cosine says what the verification would accept, so words are counted too. A run of
twice an item's words that the verification accepts has REWORDED of the item's n words, so of the
item's m rarest words it has all but n - ceil(REWORDED n). All places where it has as many are
verified from each word of the item on, whatever their cosine: no run that passes is missed.

Bounds. Nothing is sampled. Different items are taken ITEMS_AT_ONCE at a time, in the order of their ids
and texts.

Contract. Words are compared in lower case, without ASCII punctuation. Null and empty texts and
items have no words and no matches. Items of fewer than LEAST_WORDS words are matched verbatim only,
by the exact path alone.
Repeated rows are each judged; an empty table on either side gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.session import staged

from .common import BLOCK, BLOCKS_SCHEMA, ROWS_AT_ONCE, blocks, in_batches, slot_counts, summed, whole_text, word_hashes

SLOTS = 1 << 15
RANK, MORE, ROUNDS = 112, 8, 1
#: Bytes of texts that are hashed at once, so that tables of a few times as many stay near the core.
BYTES_AT_ONCE = 1 << 15
WORDS_IN_BLOCK = 8
WINDOWS = (16, 32, 64)
COSINE = 0.58
VERBATIM, REWORDED, ANSWER = 0.75, 0.55, 0.6
LEAST_WORDS = 8
#: An item's words for each hit that the exact path asks for; any number finds the same.
WORDS_PER_HIT = 5
ITEMS_AT_ONCE = 4_096
#: Cosines that are worked out at once.
CELLS_AT_ONCE = 1 << 17

_PUNCTUATION = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def _plain(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(_PUNCTUATION)


def words_of(text: str | None) -> list[bytes]:
    return _plain(text).split()


def hashes_of(text: str | None) -> np.ndarray:
    """The hash of each word of ``text``, in order."""
    return word_hashes(np.frombuffer(_plain(text), dtype=np.uint8))[0]


def slots_of(text: str | None) -> np.ndarray:
    """The slot of each word of ``text``, in order."""
    return (hashes_of(text) % SLOTS).astype(np.int64)


def hashes_of_all(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, words of each text) of the words of following texts, some texts at a time."""
    held, size = [], 0
    for i, text in enumerate(texts):
        held.append(_plain(text))
        size += len(held[-1]) + 1
        if size >= BYTES_AT_ONCE or i + 1 == len(texts):
            # The space between two texts ends a word.
            hashes, starts = word_hashes(np.frombuffer(b" ".join(held), dtype=np.uint8))
            before = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in held]))
            yield hashes, np.diff(before, prepend=0)
            held, size = [], 0


def _bags(texts: DataFrame) -> DataFrame:
    """(slots, times) of each row of ``texts`` (text): its slots, sorted, and how often each occurs, as bytes."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots, times, sizes = [], [], []
        for hashes, words in hashes_of_all(batch.column(0).to_pylist()):
            # A text and a slot as one number.
            found = np.sort(np.repeat(np.arange(len(words)), words) * SLOTS + (hashes % SLOTS).astype(np.int64))
            first = np.flatnonzero(np.diff(found, prepend=-1))
            slots.append((found[first] % SLOTS).astype(np.uint16))
            times.append(np.diff(first, append=len(found)).astype(np.uint32))
            sizes.append(np.bincount(found[first] // SLOTS, minlength=len(words)))
        ends = np.cumsum(np.concatenate([[0], *sizes]))
        columns = [_binaries(np.concatenate([np.zeros(0, kind), *parts]), ends) for parts, kind in ((slots, np.uint16), (times, np.uint32))]
        return pa.RecordBatch.from_arrays(columns, names=["slots", "times"])

    return in_batches(texts, ["text"], step, "slots binary, times binary")


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``values`` between each two of ``ends`` as the bytes of a row."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _weights(bags: DataFrame) -> np.ndarray:
    """Squared idf of each slot over all ``bags``, 0 for what all have."""

    def slots(found: list[bytes]) -> Iterator[np.ndarray]:
        yield np.frombuffer(b"".join(found), dtype=np.uint16)
        yield np.full(len(found), SLOTS)  # documents

    counts = slot_counts(bags, "slots", slots, SLOTS + 1)
    idf = np.log((1.0 + counts[SLOTS]) / (1.0 + np.minimum(counts[:SLOTS], counts[SLOTS])))
    return (idf**2).astype(np.float32)


def _add_sketch(out: np.ndarray, slots: list[bytes], times: list[bytes], weights: np.ndarray) -> None:
    """Add the TF-IDF row of each bag, of length 1 and with a sign, to a column that a hash of the bag tells."""
    for own, n in zip(slots, times, strict=True):
        names, hashed = np.frombuffer(own, dtype=np.uint16), zlib.crc32(n, zlib.crc32(own))
        row = np.frombuffer(n, dtype=np.uint32) * weights[names]
        if norm := float(np.linalg.norm(row)):
            out[names, (hashed >> 1) % out.shape[1]] += row / (norm if hashed & 1 else -norm)


def _add_gram(out: np.ndarray, slots: list[bytes], times: list[bytes], weights: np.ndarray, basis: np.ndarray) -> None:
    """Add A' A G, of the TF-IDF rows A of some bags, each of length 1, and the basis G."""
    for own, n in zip(slots, times, strict=True):
        names = np.frombuffer(own, dtype=np.uint16).astype(np.int64)
        row = np.frombuffer(n, dtype=np.uint32) * weights[names]
        row = row.astype(np.float32)
        if square := float(row @ row):
            # Rows have few slots in common, so each is multiplied by its own rows of the basis.
            out[names] += np.multiply.outer(row, row @ basis.take(names, axis=0) / np.float32(square))


def _orthonormal(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Left singular vectors of ``g``, leading ones first, and its singular values, by its small square.

    No copy of ``g`` in doubles is made; directions that it does not have are zero.
    """
    squares, right = np.linalg.eigh((g.T @ g).astype(np.float64))
    values = np.sqrt(np.maximum(squares[::-1], 0))
    safe = values > 1e-4 * max(float(values[0]), 1e-30)
    turn = right[:, ::-1] * np.where(safe, 1 / np.where(safe, values, 1), 0)
    return g @ turn.astype(np.float32), values


def basis_of(texts: DataFrame, weights: np.ndarray, rank: int = RANK, rounds: int = ROUNDS) -> np.ndarray:
    """The leading right singular vectors (slots by rank), scaled, of all rows of ``texts`` (text)."""
    return _basis(staged(_bags(texts), "bags"), weights, rank, rounds)


def _basis(bags: DataFrame, weights: np.ndarray, rank: int = RANK, rounds: int = ROUNDS) -> np.ndarray:
    width = rank + MORE
    spark = bags.sparkSession
    per_block = BLOCK // width
    # Each task returns a table of fixed size, so there are no more tasks than run at once.
    dealt = bags.coalesce(spark.sparkContext.defaultParallelism)
    guess = None
    for _ in range(1 + rounds):
        shared = spark.sparkContext.broadcast((guess if guess is None else _orthonormal(guess)[0], weights))

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            basis, own = shared.value
            total = np.zeros((SLOTS, width), dtype=np.float32)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(at, ROWS_AT_ONCE)
                    found = [part.column(i).to_pylist() for i in range(2)]
                    _add_sketch(total, *found, own) if basis is None else _add_gram(total, *found, own, basis)
            parts = {i: total[at : at + per_block].ravel() for i, at in enumerate(range(0, SLOTS, per_block))}
            yield blocks(parts, np.float32)

        sums = summed(dealt.mapInArrow(add, BLOCKS_SCHEMA), np.float32, np.float32)
        shared.destroy()
        if not sums:
            return np.zeros((SLOTS, rank), dtype=np.float32)
        guess = np.concatenate([sums[b] for b in sorted(sums)]).reshape(SLOTS, width)
    # The sum is A'A times the last basis: its singular values are squares of A's.
    left, squares = _orthonormal(guess)
    scale = 1 / np.sqrt(np.maximum(squares[:rank], 1e-9 * max(float(squares[0]), 1e-9)))
    return left[:, :rank] * scale.astype(np.float32)


def common_length(masks: dict[bytes, int], size: int, words: Sequence[bytes]) -> int:
    """Length of the longest common subsequence of an item and ``words``, a bit for each word of the item."""
    full = (1 << size) - 1
    row = full
    for found in filter(None, map(masks.get, words)):
        row = ((row + (row & found)) | (row & ~found)) & full
    return size - row.bit_count()


def word_masks(words: Sequence[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << i
    return out


@dataclass
class Item:
    """An item's words, ready to be compared."""

    item_id: int
    text: str

    def __post_init__(self):
        self.words = words_of(self.text)
        answer = self.words[-max(3, len(self.words) // 4) :]
        self._all, self._answer, self._answer_size = word_masks(self.words), word_masks(answer), len(answer)
        self._times = Counter(self.words)

    @property
    def span(self) -> int:
        """Words of a run that the exact path verifies at once."""
        return len(self.words) * (1 if len(self.words) < LEAST_WORDS else 2)

    @property
    def needed(self) -> int:
        """Words that a run must have in order, whatever its answer."""
        return len(self.words) if len(self.words) < LEAST_WORDS else int(np.ceil(REWORDED * len(self.words) - 1e-9))

    def common(self, words: Sequence[bytes]) -> int:
        """How many of the item's words are in ``words``, in any order: in order there are no more."""
        return sum(map(self._times.__getitem__, self._times.keys() & words))

    def runs(self, words: Sequence[bytes], low: int, high: int) -> Iterator[tuple[int, float, float]]:
        """(first word, shares) of the runs of ``span`` words in a range of ``words`` that hold the item."""
        near = words[low:high]
        if self.common(near) < self.needed or common_length(self._all, len(self.words), near) < self.needed:
            return
        for first in range(low, high):
            # A run loses nothing if it begins at its first word of the item.
            if words[first] in self._all:
                shares = self.shares(words[first : first + self.span])
                if self.is_in(*shares):
                    yield first, *shares

    def shares(self, near: Sequence[bytes]) -> tuple[float, float]:
        """Shares of the item's and of its answer's words that ``near`` has in order."""
        whole = common_length(self._all, len(self.words), near) / len(self.words)
        if whole < REWORDED:
            return whole, 0.0
        return whole, common_length(self._answer, self._answer_size, near) / self._answer_size

    def is_in(self, whole: float, answer: float) -> bool:
        if len(self.words) < LEAST_WORDS:
            return whole == 1.0
        return whole >= VERBATIM or (whole >= REWORDED and answer >= ANSWER)


class Searcher:
    """Windows of texts against the latent vectors of items."""

    def __init__(self, items: list[tuple[int, str | None]], weights: np.ndarray, basis: np.ndarray):
        self._items = [Item(i, t) for i, t in items if words_of(t)]
        # A zero row stands for places past the end of a text.
        self._vectors = np.concatenate((basis * weights[:, None], np.zeros((1, basis.shape[1]), np.float32)))
        found = [self._vectors[slots_of(i.text)].sum(axis=0) for i in self._items]
        queries = np.array(found, dtype=np.float32).reshape(len(found), basis.shape[1])
        norms = np.linalg.norm(queries, axis=1, keepdims=True)
        self._queries = np.divide(queries, norms, out=np.zeros_like(queries), where=norms > 0).T.copy()
        self._post(weights)

    def _post(self, weights: np.ndarray) -> None:
        """Lists of the items that have a word among their rarest ones, by the word's hash."""
        names, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self._spans = np.array([i.span for i in self._items], dtype=np.int64)
        self._hits = np.zeros(len(self._items), dtype=np.int64)
        for at, item in enumerate(self._items):
            own, spare = hashes_of(item.text), len(item.words) - item.needed
            self._hits[at] = min(item.needed, max(1, len(own) // WORDS_PER_HIT)) if spare else len(own)
            rare = np.argsort(-weights[(own % SLOTS).astype(np.int64)], kind="stable")[: spare + self._hits[at]]
            names.append(np.unique(own[rare]))
            owners.append(np.full(len(names[-1]), at))
        name, owner = np.concatenate(names), np.concatenate(owners)
        order = np.argsort(name, kind="stable")
        self._owners = owner[order]
        self._names, self._lists = np.unique(name[order], return_index=True)
        self._sizes = np.diff(np.append(self._lists, len(name)))
        self._known = np.zeros(1 << 16, dtype=bool)
        self._known[(self._names & np.uint64(0xFFFF)).astype(np.int64)] = True

    def places(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first word, end) of all ranges with runs that have enough of an item's rare words; texts are hashes."""
        gap = int(self._spans.max(initial=0))
        starts = np.cumsum([0, *(len(t) + gap for t in texts)])
        every = np.concatenate([np.zeros(0, np.uint64), *texts])
        at = np.flatnonzero(self._known[(every & np.uint64(0xFFFF)).astype(np.int64)])
        name = np.searchsorted(self._names, every[at])
        name[name == len(self._names)] = 0
        same = self._names[name] == every[at] if len(self._names) else np.zeros(0, dtype=bool)
        at, name = at[same], name[same]
        # No run reaches from one text into the next, nor from one item's words into another's.
        at += gap * (np.searchsorted(np.cumsum([len(t) for t in texts]), at, side="right"))
        sizes = self._sizes[name]
        item = self._owners[np.repeat(self._lists[name] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
        key = np.sort(item * starts[-1] + np.repeat(at, sizes))
        item = key // max(1, starts[-1])
        last = np.arange(len(key)) + self._hits[item] - 1
        first = np.flatnonzero(last < len(key))
        first = first[key[last[first]] - key[first] < self._spans[item[first]]]
        low, high = key[last[first]] - self._spans[item[first]] + 1, key[first] + self._spans[item[first]]
        # Ranges of one item that overlap are one.
        new = np.flatnonzero(np.append(True, (low[1:] >= high[:-1]) | (item[first][1:] != item[first][:-1]))[: len(low)])
        for a, z in zip(new.tolist(), [*(new[1:] - 1).tolist(), len(low) - 1], strict=False):
            own = int(item[first[a]])
            place = int(key[first[a]]) - own * int(starts[-1])
            text = int(np.searchsorted(starts, place, side="right")) - 1
            start = own * int(starts[-1]) + int(starts[text])
            yield text, own, max(0, int(low[a]) - start), min(len(texts[text]), int(high[z]) - start)

    def _cosine(self, slots: np.ndarray, item: int) -> float:
        own = self._vectors[slots].sum(axis=0)
        return float(own @ self._queries[:, item] / max(float(np.linalg.norm(own)), 1e-12))

    def candidates(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, item, first word, words, cosine) of the windows near an item; texts are slots."""
        # A text begins where windows of every size begin.
        step = max(1, WINDOWS[-1] // WORDS_IN_BLOCK // 2)
        sizes = np.array([-(-len(s) // (WORDS_IN_BLOCK * step)) * step for s in texts], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        rank = self._vectors.shape[1]
        padded = np.full(int(sizes.sum()) * WORDS_IN_BLOCK, len(self._vectors) - 1)
        for slots, at in zip(texts, (starts * WORDS_IN_BLOCK).tolist(), strict=True):
            padded[at : at + len(slots)] = slots
        vectors = np.empty((len(padded) // WORDS_IN_BLOCK, rank), dtype=np.float32)
        for low in range(0, len(vectors), 256):
            words = padded[low * WORDS_IN_BLOCK : (low + 256) * WORDS_IN_BLOCK]
            self._vectors.take(words, axis=0).reshape(-1, WORDS_IN_BLOCK, rank).sum(axis=1, out=vectors[low : low + 256])
        ends = (starts + sizes)[sizes > 0]
        # A vector for each ``apart`` blocks, each the sum of ``reach`` blocks.
        reach = apart = 1
        for window in WINDOWS:
            while reach * WORDS_IN_BLOCK < window:
                # Twice as many blocks, at places half as far apart as they reach; none runs into the next text.
                share = reach // apart
                short = vectors[::share]
                vectors = short.copy()
                vectors[:-1] += short[1:]
                last = ends // reach - 1
                vectors[last] = short[last]
                reach, apart = 2 * reach, reach
            yield from self._near(vectors, apart, window, starts)

    def _near(self, vectors: np.ndarray, apart: int, window: int, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """What ``candidates`` has of windows of one size, of which ``vectors`` has one for each ``apart`` blocks."""
        limits = np.maximum(COSINE * np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), 1e-12)[:, None]
        n_items = len(self._items)
        at_once = max(64, CELLS_AT_ONCE // max(1, n_items))
        for low in range(0, len(vectors), at_once):
            # Cosines as shares of the least that is near.
            cosines = (vectors[low : low + at_once] / limits[low : low + at_once]) @ self._queries
            near = np.flatnonzero(cosines >= 1)
            rows, items = np.divmod(near, max(1, n_items))
            place = (low + rows) * apart
            text = np.searchsorted(starts, place, side="right") - 1
            first, found = (place - starts[text]) * WORDS_IN_BLOCK, cosines.ravel()[near] * COSINE
            for of in zip(text.tolist(), items.tolist(), first.tolist(), found.tolist(), strict=True):
                yield *of[:3], window, of[3]

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item_id, cosine, share of words, share of the answer) of the best verified match of each pair."""
        if not self._items:
            return
        words: dict[int, list[bytes]] = {}
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        hashes = [part for found, n in hashes_of_all(texts) for part in np.split(found, np.cumsum(n)[:-1])]
        for text, at, first, window, cosine in self.candidates([(h % SLOTS).astype(np.int64) for h in hashes]):
            item = self._items[at]
            if len(item.words) < LEAST_WORDS:
                continue
            if text not in words:
                words[text] = words_of(texts[text])
            # As much room on both sides as the item could stick out of the window.
            room = max(0, len(item.words) - window // 2)
            near = words[text][max(0, first - room) : first + window + room]
            if item.common(near) < item.needed:
                continue
            shares = item.shares(near)
            if item.is_in(*shares):
                found = (shares[0], shares[1], cosine)
                best[text, at] = max(best.get((text, at), found), found)
        for text, at, low, high in self.places(hashes):
            if text not in words:
                words[text] = words_of(texts[text])
            runs = [(*shares, -first) for first, *shares in self._items[at].runs(words[text], low, high)]
            if runs:
                whole, answer, first = max(runs)
                run = hashes[text][-first : -first + self._items[at].span]
                found = (whole, answer, self._cosine((run % SLOTS).astype(np.int64), at))
                best[text, at] = max(best.get((text, at), found), found)
        for (text, at), (whole, answer, cosine) in sorted(best.items()):
            yield text, self._items[at].item_id, cosine, whole, answer


@dataclass
class Index:
    """Weights of slots, and the scaled latent basis."""

    weights: np.ndarray
    basis: np.ndarray


def fit(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text") -> Index:
    """Weights over all of ``docs`` and the basis of all of them and ``items``. Counts of both are staged."""
    bags = staged(_bags(docs.select(F.col(text).alias("text"))), "bags")
    asked = staged(_bags(items.select(F.col(item_text).alias("text"))), "bags")
    weights = _weights(bags)
    return Index(weights, _basis(bags.union(asked), weights))


def search(
    docs: DataFrame,
    items: DataFrame,
    index: Index,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """(doc_id, item_id, cosine, words_share, answer_share) of every verified match; items without an id are left out."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, cosine double, words_share double, answer_share double"
    found = docs.sparkSession.createDataFrame([], schema)
    for shared in _searchers(items, index, item_id, item_text, at_once):

        def step(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            rows = list(shared.value.search(batch.column(1).to_pylist()))
            at, *values = ([r[i] for r in rows] for i in range(5))
            kinds = (pa.int64(), pa.float64(), pa.float64(), pa.float64())
            columns = [batch.column(0).take(pa.array(at, pa.int64()))]
            columns += [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "cosine", "words_share", "answer_share"])

        found = found.union(in_batches(docs, [F.col(doc_id), whole_text(text)], step, schema))
    return found


def _searchers(items: DataFrame, index: Index, item_id: str | None, item_text: str, at_once: int) -> Iterator[Broadcast]:
    """Searchers for ``at_once`` different items each, in the order of ids and texts; without ``item_id`` texts alone count."""
    own = F.lit(0) if item_id is None else F.col(item_id)
    chosen = items.select(own.cast("long").alias("item"), F.col(item_text).alias("body")).dropna().distinct()
    rest = chosen
    while part := rest.orderBy("item", "body").limit(at_once).collect():
        found = [(p["item"], p["body"]) for p in part]
        yield items.sparkSession.sparkContext.broadcast(Searcher(found, index.weights, index.basis))
        if len(part) < at_once:
            return
        item, body = (F.lit(v) for v in found[-1])
        rest = chosen.filter((F.col("item") > item) | ((F.col("item") == item) & (F.col("body") > body)))


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """``docs`` without the rows in whose text an item was found, also one without an id; no row moves."""
    index = fit(docs, items, text, item_text)
    left = docs
    for shared in _searchers(items, index, None, item_text, at_once):

        def step(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            hit = {row[0] for row in shared.value.search(texts)}
            return batch.filter(pa.array([i not in hit for i in range(len(texts))], pa.bool_()))

        left = in_batches(left, docs.columns, step, docs.schema)
    return left
