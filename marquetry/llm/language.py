"""Language identification by cross-parsing entropy.

For each language a suffix automaton of sample text is built. A text is parsed greedily: each
phrase is the longest match that starts where the last one ended and occurs in the sample; a letter
that the sample lacks is a phrase of its own. A
phrase costs the bits of a position in the sample; the language with the fewest bits a character
wins, ties going to the smaller name.

Texts are cut into pieces of SEGMENT characters, so that the automata of all languages walk all
pieces of a batch side by side, one character a step. A phrase ends at a piece's end. The automata's
edges are in one hash table, so memory follows the samples' characters, not the number of letters.

Bounds. A language is learned from at most SAMPLE_ROWS rows, taken in the order of a hash of the
id, and of those from the first SAMPLE_CHARS characters. Predictions read whole texts.

Contract. Letters are compared in lower case; everything else counts as a space. A text that is
null or has no letter is ``und`` with score 0; so is any text where nothing was learned. A language
whose sample holds no letter is learned from its spaces alone. Repeated rows are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquetry.session import staged

from .common import in_batches

SAMPLE_ROWS = 64
#: Sampled ids that are broadcast at most.
BROADCAST_KEYS = 100_000
SAMPLE_CHARS = 60_000
SEGMENT = 512
UNKNOWN = "und"

_END = 0xFFFF
_FOREIGN, _SPACE, _PAD = 0, 1, 2  # codes; letters of the samples follow


class Alphabet:
    """Codes of characters: a letter's own, one for other letters, one for all else."""

    def __init__(self, samples: list[str]):
        letters = sorted({c for s in samples for c in s.lower() if c.isalpha() and ord(c) < _END})
        self.size = 3 + len(letters)
        self._codes = np.array([_FOREIGN if chr(c).isalpha() else _SPACE for c in range(_END + 1)], dtype=np.uint16)
        self._codes[[ord(c) for c in letters]] = np.arange(3, self.size)

    def encode(self, text: str) -> np.ndarray:
        """Codes of ``text``; runs of spaces are one and there is none at the ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = self._codes[np.minimum(points, _END)]
        for at in np.flatnonzero(points > _END):
            codes[at] = _FOREIGN if chr(points[at]).isalpha() else _SPACE
        space = codes == _SPACE
        codes = codes[~(space & np.concatenate(([True], space[:-1])))]
        return codes[:-1] if len(codes) and codes[-1] == _SPACE else codes


def automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """The suffix automaton of ``codes``: for each state the states that its codes lead to; 0 is the start."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes.tolist():
        new, at = len(to), last
        to.append({})
        link.append(0)
        length.append(length[last] + 1)
        while at >= 0 and code not in to[at]:
            to[at][code] = new
            at = link[at]
        if at >= 0:
            old = to[at][code]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                copy = len(to)
                to.append(dict(to[old]))
                link.append(link[old])
                length.append(length[at] + 1)
                while at >= 0 and to[at].get(code) == old:
                    to[at][code] = copy
                    at = link[at]
                link[old] = link[new] = copy
        last = new
    return to


class Edges:
    """A map of whole numbers (not negative) to whole numbers, looked up by arrays of them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(2, int(4 * len(keys)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._last = (1 << bits) - 1
        self._keys, self._values = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self._keys[slots] < 0
            self._keys[slots[free]] = keys[free]
            # Of several for one slot the last was written; the others try the next slot.
            own = self._keys[slots] == keys
            self._values[slots[own]] = values[own]
            keys, values, slots = keys[~own], values[~own], (slots[~own] + 1) & self._last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slots >>= self._shift
        return slots.view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values by key, -1 where there is none."""
        slots = self._slots(keys)
        met = self._keys.take(slots)
        other = met != keys
        found = self._values.take(slots)
        found[other] = -1
        open_ = np.flatnonzero(other & (met >= 0))
        while len(open_):
            at = (slots[open_] + 1) & self._last
            slots[open_] = at
            met = self._keys[at]
            same = met == keys[open_]
            found[open_[same]] = self._values[at[same]]
            open_ = open_[~same & (met >= 0)]
        return found

    @property
    def nbytes(self) -> int:
        return self._keys.nbytes + self._values.nbytes


class CrossParser:
    """Phrases that texts need in each language.

    States of all automata are numbered on; only edges that exist are kept, at most three for a
    character of the samples, so size does not depend on how many letters a language has.
    """

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        self._alphabet = Alphabet(list(samples.values()))
        self._width = self._alphabet.size
        #: By language and code: where the code leads to from the start; 0, which no edge leaves, if nowhere.
        self._first = np.zeros((len(self.names), self._width), dtype=np.int64)
        keys, values, bits, base = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 1
        for row, name in enumerate(self.names):
            codes = self._alphabet.encode(samples[name])
            to = automaton(codes)
            sizes = [len(t) for t in to]
            states = np.repeat(np.arange(base, base + len(to), dtype=np.int64), sizes)
            keys.append(states * self._width + np.fromiter((c for t in to for c in t), np.int64, sum(sizes)))
            values.append(np.fromiter((v for t in to for v in t.values()), np.int64, sum(sizes)) + base)
            for code, state in to[0].items():
                self._first[row, code] = state + base
            bits.append(np.log2(max(2, len(codes))))
            base += len(to)
        self.edges, self.bits = Edges(np.concatenate(keys), np.concatenate(values)), np.array(bits)

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases by language and text, characters by text, and whether a text has a letter."""
        codes = [self._alphabet.encode(t or "") for t in texts]
        chars = np.array([len(c) for c in codes], dtype=np.int64)
        letter = np.array([bool((c != _SPACE).any()) for c in codes], dtype=bool)
        pieces = -(-chars // SEGMENT)
        lanes = np.full((int(pieces.sum()), SEGMENT), _PAD, dtype=np.int64)
        flat, at = lanes.ravel(), 0
        for c, n in zip(codes, pieces, strict=True):
            flat[at : at + len(c)] = c
            at += int(n) * SEGMENT
        used = (lanes != _PAD).sum(axis=1)
        # The longest pieces first, so that those still open at a step are the first ones.
        order = np.argsort(-used, kind="stable")
        steps = np.ascontiguousarray(lanes[order].T)
        open_at = np.searchsorted(-used[order], -np.arange(SEGMENT), side="left")
        # A phrase is counted where it begins: at first, and where no edge leads on.
        state = np.zeros((len(self.names), len(lanes)), dtype=np.int64)
        count = np.zeros(state.shape, dtype=np.int32)
        for step, n in zip(steps, open_at, strict=True):
            if not n:
                break
            code = step[:n]
            after = self.edges.find((state[:, :n] * self._width + code).ravel()).reshape(-1, n)
            begins = after < 0
            count[:, :n] += begins
            state[:, :n] = np.where(begins, self._first.take(code, axis=1), after)
        back = np.empty_like(count)
        back[:, order] = count
        ends = np.concatenate(([0], np.cumsum(pieces)))
        sums = np.concatenate((np.zeros((len(self.names), 1), np.int64), np.cumsum(back, axis=1, dtype=np.int64)), axis=1)
        return sums[:, ends[1:]] - sums[:, ends[:-1]], chars, letter

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        if not self.names:
            yield from ((UNKNOWN, 0.0) for _ in texts)
            return
        phrases, _, letter = self.phrases(texts)
        cost = phrases * self.bits[:, None]
        best = cost.argmin(axis=0)
        share = 1 / np.exp2(-np.minimum(cost - cost.min(axis=0), 1000)).sum(axis=0)
        for at, name in enumerate(best):
            yield (self.names[name], float(share[at])) if letter[at] else (UNKNOWN, 0.0)


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds == fold


def learn(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
) -> dict[str, str]:
    """A bounded sample of text for each language of ``docs``."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    order = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    keys = known.select("lang", "id").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rows)
    keys = staged(keys.select(F.col("lang").alias("name"), F.col("id").alias("key"), "rank"), "sampled")
    # With a usual number of languages the few ids go to the texts, and no text moves.
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    same = F.col("id").eqNullSafe(F.col("key")) & (F.col("lang") == F.col("name"))
    # ``rows`` ids for each language. Rows that share an id take one place; the sample stays bounded by ``chars``.
    found = known.join(keys, same).groupBy("name", "rank").agg(F.min(F.substring("text", 1, chars)).alias("part")).collect()
    samples: dict[str, str] = {}
    for name, _, part in sorted(found):
        if len(samples.setdefault(name, "")) < chars:
            samples[name] = f"{samples[name]} {part}"[:chars]
    return samples


_parsers: dict[tuple, CrossParser] = {}


def _parser(samples: dict[str, str]) -> CrossParser:
    """The parser of ``samples``, built once in each Python worker."""
    key = tuple(sorted(samples.items()))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = CrossParser(samples)
    return _parsers[key]


def predict(docs: DataFrame, samples: dict[str, str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(_parser(samples).predict(batch.column(1).to_pylist()))
        names, scores = (list(x) for x in zip(*found, strict=True)) if found else ([], [])
        columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return in_batches(docs, [doc_id, text], step, f"doc_id {kind}, lang_pred string, score double")
