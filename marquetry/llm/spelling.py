"""Spelling variants by a bit-sliced position index.

1. A row's letter runs are counted row by row; tasks add up what they have met before the shuffle.
2. Two words within one edit share their first half or the rest, cut by the length of the shorter one.
   So each word is filed under both halves, as a shorter and as a longer partner, and words that
   share one meet in a group.
3. In a task, groups are packed into indexes of INDEX_WORDS words or more. An index holds, for each position and letter,
   a bitset of its words with that letter there. Queries are read letter by letter; all words
   of the index are followed at once: bitsets of those that match so far, of those with one letter
   replaced, and, against positions shifted by one, of those with one letter more. (A word with a
   letter less finds its partner as that one's query.)
4. Near words are counted by word, and the commonest chosen; both combine before the shuffle.
5. Roots follow forms by pointer doubling: the count at least doubles at each form, so there are no rings,
   and a chain of k forms takes about log2(k) rounds.

A group of more than GROUP_WORDS words is dealt into parts; each of its words is a query in all of them.

Contract. Runs are of A-Z, a-z and U+00C0 to U+00FF; A-Z alone are lower-cased. With ``typo_every`` a run
loses a letter where that number divides the checksum of ``<doc_id>:<run>``; rows without an id lose none.
Null and empty texts have no words. Repeated rows count again. Ties go to the word that is
smallest in code-point order. Words of any length are compared whole. An empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.session import staged

LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
#: Different words that a task adds up before it sends them on.
WORDS_HELD = 1 << 17
INDEX_WORDS = 4096
#: Words of one group that an index takes at most, and queries that are followed at once.
GROUP_WORDS, QUERIES_AT_ONCE = 1 << 15, 1024
#: Lengths below this share tables; longer words go by twice as long ones each.
ONE_TABLE = 32
#: Letters and queries that a task holds, if a group's words are no more.
LETTERS_HELD, QUERIES_HELD = 1 << 22, 1 << 15

_RUN = re.compile(rb"[a-z\xc0-\xff]+")


def words_of(doc_id: object, text: str | None, typo_every: int | None = None) -> Counter[bytes]:
    """The words of a text in Latin-1 with their counts; runs hold no other letters."""
    runs = Counter(_RUN.findall((text or "").encode("latin-1", "replace").lower()))
    if typo_every is None or doc_id is None:
        return runs
    start = zlib.crc32(f"{doc_id}:".encode())
    out: Counter[bytes] = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % typo_every == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
        out[run] += n
    return out


def vocabulary(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    typo_every: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n) of the words of at least ``least_length`` letters that occur ``least_count`` times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def sent() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                for word, n in words_of(key.as_py(), value.as_py(), typo_every).items():
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > WORDS_HELD:
                    yield sent()
                    held = Counter()
        yield sent()

    counted = docs.select(doc_id, text).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _bits(flags: np.ndarray, words: int) -> np.ndarray:
    """Rows of flags as rows of ``words`` 64-bit numbers."""
    packed = np.packbits(flags, axis=1, bitorder="little")
    out = np.zeros((len(flags), 8 * words), dtype=np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def _letters(words: list[bytes], width: int) -> np.ndarray:
    """Letters by position and word; 0 behind a word's end."""
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(len(words), width).T


def one_edit(queries: list[bytes], words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a query and a word that has one letter replaced, or one more, anywhere."""
    asked, known = (np.array([len(x) for x in side], dtype=np.int64) for side in (queries, words))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    # Words of some lengths at a time, so that tables have little room behind words' ends.
    low, high = 0, ONE_TABLE
    while low <= max(asked, default=-1):
        q, w = np.flatnonzero((asked >= low) & (asked < high)), np.flatnonzero((known >= low) & (known <= high))
        if len(q) and len(w):
            query, word = _of_like_lengths([queries[i] for i in q], [words[i] for i in w])
            found.append((q[query], w[word]))
        low, high = high, 2 * high
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _of_like_lengths(queries: list[bytes], words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = -(-len(words) // 64)
    width = max(map(len, words))
    letters = _letters(words, width)
    alphabet = np.unique(letters)
    alphabet = alphabet[alphabet > 0]
    # A letter's row in the tables; the last row is of letters that no word has.
    row_of = np.full(256, len(alphabet), dtype=np.int64)
    row_of[alphabet] = np.arange(len(alphabet))
    none = np.zeros((len(alphabet) + 1, size), dtype=np.uint64)

    def table(position: int) -> np.ndarray:
        if position >= width:
            return none
        return np.concatenate((_bits(letters[position] == alphabet[:, None], size), none[:1]))

    lengths = np.array([len(w) for w in words])
    order = np.argsort([-len(q) for q in queries], kind="stable")
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for low in range(0, len(order), QUERIES_AT_ONCE):
        own = order[low : low + QUERIES_AT_ONCE]
        sizes = np.array([len(queries[i]) for i in own])
        asked = row_of[_letters([queries[i] for i in own], int(sizes[0]))]
        same = np.broadcast_to(_bits(np.ones((1, len(words)), dtype=bool), size), (len(own), size)).copy()
        other, longer = np.zeros_like(same), same.copy()
        here, after = table(0), table(1)
        for at in range(int(sizes[0])):
            live = int(np.searchsorted(-sizes, -at, side="left"))  # queries with more letters than ``at``
            same, other, longer = same[:live], other[:live], longer[:live]
            match, shifted = here[asked[at, :live]], after[asked[at, :live]]
            # One letter replaced before, or here; one letter more before, or right behind this one.
            other = (other & match) | (same & ~match)
            same = same & match
            longer = (longer & shifted) | same
            here, after = after, table(at + 2)
            done = int(np.searchsorted(-sizes, -(at + 1), side="left"))
            if done < live:
                lasting = _bits(np.stack((lengths == at + 1, lengths == at + 2)), size)
                near = (other[done:] & lasting[0]) | (longer[done:] & lasting[1])
                query, part = np.nonzero(near)
                flags = np.unpackbits(near[query, part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                hit, bit = np.nonzero(flags)
                found.append((own[done + query[hit]], part[hit] * 64 + bit))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _halves(word: Column) -> Column:
    """The groups of a word: (kind, length of the shorter partner, half)."""

    def filed(kind: int, shorter: Column, half: Column, query: bool) -> Column:
        return F.struct(F.xxhash64(F.lit(kind), shorter, half).alias("group"), F.lit(kind).alias("kind"), F.lit(query).alias("query"))

    size = F.char_length(word)
    out = []
    for shorter, query in ((size, True), (size - 1, False)):
        head = (shorter / 2).cast("int")
        out += [filed(0, shorter, F.substring(word, 1, head), query), filed(1, shorter, F.right(word, shorter - head), query)]
    return F.array(*out)


def near_words(vocabulary: DataFrame, index_words: int = INDEX_WORDS, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, near, n): every pair within one edit of ``vocabulary`` (word, n), both ways round; ``n`` is of ``near``."""
    filed = vocabulary.select("word", "n", F.explode(_halves(F.col("word"))).alias("f")).select("word", "n", "f.*")
    sizes = filed.groupBy("group").agg(F.count("*").alias("size")).filter(F.col("size") > group_words)
    # A row for every ``group_words`` entries at most.
    parts = sizes.select("group", F.ceil(F.col("size") / group_words).cast("int").alias("parts"))
    dealt = filed.join(F.broadcast(parts), "group", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    asked = F.when(F.col("query"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array().cast("array<int>"))
    roles = F.concat(
        F.array(F.struct(part.alias("part"), F.lit(0).alias("role"))),
        F.transform(asked, lambda p: F.struct(p.alias("part"), F.lit(1).alias("role"))),
    )
    rows = dealt.select("group", "kind", "word", "n", F.explode(roles).alias("r")).select("group", "r.part", "r.role", "kind", "word", "n")
    rows = rows.repartition("group", "part").sortWithinPartitions("group", "part", "role")
    schema = "word string, near string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _runs(batches, index_words)

    return rows.mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], index_words: int) -> Iterator[pa.RecordBatch]:
    """Near pairs of groups that come in one piece, the words of the index before the queries."""
    words: list[tuple[bytes, int, int]] = []  # word, n, group's number in the index
    queries: list[tuple[bytes, int, int, int]] = []  # with the kind
    now, number, letters = None, 0, 0

    def found() -> pa.RecordBatch:
        query, word = one_edit([q[0] for q in queries], [w[0] for w in words])
        left, right, n = [], [], []
        for i, k in zip(query.tolist(), word.tolist(), strict=True):
            (a, n_a, group, kind), (b, n_b, of) = queries[i], words[k]
            half = len(a) // 2
            # The group of the rest leaves alone what that of the first half finds.
            if group == of and not (kind and a[:half] == b[:half]):
                left.append(a)
                right.append(b)
                n.append(n_b)
                if len(b) > len(a):
                    left.append(b)
                    right.append(a)
                    n.append(n_a)
        texts = [pa.array([w.decode("latin-1") for w in side], pa.string()) for side in (left, right)]
        return pa.RecordBatch.from_arrays([*texts, pa.array(n, pa.int64())], ["word", "near", "n"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for group, part, role, kind, word, n in zip(*columns, strict=True):
            if (group, part) != now:
                if len(words) >= index_words or letters > LETTERS_HELD or len(queries) > QUERIES_HELD:
                    yield found()
                    words, queries, letters = [], [], 0
                now, number = (group, part), number + 1
            word = word.encode("latin-1")
            letters += len(word)
            if role == 0:
                words.append((word, n, number))
                continue
            queries.append((word, n, number, kind))
            if len(queries) > QUERIES_HELD:
                yield found()
                queries = []
    yield found()


def forms(vocabulary: DataFrame, near: DataFrame, times: float = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n): the commonest near word, where it is ``times`` as common."""
    best = F.min(F.struct((-F.col("n")).alias("minus"), F.col("near").alias("form"))).alias("best")
    found = near.groupBy(F.col("word").alias("own")).agg(F.count("*").alias("n_near"), best)
    joined = vocabulary.join(found, F.col("word") == F.col("own"), "left")
    form_n = -F.col("best.minus")
    is_form = form_n >= times * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"),
        F.when(is_form, form_n).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words of ``formed`` (word, form) that have a form: what is reached by following forms."""
    now = staged(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = now.join(onward, "root", "left")
        after = staged(after.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    typo_every: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: float = TIMES,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``."""
    known = staged(vocabulary(docs, doc_id, text, typo_every, least_length, least_count), "vocabulary")
    formed = staged(forms(known, near_words(known), times), "forms")
    reached = roots(formed)
    return formed.join(reached, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
