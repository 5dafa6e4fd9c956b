"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections, in SQL functions alone.

The lowest nodes are SHA-256 of pieces. A paragraph (a line) is cut into pieces before each word whose
MD5 ends in one of CUTS, so a piece has five words on average and borders depend on nothing but the
word there. A paragraph's node is the hash of its pieces' nodes, a section's that of its paragraphs',
the root that of all sections. A section ends after a paragraph whose node ends in 0 or 8. So an edit moves
borders of pieces and sections near itself only. Equal roots mean equal texts.

The likeness of two trees is 1 for equal roots. Otherwise it is the share that they have in common of
their different lowest nodes, twice the common over the sum of both, and less than 1. ``changed`` goes
down both trees: only sections that the other tree lacks are opened, then paragraphs, then pieces.

The next document is found in one shuffle of the texts: rows are dealt into ranges of ids, the
first row of each range also goes to the range before it, and a window runs in each range.

Contract. A null text is empty; the empty text is one empty paragraph of one empty piece. Rows are in order
of id, null ids first, then of a hash of the text; repeated rows follow one another. The last row's next is
the first; a row alone is its own next. An empty table gives no rows. Extra columns are ignored. Words are
separated by spaces, so a paragraph without any is one piece. ``changed`` takes rows that share an id for
one document; nodes that only moved are on both sides and are not listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import whole_text

#: A piece begins at a word whose MD5 ends in one of these: three of sixteen.
CUTS = ("0", "1", "2")
#: Quantiles of the ids between which ranges are of equal width, and ranges for each shuffle partition.
QUANTILES, RANGES_IN_PARTITION = 64, 4

_ALL = 2**31 - 1


def pieces(paragraph: Column) -> Column:
    """The pieces of a paragraph; joined by spaces they are the paragraph."""

    def marked(word: Column) -> Column:
        # A paragraph holds no line feed, so one can stand for the space before a cut.
        return F.concat(F.when(F.substring(F.md5(word), 32, 1).isin(*CUTS), "\n").otherwise(" "), word)

    row = F.array_join(F.transform(F.split(paragraph, " ", -1), marked), "")
    return F.split(F.substring(row, 2, _ALL), "\n", -1)


def piece_rows(text: Column) -> Column:
    """For each paragraph the nodes of its pieces, in one string with a space between them."""
    return F.transform(
        F.split(text, "\n", -1), lambda p: F.array_join(F.transform(pieces(p), lambda q: F.sha2(q, 256)), " ")
    )


def section_rows(rows: Column) -> Column:
    """For each section the nodes of its paragraphs, from ``piece_rows``."""
    return F.split(F.array_join(F.transform(rows, lambda r: F.sha2(r, 256)), " "), "(?<=[08]) ")


def root(rows: Column) -> Column:
    """The fingerprint of a text with the ``piece_rows``, in lower-case hex."""
    return F.sha2(F.array_join(F.transform(section_rows(rows), lambda s: F.sha2(s, 256)), " "), 256)


def lowest(rows: Column) -> Column:
    """Numbers for the different lowest nodes in ``piece_rows``."""
    return F.array_distinct(F.transform(F.split(F.array_join(rows, " "), " "), lambda n: F.xxhash64(n)))


def likeness(root_a: Column, lowest_a: Column, root_b: Column, lowest_b: Column) -> Column:
    both = F.size(lowest_a) + F.size(lowest_b)
    common = 2.0 * F.size(F.array_intersect(lowest_a, lowest_b))
    return F.when(root_a == root_b, 1.0).otherwise(F.least(common / F.greatest(both, F.lit(1)), 1 - 1 / (2.0 + both)))


def tree(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, sections): every row's tree.

    Each section is the row of its paragraphs, each paragraph that of its pieces' nodes.
    """
    known = docs.select(F.col(doc_id).alias("doc_id"), piece_rows(whole_text(text)).alias("rows"))
    ended = known.select(
        "doc_id",
        "rows",
        root(F.col("rows")).alias("fingerprint"),
        # How many paragraphs each section has; a node is 64 characters, and one stands between two.
        F.transform(section_rows(F.col("rows")), lambda s: ((F.length(s) + 1) / 65).cast("int")).alias("sizes"),
    )
    ends = F.transform(
        F.sequence(F.lit(1), F.size("sizes")),
        lambda i: F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0), lambda total, n: total + n),
    )
    return ended.select("doc_id", "fingerprint", "rows", "sizes", ends.alias("ends")).select(
        "doc_id",
        "fingerprint",
        F.transform(
            F.arrays_zip("sizes", "ends"), lambda s: F.slice("rows", s["ends"] - s["sizes"] + 1, s["sizes"])
        ).alias("sections"),
    )


def _one_sided(nodes: DataFrame, place: list[str]) -> DataFrame:
    """Rows of (doc_id, side, node, ...) whose node the other side lacks, or has fewer times."""
    again = W.partitionBy("doc_id", "side", "node").orderBy(*place)
    met = W.partitionBy("doc_id", "node", "again")
    # Both windows are served by one shuffle.
    rows = nodes.repartition("doc_id", "node").withColumn("again", F.row_number().over(again))
    return rows.withColumn("sides", F.count("*").over(met)).filter("sides = 1").drop("again", "sides")


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """(doc_id, side, section, paragraph, piece, node): lowest nodes that only one of two trees has.

    ``side`` is ``before`` or ``after``; places count from 0 within the node above. Only documents that are on both
    sides with different roots are opened.
    """
    sides = [t.withColumn("side", F.lit(name)) for t, name in ((before, "before"), (after, "after"))]
    roots = sides[0].select("doc_id", "side", "fingerprint").unionByName(sides[1].select("doc_id", "side", "fingerprint"))
    differ = (
        roots.groupBy(F.col("doc_id").alias("id"))
        .agg(F.count_distinct("side").alias("sides"), F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high"))
        .filter("sides = 2 AND low <> high")
    )
    trees = sides[0].unionByName(sides[1]).join(differ, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    paragraphs = F.transform("children", lambda r: F.sha2(r, 256))
    opened = trees.select("doc_id", "side", F.posexplode("sections").alias("section", "children"))
    opened = opened.withColumn("node", F.sha2(F.array_join(paragraphs, " "), 256))
    place = ["section"]
    opened = _one_sided(opened, place)
    opened = opened.select("doc_id", "side", *place, F.posexplode("children").alias("paragraph", "row"))
    place = [*place, "paragraph"]
    opened = _one_sided(opened.withColumn("node", F.sha2("row", 256)), place)
    opened = opened.select("doc_id", "side", *place, F.posexplode(F.split("row", " ")).alias("piece", "node"))
    return _one_sided(opened, [*place, "piece"]).select("doc_id", "side", *place, "piece", "node")


def _cell_of(key: Column, bounds: list[float], low: int = 0) -> Column:
    """The number of ``bounds`` up to the key, by halving."""
    if not bounds:
        return F.lit(low)
    half = len(bounds) // 2
    return F.when(key < bounds[half], _cell_of(key, bounds[:half], low)).otherwise(
        _cell_of(key, bounds[half + 1 :], low + half + 1)
    )


def _range_of(rows: DataFrame, key: str) -> Column:
    """A range's number for each key, growing with it; there are as many as the session's partitions can use.

    Cells lie between quantiles; each is cut into ranges of equal width.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    bounds = sorted(set(rows.select(F.col(key).cast("double").alias(key)).approxQuantile(key, shares, 0.2 / QUANTILES)))
    if len(bounds) < 2:
        return F.lit(0)
    in_cell = -(-RANGES_IN_PARTITION * partitions // (len(bounds) - 1))
    value = F.col(key).cast("double")
    cell = F.least(F.greatest(_cell_of(value, bounds) - 1, F.lit(0)), F.lit(len(bounds) - 2))
    low, high = (F.element_at(F.array(*map(F.lit, b)), cell + 1) for b in (bounds[:-1], bounds[1:]))
    part = F.floor((value - low) / (high - low) * in_cell)
    return (cell * in_cell + F.least(F.greatest(part, F.lit(0)), F.lit(in_cell - 1))).cast("int")


def with_next(rows: DataFrame, key: str, tie: str, columns: list[str]) -> DataFrame:
    """``rows`` with the struct ``next``: ``columns`` of the row that follows by (key, tie), in a circle."""
    dealt = rows.withColumn("_range", _range_of(rows, key))
    # One row for each range.
    least = sorted(map(tuple, dealt.groupBy("_range").agg(F.min(F.struct(key, tie)).alias("_least")).collect()))
    if not least:
        return dealt.drop("_range").withColumn("next", F.struct(*columns))
    before = [(*least[i][1], least[i - 1][0]) for i in range(len(least))]
    to = rows.sparkSession.createDataFrame(before, f"{key} long, {tie} long, _to int")
    # Rows that repeat the first one are the same, so one of them is enough.
    whole = F.struct(*[F.col(c) for c in (key, tie, *[c for c in rows.columns if c not in (key, tie)])])
    firsts = rows.join(F.broadcast(to), [key, tie]).groupBy("_to").agg(F.min(whole).alias("_row"))
    firsts = firsts.select("_row.*", F.col("_to").alias("_range"))
    both = dealt.withColumn("_copy", F.lit(False)).unionByName(firsts.withColumn("_copy", F.lit(True)))
    order = W.partitionBy("_range").orderBy("_copy", key, tie)
    found = both.withColumn("next", F.lead(F.struct(*columns)).over(order))
    return found.filter(~F.col("_copy")).drop("_copy", "_range")


def with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses.

    The edited text has the last quarter of its characters (rounded down) replaced by as many of
    the next document's first, or all of them.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        whole_text(text).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("key"),
    ).withColumn("tie", F.xxhash64("text"))
    # Only texts are shuffled; their trees are made where they arrive.
    known = with_next(rows, "key", "tie", ["text"]).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next.text", F.lit(1), cut)
    )
    texts = known.select("doc_id", "n_chars", "text", edited.alias("edited"), F.col("next.text").alias("next"))
    trees = texts.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        *[piece_rows(F.col(t)).alias(t) for t in ("text", "edited", "next")],
    )
    nodes = trees.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        *[F.struct(root(F.col(t)).alias("root"), lowest(F.col(t)).alias("lowest")).alias(t) for t in ("text", "edited", "next")],
    )
    return nodes.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.col("text.root").alias("fingerprint"),
        F.col("edited.root").alias("edited_fingerprint"),
        *[
            likeness(*[F.col(f"{t}.{part}") for t in ("text", other) for part in ("root", "lowest")]).alias(name)
            for other, name in (("edited", "near_edited"), ("next", "near_next"))
        ],
    )
