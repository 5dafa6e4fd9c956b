"""Substring search that prunes: a table of trigrams and ids, intersected, then verified on the rows found.

Texts are folded (upper case, then lower case) and each of their different three-letter strings is listed with
the row's id, dealt into buckets by trigram. A search reads the buckets of its own trigrams, keeps ids that have
all of them, joins them to the table, and applies the pattern itself. So false hits are impossible,
and a row that matches has all trigrams of the pattern. Patterns that folding isn't proven for (under three
letters, letters beyond Latin-1, regular expressions that are more than a text) scan the table.

An id is a row's key: unique and not NULL. NULL texts match nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import contains_any, matches
from .buckets import BUCKETS, BucketedTable

SIZE = 3
_PLAIN = re.compile(r"[A-Za-z0-9 ]+")
# The dot that a dotted capital I leaves when lower-cased.
_DOT_ABOVE = "̇"


def folded(c: Column) -> Column:
    return F.replace(F.lower(F.upper(c)), F.lit(_DOT_ABOVE), F.lit(""))


def _trigrams(text: Column) -> Column:
    """Different trigrams of a folded text; none of a shorter one."""
    places = F.sequence(F.lit(1), F.char_length(text) - SIZE + 1)
    all_of_them = F.transform(places, lambda i: F.substring(text, i, F.lit(SIZE)))
    return F.when(F.char_length(text) >= SIZE, F.array_distinct(all_of_them))


class TrigramIndex:
    """Rows of a table below ``root`` and the trigrams of its text ``columns``."""

    def __init__(self, rows: DataFrame, root: str, key: str, columns: Sequence[str], buckets: int = BUCKETS):
        spark: SparkSession = rows.sparkSession
        self.key, self.columns = key, list(columns)
        self.table = BucketedTable(spark, f"{root.rstrip('/')}/rows", key, rows.schema, buckets)
        self.table.create(rows)
        found = [
            self.table.read().select(F.explode(_trigrams(folded(F.col(c)))).alias("gram"), F.lit(i).alias("field"), F.col(key).alias("id"))
            for i, c in enumerate(self.columns)
        ]
        listed = found[0]
        for more in found[1:]:
            listed = listed.unionByName(more)
        self.grams = BucketedTable(spark, f"{root.rstrip('/')}/grams", "gram", listed.schema, buckets)
        self.grams.create(listed)

    def _pieces(self, term: str) -> list[str] | None:
        """The trigrams of a term; None where the table has to be scanned."""
        if any(ord(c) > 255 for c in term):
            return None
        one = self.table.spark.range(1).select(_trigrams(folded(F.lit(term))))
        return one.first()[0] or None

    def _candidates(self, term: str) -> DataFrame:
        pieces = self._pieces(term)
        if pieces is None:
            return self.table.read()
        listed = self.grams.of_keys(pieces)
        met = listed.groupBy("field", "id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(pieces))
        return self.table.read().join(met.select(F.col("id").alias(self.key)), self.key, "left_semi")

    def containing(self, term: str) -> DataFrame:
        """Rows with ``term`` in any of the columns, regardless of case; all rows for an empty term."""
        return self._candidates(term).filter(contains_any(term, *[F.col(c) for c in self.columns]))

    def matching(self, pattern: str, limit: int = 50) -> DataFrame:
        """First rows by key of which a column matches the pattern, regardless of case."""
        rows = self._candidates(pattern) if _PLAIN.fullmatch(pattern) else self.table.read()
        hit = F.lit(False)
        for c in self.columns:
            hit = hit | F.coalesce(matches(F.col(c), pattern), F.lit(False))
        return rows.filter(hit).orderBy(self.key).limit(limit)
