"""From raw documents to packed training sequences, a stage for each cleaning step.

Each stage works on what the one before kept, written to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.llm import language, leaks, lines, packing, simhash, toxicity
from marquetry.llm.common import ship, table
from marquetry.session import bounded_batches, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes of texts that a Python step is sent at once.
BATCH = 4 << 20


def in_small_batches(stage: Stage) -> Stage:
    """``stage`` with its texts sent to Python some at a time, also where it runs without the others."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark, BATCH)
        return stage(spark, docs, sf_dir)

    return bounded


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learned from the labels that ``op6`` learns from."""
    labels = table(spark, sf_dir, "labels").filter(~language.held_out("doc_id", 3, 1))
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


@in_small_batches
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is similar to; ``n_chars`` is that of what is left."""
    left = lines.drop_lines(docs, short=True)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of linked fingerprints."""
    return simhash.keep_first_of_each(docs)


@in_small_batches
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return leaks.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: A trained classifier, similarity joins and a tokenizer are beyond SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
