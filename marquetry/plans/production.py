"""Cleaning of people, productions and crew, with quality counters.

Each data set is reduced once to one row per key with the number of copies. Its counters are
observed while that frame is written, and what is written is parted by status, so that clean rows
and rejected lines are each read once. No pass is made for a counter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.presence import any_missing
from ..functions.text import (
    blank_to_null,
    clean_year,
    collapse_spaces,
    differs,
    int_corrected,
    tolerant_int,
    year_corrected,
)
from ..operators.ordering import most_common, most_common_by_label
from ..operators.projections import search
from ..schemas import CREW_RAW, PERSON_RAW, PRODUCTION_RAW
from ..session import dealt_into, staged
from ..sources.readers import CORRUPT, INVALID, LINE_ORDER, read_jsonl_tolerant, split_bad
from ..sources.sizes import folder_sizes, size_report
from ..sources.writers import write_collection, write_jsonl

# The names of the counters.
COUNTERS = [
    "lidos",
    "escritos",
    "duplicatas",
    "nulos_removidos",
    "titulos_nulos",
    "correcoes",
    "orfaos",
    "erros_parse",
]
# Lines whose id is not a whole number have a counter of their own.
INVALID_IDS = "ids_invalidos"
# Bytes of raw lines for each partition of a shuffle, so that a task's groups don't grow with the input, and
# bytes of shuffled rows up to which adaptive execution joins partitions.
PART_BYTES, JOINED_BYTES = 32 << 20, 16 << 20


def _n(condition: Column | None = None) -> Column:
    return F.count(F.lit(1) if condition is None else F.when(condition, True))


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _status(keys: list[str]) -> Column:
    bad = F.when(F.col(CORRUPT).isNotNull(), "parse").when(F.col(INVALID).isNotNull(), "invalid")
    return bad.when(any_missing(*keys), "null").otherwise("ok")


def _rejected() -> Column:
    """The text of a line that takes no part; equal ones are one row with its copies."""
    return F.coalesce(F.col(CORRUPT), F.col(INVALID))


def _extras(raw: DataFrame, *known: str) -> list[str]:
    """Columns beyond the known ones; they pass through unchanged."""
    return [c for c in raw.columns if c not in {CORRUPT, INVALID, "_tidy", *LINE_ORDER, *known}]


@dataclass(frozen=True)
class Fold:
    """How lines are reduced to a row for each of ``keys``, in parts that can be reduced again.

    ``partial`` reduces raw lines, ``merge`` parts of them, ``finish`` makes the rows of a report.
    """

    keys: tuple[str, ...]
    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]

    def __call__(self, raw: DataFrame) -> DataFrame:
        return self.finish(self.partial(raw))


def _key_fold(key: str, tidied: str, fields: Callable[[DataFrame], dict[str, Column]]) -> Fold:
    """One row per key: its copies and the fields of its first line in file order.

    Rows that lack the key collapse to one row, rejected lines to one row per text. The minimum
    combines on the map side, so a key with many copies is one row per task there.
    """
    by = ("status", key, "rejected")

    def partial(raw: DataFrame) -> DataFrame:
        raw = _tidied(raw, tidied)
        own = fields(raw)
        own = own | {c: F.col(c) for c in _extras(raw, key, *own)}
        status = _status([key])
        rows = raw.select(
            status.alias("status"),
            F.when(status == "ok", F.col(key)).alias(key),
            _rejected().alias("rejected"),
            F.struct(*LINE_ORDER, *[c.alias(name) for name, c in own.items()]).alias("row"),
        )
        return rows.groupBy(*by).agg(_n().alias("copies"), F.min("row").alias("row"))

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy(*by).agg(F.sum("copies").alias("copies"), F.min("row").alias("row"))

    def finish(parts: DataFrame) -> DataFrame:
        own = [f for f in parts.schema["row"].dataType.fieldNames() if f not in LINE_ORDER]
        return parts.select("status", key, "rejected", "copies", *[F.col(f"row.`{f}`").alias(f) for f in own])

    return Fold(by, partial, merge, finish)


def _tidied(raw: DataFrame, column: str) -> DataFrame:
    """Add the collapsed text as ``_tidy``: its own step, so that it is computed once."""
    return raw.withColumn("_tidy", collapse_spaces(F.col(column)))


def _person_fields(raw: DataFrame) -> dict[str, Column]:
    name, tidy = F.col("nome"), F.col("_tidy")
    return {"nome": blank_to_null(tidy), "corrections": differs(name, tidy).cast("int")}


def _production_fields(raw: DataFrame) -> dict[str, Column]:
    title, year, kind, tidy = (F.col(c) for c in ("titulo", "ano", "tipo_id", "_tidy"))
    corrections = (
        differs(title, tidy).cast("int")
        + year_corrected(year).cast("int")
        + int_corrected(kind).cast("int")
    )
    return {
        "titulo": blank_to_null(tidy),
        "ano": clean_year(year),
        "tipo_id": tolerant_int(kind),
        "corrections": corrections,
        "no_title": title.isNull().cast("int"),
    }


PEOPLE = _key_fold("id_pessoa", "nome", _person_fields)
PRODUCTIONS = _key_fold("id_producao", "titulo", _production_fields)


def people_by_key(raw: DataFrame) -> DataFrame:
    return PEOPLE(raw)


def productions_by_key(raw: DataFrame) -> DataFrame:
    return PRODUCTIONS(raw)


_CREW_IDS = ["id_producao", "id_pessoa"]
_CREW_KEYS = ("status", *_CREW_IDS, "papel", "rejected")


def _crew_partial(raw: DataFrame) -> DataFrame:
    status, tidy = _status(_CREW_IDS), F.col("_tidy")
    extras = _extras(raw, *_CREW_IDS, "papel")
    lines = [*LINE_ORDER, *extras] if extras else []
    counts = [_n().alias("copies"), F.sum("corrected").alias("corrections")]
    first = [F.min(F.struct(*lines)).alias("_first")] if extras else []
    rows = _tidied(raw, "papel").select(
        status.alias("status"),
        *[F.when(status == "ok", F.col(k)).alias(k) for k in _CREW_IDS],
        F.when(status == "ok", blank_to_null(tidy)).alias("papel"),
        differs(F.col("papel"), tidy).cast("int").alias("corrected"),
        _rejected().alias("rejected"),
        *lines,
    )
    return rows.groupBy(*_CREW_KEYS).agg(*counts, *first)


def _crew_merge(parts: DataFrame) -> DataFrame:
    first = [F.min("_first").alias("_first")] if "_first" in parts.columns else []
    sums = [F.sum(c).alias(c) for c in ("copies", "corrections")]
    return parts.groupBy(*_CREW_KEYS).agg(*sums, *first)


def _crew_finish(parts: DataFrame) -> DataFrame:
    if "_first" not in parts.columns:
        return parts
    extras = [f for f in parts.schema["_first"].dataType.fieldNames() if f not in LINE_ORDER]
    return parts.withColumns({c: F.col(f"_first.`{c}`") for c in extras}).drop("_first")


#: One row per (production, person, cleaned role): copies and corrections. Rows that lack a key collapse to one
#: row, rejected lines to one row per text. Other columns, if there are any, come from the first line in file order.
CREW = Fold(_CREW_KEYS, _crew_partial, _crew_merge, _crew_finish)


def fold_crew(raw: DataFrame) -> DataFrame:
    return CREW(raw)


def flag_orphans(
    folded: DataFrame, people: DataFrame, productions: DataFrame
) -> DataFrame:
    """Folded crew with status ``orphan`` where the person or production is unknown.

    Copies were folded before; adaptive execution splits a key that still has many rows.
    """
    person = people.select("id_pessoa").distinct().withColumn("_person", F.lit(True))
    production = productions.select("id_producao").distinct().withColumn("_work", F.lit(True))
    known = folded.join(person, "id_pessoa", "left")
    known = known.join(production, "id_producao", "left")
    orphan = (F.col("status") == "ok") & (F.col("_person").isNull() | F.col("_work").isNull())
    return known.withColumn("status", F.when(orphan, "orphan").otherwise(F.col("status"))).drop(
        "_person", "_work"
    )


def crew_by_key(raw: DataFrame, people: DataFrame, productions: DataFrame) -> DataFrame:
    """Folded crew with its orphans flagged."""
    return flag_orphans(fold_crew(raw), people, productions)


def clean_rows(by_key: DataFrame) -> DataFrame:
    """The rows to keep, without the bookkeeping columns."""
    extra = [c for c in ("status", "rejected", "copies", "corrections", "no_title") if c in by_key.columns]
    return by_key.filter(F.col("status") == "ok").drop(*extra)


def rejected_lines(by_key: DataFrame) -> DataFrame:
    """The lines that took no part: why, their text, and how often they occur."""
    kept = by_key.filter(F.col("status").isin("parse", "invalid"))
    return kept.select(F.col("status").alias("reason"), F.col("rejected").alias("line"), "copies")


def counters(by_key: DataFrame) -> list[Column]:
    """Aggregates over a data set: lidos = escritos + duplicatas + nulos + orfaos + erros + invalidos."""
    ok = F.col("status") == "ok"
    copies = F.col("copies")
    no_title = F.col("no_title") if "no_title" in by_key.columns else F.lit(0)
    return [
        _total(copies).alias("lidos"),
        _n(ok).alias("escritos"),
        _total(F.when(ok, copies - 1)).alias("duplicatas"),
        _total(F.when(F.col("status") == "null", copies)).alias("nulos_removidos"),
        _total(F.when(ok, no_title).cast("long")).alias("titulos_nulos"),
        _total(F.when(ok, F.col("corrections")).cast("long")).alias("correcoes"),
        _total(F.when(F.col("status") == "orphan", copies)).alias("orfaos"),
        _total(F.when(F.col("status") == "parse", copies)).alias("erros_parse"),
        _total(F.when(F.col("status") == "invalid", copies)).alias(INVALID_IDS),
    ]


def quality_report(by_key: DataFrame, dataset: str) -> DataFrame:
    """Counters of one data set, by a pass over it."""
    return by_key.agg(*counters(by_key)).select(F.lit(dataset).alias("dataset"), *COUNTERS, INVALID_IDS)


def observed(by_key: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``by_key``, and its counters, which are there when the returned frame has been written once.

    The frame is to be written as it is, without a shuffle behind it: counted are the tasks that
    write, each once however often it is tried. Filters behind the frame stay behind the counters.
    """
    seen = Observation(name)
    return by_key.observe(seen, *counters(by_key)), seen


def observed_report(spark: SparkSession, seen: Mapping[str, Observation]) -> DataFrame:
    """The counters of several data sets that have been written; waits for those that have not."""
    rows = [(name, *(found.get[c] for c in (*COUNTERS, INVALID_IDS))) for name, found in seen.items()]
    fields = ", ".join(f"{c} long" for c in (*COUNTERS, INVALID_IDS))
    return spark.createDataFrame(rows, f"dataset string, {fields}")


def _staged_by_status(by_key: DataFrame, name: str) -> DataFrame:
    """Written in a folder for each status, so that a reader of one status reads no other row."""
    return staged(by_key, name, ["status"])


def _together(*jobs: Callable) -> list:
    """Run independent Spark jobs at the same time, so that none leaves the cluster idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def run(
    spark: SparkSession,
    source: str,
    target: str,
    mode: str = "errorifexists",
    more_fields: Mapping[str, StructType] | None = None,
) -> DataFrame:
    """Clean ``pessoa``, ``producao`` and ``equipe`` JSON lines; returns the counters.

    Clean rows go to ``<name>_clean``, lines that take no part to ``<name>_rejects``.

    ``mode="overwrite"`` replaces the output of an earlier run. ``more_fields`` names
    further fields per data set, which are kept as they are.

    Shuffles have a partition for each PART_BYTES of lines, or as many as the session asks for.
    """
    names = ("pessoa", "producao", "equipe")
    sizes = folder_sizes(spark, {name: f"{source}/{name}.jsonl" for name in names}, "bytes")
    parts = -(-max(r["bytes"] for r in sizes.collect()) // PART_BYTES)
    with dealt_into(spark, parts, JOINED_BYTES):
        return _run(spark, source, target, mode, more_fields)


def _run(
    spark: SparkSession, source: str, target: str, mode: str, more_fields: Mapping[str, StructType] | None
) -> DataFrame:
    def raw(name: str, schema: StructType) -> DataFrame:
        more = (more_fields or {}).get(name, StructType())
        fields = StructType([*schema.fields, *more.fields])
        return read_jsonl_tolerant(spark, f"{source}/{name}.jsonl", fields)

    seen: dict[str, Observation] = {}

    def counted(by_key: DataFrame, name: str) -> DataFrame:
        shown, seen[name] = observed(by_key, name)
        return shown

    people, productions, folded = _together(
        lambda: _staged_by_status(counted(people_by_key(raw("pessoa", PERSON_RAW)), "pessoa"), "pessoa"),
        lambda: _staged_by_status(counted(productions_by_key(raw("producao", PRODUCTION_RAW)), "producao"), "producao"),
        lambda: _staged_by_status(fold_crew(raw("equipe", CREW_RAW)), "equipe-folded"),
    )
    # Orphans are known only while the clean crew is written: its counters are those of all rows that come by.
    flagged = counted(flag_orphans(folded, clean_rows(people), clean_rows(productions)), "equipe")
    clean = {"pessoa": people, "producao": productions, "equipe": flagged}
    folds = {"pessoa": people, "producao": productions, "equipe": folded}
    _together(
        *[partial(write_jsonl, clean_rows(df), f"{target}/{name}_clean", mode=mode) for name, df in clean.items()],
        *[partial(write_jsonl, rejected_lines(df), f"{target}/{name}_rejects", mode=mode) for name, df in folds.items()],
    )
    return observed_report(spark, {name: seen[name] for name in clean})


def size_comparison(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Megabytes of each data set before and after ``run``."""
    names = ("pessoa", "producao", "equipe")
    return size_report(
        spark,
        {name: f"{source}/{name}.jsonl" for name in names},
        {name: f"{target}/{name}_clean" for name in names},
    )


def load_collection(
    spark: SparkSession,
    path: str,
    schema: StructType,
    target: str,
    keys: list[str],
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Replace a collection with the documents of a JSON lines file; one row of counters.

    ``repetidos`` counts keys that occur more than once, which a unique key forbids.
    """
    documents = staged(read_jsonl_tolerant(spark, path, schema).drop(*LINE_ORDER), "documents")
    good, _ = split_bad(documents)
    write_collection(good, target, fmt, **options)
    ok = F.col("_ok")
    per_key = (
        documents.select(_rejected().isNull().alias("_ok"), *keys)
        .select(ok, *[F.when(ok, F.col(k)).alias(k) for k in keys])
        .groupBy("_ok", *keys)
        .agg(_n().alias("_n"))
    )
    return per_key.agg(
        _total(F.when(ok, F.col("_n"))).alias("documentos"),
        _total(F.when(~ok, F.col("_n"))).alias("erros"),
        _n(ok & (F.col("_n") > 1)).alias("repetidos"),
    )


def productions_per_year(productions: DataFrame, k: int = 20) -> DataFrame:
    """Years with the most titles, in year order and as labels."""
    return most_common_by_label(productions, "ano", k)


def common_roles(crew: DataFrame, k: int = 10) -> DataFrame:
    return most_common(crew, "papel", k)


def search_titles(productions: DataFrame, pattern: str, limit: int = 50) -> DataFrame:
    return search(productions, "titulo", pattern, "id_producao", limit)
