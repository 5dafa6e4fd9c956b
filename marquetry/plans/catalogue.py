"""Landed API payloads to a track list in CSV and an employee collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import align_to
from ..schemas import ARTIST_PAYLOAD, PERSON_PAYLOAD
from ..session import staged
from ..sources.payloads import employee_documents, extraction_counts, read_payloads, track_rows
from ..sources.writers import write_collection, write_csv


def export_tracks(
    spark: SparkSession, landed: str | list[str], target: str, whole_files: bool = False
) -> DataFrame:
    """Write all tracks as CSV with a byte order mark.

    Returns the tracks per artist; an artist without a hit or a track counts 0.
    """
    payloads = read_payloads(spark, landed, ARTIST_PAYLOAD, whole_files)
    tracks = staged(track_rows(payloads), "tracks")
    write_csv(tracks, target, bom=True)
    artists = payloads.selectExpr("name AS artista").distinct()
    counted = align_to(artists, extraction_counts(tracks), ["artista"])
    return counted.fillna(0, subset=["faixas"])


def load_employees(
    spark: SparkSession,
    landed: str | list[str],
    target: str,
    whole_files: bool = False,
    fmt: str = "parquet",
    **options: str,
) -> None:
    """Replace the employee collection with the people of the payloads."""
    payloads = read_payloads(spark, landed, PERSON_PAYLOAD, whole_files)
    write_collection(employee_documents(payloads), target, fmt, **options)
