"""Nested payloads, as landed by a collector, to flat rows.

The JSON reader parses each payload once, in the scan, and only the fields in use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import default_to, full_name
from ..operators.projections import threshold

# The age from which a person manages, and what each role earns.
MANAGER_AGE = 30
ROLES = ("Desenvolvedor", "Gerente")
SALARIES = (7000, 12000)
SECTOR = "TI"
NO_DATE = "N/A"


def read_payloads(
    spark: SparkSession, path: str | list[str], schema: StructType, whole_files: bool = False
) -> DataFrame:
    """Landed payloads, one per line or one per file."""
    return spark.read.schema(schema).option("multiLine", whole_files).json(path)


def employee_documents(payloads: DataFrame) -> DataFrame:
    """``PERSON_PAYLOAD`` rows as employee documents: role and salary follow from the age."""
    people = payloads.select(F.explode("results").alias("p"))
    age = F.col("p.dob.age")
    return people.select(
        full_name(F.col("p.name.first"), F.col("p.name.last")).alias("nome"),
        age.alias("idade"),
        F.col("p.email").alias("email"),
        F.col("p.phone").alias("telefone"),
        threshold(age, MANAGER_AGE, *ROLES).alias("cargo"),
        threshold(age, MANAGER_AGE, *SALARIES).alias("salario"),
        F.lit(SECTOR).alias("setor"),
    )


def track_rows(payloads: DataFrame) -> DataFrame:
    """``ARTIST_PAYLOAD`` rows as one row per track; an artist without a hit gives none."""
    albums = payloads.filter(F.size("artists.items") > 0).select(
        F.col("name").alias("artista"), F.explode("albums").alias("a")
    )
    tracks = albums.select("artista", "a", F.explode("a.tracks").alias("t"))
    return tracks.select(
        F.col("t.name").alias("musica"),
        "artista",
        F.col("a.name").alias("album"),
        default_to(F.col("a.release_date"), NO_DATE).alias("data_lancamento"),
    )


def extraction_counts(tracks: DataFrame) -> DataFrame:
    """Tracks per artist."""
    return tracks.groupBy("artista").agg(F.count(F.lit(1)).alias("faixas"))
