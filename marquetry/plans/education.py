"""Teachers per classroom and their growth, from a wide table by locality and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import parse_ptbr, ratio
from ..functions.presence import all_present
from ..operators.projections import equals_if
from ..operators.reshape import melt, split_label
from ..operators.windows import pct_change

# The two variables of the wide table.
TEACHERS = "Docentes - Total (número)"
CLASSROOMS = "Salas de Aula Utilizadas - Total (número)"


def long_table(wide: DataFrame, years: Sequence[str]) -> DataFrame:
    """One row (Localidade, Ano, Docentes, Salas) per locality and year with both values."""
    numbers = wide.withColumns({y: parse_ptbr(F.col(f"`{y}`")).cast("double") for y in years})
    by_year = melt(numbers, ["Localidade", "Variável"], years, "Ano", "valor")
    both = split_label(
        by_year.withColumn("Ano", F.col("Ano").cast("int")),
        ["Localidade", "Ano"],
        "Variável",
        {TEACHERS: "Docentes", CLASSROOMS: "Salas"},
        F.col("valor"),
    )
    return both.filter(all_present("Docentes", "Salas"))


def kpi_table(long: DataFrame) -> DataFrame:
    """The three indicators; a first year, without growth, shows 0."""
    gap = F.col("KPI_2_Cresc_Docentes_Percent") - F.col("Aux_Cresc_Salas_Percent")
    return (
        long.withColumns(
            {
                "KPI_1_Docente_por_Sala": ratio(F.col("Docentes"), F.col("Salas")),
                "KPI_2_Cresc_Docentes_Percent": pct_change("Docentes", "Localidade", "Ano"),
                "Aux_Cresc_Salas_Percent": pct_change("Salas", "Localidade", "Ano"),
            }
        )
        .withColumn("KPI_3_Descompasso_Docentes_vs_Salas_Percent", F.round(gap, 2))
    )


def of_locality(kpis: DataFrame, locality: str | None = None) -> DataFrame:
    """One locality, or all without a name, in order."""
    return equals_if(kpis, Localidade=locality).orderBy("Localidade", "Ano")


def latest_summary(kpis: DataFrame) -> DataFrame:
    """Totals and means of the last year."""
    # A row for each year, of which the last is taken: the indicators are computed once.
    return kpis.groupBy("Ano").agg(
        F.sum("Docentes").alias("total_docentes"),
        F.sum("Salas").alias("total_salas"),
        F.round(F.avg("KPI_1_Docente_por_Sala"), 2).alias("media_docente_por_sala"),
        F.round(F.avg("KPI_2_Cresc_Docentes_Percent"), 1).alias("cresc_medio_docentes"),
    ).orderBy(F.desc("Ano")).limit(1)
