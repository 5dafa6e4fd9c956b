"""Questions about historical epidemics (columns of ``schemas.OUTBREAK``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.presence import all_present
from ..operators.ordering import top_k
from ..operators.projections import above_average, at_maximum

EVENT = "Nome_Evento"


def deadliest(df: DataFrame, k: int = 10) -> DataFrame:
    columns = [EVENT, "Ano_Inicio", "Regiao_Origem", "Mortes_Estimadas"]
    return top_k(df.select(*columns), "Mortes_Estimadas", EVENT, k)


def most_widespread(df: DataFrame, k: int = 10) -> DataFrame:
    columns = [EVENT, "Tipo_Patogeno", "Porcentagem_Disseminacao"]
    return top_k(df.select(*columns), "Porcentagem_Disseminacao", EVENT, k)


def costliest(df: DataFrame) -> DataFrame:
    columns = [EVENT, "Ano_Inicio", "Ano_Fim", "Impacto_Economico_Bilhao_USD"]
    return at_maximum(df.select(*columns), "Impacto_Economico_Bilhao_USD")


def above_mean_fatality(df: DataFrame) -> DataFrame:
    return above_average(df.select(EVENT, "Mortes_Estimadas", "Taxa_Fatalidade"), "Taxa_Fatalidade")


def spread_and_deaths_by_pathogen(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("Tipo_Patogeno")
        .agg(
            F.avg("Porcentagem_Disseminacao").alias("media_disseminacao"),
            F.sum("Mortes_Estimadas").alias("total_mortes"),
        )
        .orderBy(F.desc_nulls_last("total_mortes"), "Tipo_Patogeno")
    )


def deaths_by_continents(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("Continentes_Afetados", EVENT)
        .agg(F.sum("Mortes_Estimadas").alias("total_mortes"))
        .orderBy(F.desc_nulls_last("total_mortes"), "Continentes_Afetados", EVENT)
    )


def impact_by_era(df: DataFrame) -> DataFrame:
    """Mean economic impact per era and medical advance; rows without a key are left out."""
    keys = ["Era", "Avanco_Medico"]
    return (
        df.filter(all_present(*keys))
        .groupBy(*keys)
        .agg(F.avg("Impacto_Economico_Bilhao_USD").alias("impacto_medio"))
        .orderBy(*keys)
    )


def fatality_points(df: DataFrame) -> DataFrame:
    """Columns of the fatality against deaths comparison."""
    return df.select("Taxa_Fatalidade", "Mortes_Estimadas", "Tipo_Patogeno", "Continentes_Afetados")
