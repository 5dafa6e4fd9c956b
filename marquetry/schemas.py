"""Schemas and fixed value sets of the data sets the jobs work on."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


# Artistic production, as landed: the year and the type may hold dirty text.
PERSON_RAW = _struct(("id_pessoa", LongType()), ("nome", StringType()))
PRODUCTION_RAW = _struct(
    ("id_producao", LongType()),
    ("titulo", StringType()),
    ("ano", StringType()),
    ("tipo_id", StringType()),
)
CREW_RAW = _struct(
    ("id_producao", LongType()), ("id_pessoa", LongType()), ("papel", StringType())
)

# Ledger.
TRANSACTION = _struct(
    ("id", StringType(), False),
    ("date", DateType(), False),
    ("description", StringType(), False),
    ("category", StringType(), False),
    ("type", StringType(), False),
    ("value", DoubleType(), False),
    ("recurring_id", StringType()),
    ("created_at", TimestampType()),
)
RECURRING = _struct(
    ("id", StringType(), False),
    ("description", StringType(), False),
    ("category", StringType(), False),
    ("type", StringType(), False),
    ("value", DoubleType(), False),
    ("day_of_month", IntegerType(), False),
    ("active", IntegerType()),
    ("created_at", TimestampType()),
)
GOAL = _struct(("category", StringType(), False), ("limit_value", DoubleType(), False))
CATEGORY = _struct(("name", StringType(), False), ("icon", StringType()), ("color", StringType()))

INCOME = "receita"
EXPENSE = "despesa"
INVESTMENT_CATEGORY = "Investimentos"
OTHER_CATEGORY = "Outros"

# Category label, icon and colour.
CATEGORIES = [
    ("Alimentação", "🍽️", "#e17055"),
    ("Aluguel", "🏠", "#6c5ce7"),
    ("Salário", "💼", "#00b894"),
    ("Lazer", "🎮", "#fdcb6e"),
    ("Transporte", "🚗", "#0984e3"),
    ("Contas", "📄", "#e84393"),
    ("Saúde", "🏥", "#00cec9"),
    ("Educação", "📚", "#a29bfe"),
    ("Investimentos", "📈", "#55efc4"),
    ("Freelance", "💻", "#74b9ff"),
    ("Outros", "📦", "#636e72"),
]

# Nested payloads.
PERSON_PAYLOAD = _struct(
    (
        "results",
        ArrayType(
            _struct(
                ("name", _struct(("first", StringType()), ("last", StringType()))),
                ("dob", _struct(("age", IntegerType()))),
                ("email", StringType()),
                ("phone", StringType()),
            )
        ),
    )
)
ARTIST_PAYLOAD = _struct(
    ("name", StringType()),
    ("artists", _struct(("items", ArrayType(_struct(("id", StringType())))))),
    (
        "albums",
        ArrayType(
            _struct(
                ("id", StringType()),
                ("name", StringType()),
                ("release_date", StringType()),
                ("tracks", ArrayType(_struct(("name", StringType())))),
            )
        ),
    ),
)
TRACK = _struct(
    ("musica", StringType()),
    ("artista", StringType()),
    ("album", StringType()),
    ("data_lancamento", StringType()),
)

# Outbreaks.
OUTBREAK = _struct(
    ("Nome_Evento", StringType()),
    ("Nome_Patogeno", StringType()),
    ("Tipo_Patogeno", StringType()),
    ("Ano_Inicio", IntegerType()),
    ("Ano_Fim", IntegerType()),
    ("Duracao_Anos", IntegerType()),
    ("Regiao_Origem", StringType()),
    ("Propagacao_Geografica", StringType()),
    ("Continentes_Afetados", IntegerType()),
    ("Casos_Estimados", LongType()),
    ("Mortes_Estimadas", LongType()),
    ("Taxa_Fatalidade", DoubleType()),
    ("Transmissao_Primaria", StringType()),
    ("Metodo_Contencao", StringType()),
    ("Impacto_Economico_Bilhao_USD", DoubleType()),
    ("Avanco_Medico", BooleanType()),
    ("Era", StringType()),
    ("Classificacao_OMS", StringType()),
    ("Escala_Mortalidade", StringType()),
    ("Porcentagem_Disseminacao", DoubleType()),
    ("Seculo", StringType()),
)

# Telemetry: three acceleration and three rotation axes, high and low byte each.
AXES = ["ax", "ay", "az", "gx", "gy", "gz"]
SENSOR_RAW = _struct(
    ("device", StringType()),
    ("ts", TimestampType()),
    *[(f"{axis}_{half}", IntegerType()) for axis in AXES for half in ("h", "l")],
)

# Key/value logs and base64 table.
KV_LOG = _struct(("seq", LongType(), False), ("key", StringType(), False), ("value", StringType()))
LIST_LOG = _struct(("seq", LongType(), False), ("key", StringType(), False), ("item", StringType()))
HASH_LOG = _struct(
    ("seq", LongType(), False),
    ("key", StringType(), False),
    ("field", StringType(), False),
    ("value", StringType()),
)
IMAGE = _struct(
    ("id", LongType(), False), ("nome", StringType(), False), ("dados_base64", StringType(), False)
)
