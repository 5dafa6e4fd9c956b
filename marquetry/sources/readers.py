"""Scans. Schemas are explicit: no inference pass over the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.numbers import ptbr_double, thousands_double
from ..functions.text import decode_base64, encode_base64
from ..operators.ordering import top_k
from ..operators.projections import equals_if, trim_headers
from .versions import current_path

CORRUPT = "_corrupt_record"
# The text of a line that parses but holds something else in a field of whole numbers.
INVALID = "_invalid_number"
# Position of a line in its input: file path, start of the split, running number in the task.
LINE_ORDER = ["_file", "_split", "_line"]


def read_jsonl(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _whole(text: Column) -> Column:
    """A whole number in any of its forms (``2``, ``3.0``, ``4e1``); NULL for anything else.

    Decimals are judged by the text: no cast rounds them away.
    """
    shown = F.upper(F.trim(text))
    mantissa = F.substring_index(shown, "E", 1)
    decimals = F.when(
        F.contains(mantissa, F.lit(".")), F.length(F.rtrim(F.substring_index(mantissa, ".", -1), F.lit("0")))
    ).otherwise(0)
    exponent = F.when(F.contains(shown, F.lit("E")), F.substring_index(shown, "E", -1).try_cast("int")).otherwise(0)
    return F.when(decimals <= exponent, shown.try_cast("decimal(38,10)").try_cast("bigint"))


def parse_lines(lines: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Parse one JSON object per row; a line that is none keeps its text in ``_corrupt_record``.

    Fields of type long take whole numbers written as numbers or as text. A line where one
    of them holds something else keeps its text in ``_invalid_number``; the field is NULL.
    """
    whole_fields = [f.name for f in schema.fields if isinstance(f.dataType, LongType)]
    read_as = [StructField(f.name, StringType()) if f.name in whole_fields else f for f in schema.fields]
    with_corrupt = StructType([*read_as, StructField(CORRUPT, StringType())])
    line = F.col(column)
    options = {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"}
    parsed = lines.withColumns(
        {
            "_doc": F.from_json(line, with_corrupt, options),
            "_text": F.rtrim(line, F.lit(" \t\r")),
        }
    )
    # The parser stops after the first object. Where a line may go on behind it, the line
    # and a zero must make an array of two.
    text = F.col("_text")
    may_go_on = F.instr(text, "}") < F.length(text)
    pair = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    whole = F.coalesce(text.endswith("}"), F.lit(False))
    bad = (
        F.when(~whole, F.coalesce(line, F.lit("")))
        .when(may_go_on & ~pair.eqNullSafe(F.lit(2)), line)
        .otherwise(F.col(f"_doc.{CORRUPT}"))
    )
    kept = [c for c in lines.columns if c != column]
    values = {f.name: F.col(f"_doc.{f.name}") for f in schema.fields}
    values |= {name: _whole(values[name]) for name in whole_fields}
    parsed = parsed.select(
        *[c.alias(name) for name, c in values.items()],
        bad.alias(CORRUPT),
        *[F.col(f"_doc.{name}").alias(f"_as_{name}") for name in whole_fields],
        line.alias("_whole_line"),
        *kept,
    )
    odd = F.lit(False)
    for name in whole_fields:
        odd = odd | (F.col(f"_as_{name}").isNotNull() & F.col(name).isNull())
    invalid = F.when(F.col(CORRUPT).isNull() & odd, F.col("_whole_line"))
    return parsed.select(*values, CORRUPT, invalid.alias(INVALID), *kept)


def read_jsonl_tolerant(
    spark: SparkSession, path: str | list[str], schema: StructType
) -> DataFrame:
    """One row per line, blank and broken lines included, with the line's position.

    The position columns give file order for an unchanged set of files.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return parse_lines(lines, schema)


def stream_lines(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """(value, _file, _split): lines of files as they land; ``options`` are those of the file source."""
    return spark.readStream.format("text").options(**options).load(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split")
    )


def parse_batch(lines: DataFrame, schema: StructType) -> DataFrame:
    """A micro-batch of ``stream_lines`` as ``read_jsonl_tolerant`` reads it; a stream itself has no line numbers."""
    return parse_lines(lines.withColumn("_line", F.monotonically_increasing_id()), schema)


def split_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the text of the bad ones."""
    bad = F.coalesce(F.col(CORRUPT), F.col(INVALID))
    good = df.filter(bad.isNull()).drop(CORRUPT, INVALID)
    return good, df.filter(bad.isNotNull()).select(bad.alias(CORRUPT))


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = ","
) -> DataFrame:
    """CSV with a header line. A byte order mark is dropped by the reader."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def read_csv_text(
    spark: SparkSession, path: str | list[str], sep: str = ","
) -> DataFrame:
    """CSV with all columns as text, headers and cells trimmed."""
    raw = trim_headers(spark.read.option("header", True).option("sep", sep).csv(path))
    return raw.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_csv_ptbr(
    spark: SparkSession, path: str | list[str], numbers: Iterable[str], sep: str = ";"
) -> DataFrame:
    """Semicolon CSV; the listed columns hold numbers such as ``13.007,12``."""
    df = read_csv_text(spark, path, sep)
    return df.withColumns({c: ptbr_double(F.col(c)) for c in numbers})


def read_csv_thousands(
    spark: SparkSession, path: str | list[str], numbers: Iterable[str], sep: str = ","
) -> DataFrame:
    """CSV whose listed columns hold numbers such as ``1,234.5``."""
    df = read_csv_text(spark, path, sep)
    return df.withColumns({c: thousands_double(F.col(c)) for c in numbers})


def read_collection(
    spark: SparkSession, source: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """The newest complete version of a collection written by ``write_collection``, or files as they are.

    ``fmt="mongodb"`` needs that connector; its connection settings come from the Spark configuration.
    """
    reader = spark.read.format(fmt).options(**options)
    return reader.option("collection", source).load() if fmt == "mongodb" else reader.load(current_path(spark, source))


def find(
    collection: DataFrame,
    equals: Mapping | None = None,
    key: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Documents that match all given fields; with a limit, the first by key."""
    found = equals_if(collection, **(equals or {}))
    if limit is None:
        return found
    if key is None:
        raise ValueError("a limit needs a key to order by")
    return found.orderBy(key).limit(limit)


def load_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A frame of literal rows."""
    return spark.createDataFrame(list(rows), schema)


def frame_from_columns(
    spark: SparkSession, columns: Mapping[str, Sequence], schema: StructType | str
) -> DataFrame:
    """A frame from equally long literal columns."""
    return load_rows(spark, list(zip(*columns.values(), strict=True)), schema)


def frame_from_records(
    spark: SparkSession, records: Sequence[Mapping], schema: StructType
) -> DataFrame:
    """A frame from literal records; a missing field is NULL."""
    rows = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return load_rows(spark, rows, schema)


def binary_table(spark: SparkSession, path: str | list[str], folder: str | None = None) -> DataFrame:
    """Binary files as rows (nome, dados_base64); with ``folder="nome"`` the folder names the row."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1 if folder is None else -2).alias("nome"),
        encode_base64(F.col("content")).alias("dados_base64"),
    )


def binary_content(images: DataFrame) -> DataFrame:
    """Base64 rows back to bytes."""
    return images.select("id", "nome", decode_base64(F.col("dados_base64")).alias("content"))


def latest_binary(images: DataFrame) -> DataFrame:
    """The bytes of the row with the largest id."""
    return binary_content(top_k(images, "id", "nome", 1))


def read_backup(
    spark: SparkSession, path: str, schemas: Mapping[str, StructType]
) -> dict[str, DataFrame]:
    """The tables of a backup written by ``write_backup``."""
    return {name: read_jsonl(spark, f"{path}/{name}", st) for name, st in schemas.items()}
