"""File sources and sinks: traces, prompt corpora, CSV exports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schema import CORRUPT, TRACES

# Quotes are doubled, blanks at both ends are kept and texts may hold line breaks.
CSV_WRITE = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
CSV_READ = {**CSV_WRITE, "multiLine": True}


class MissingInput(FileNotFoundError):
    """The input of a step does not exist."""


def _guarded(read, path: str) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(f"{path} not found") from error
        raise


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _guarded(reader.parquet, path)


def read_traces(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Traces as JSON lines or parquet; a JSON payload keeps its kind as VARIANT.

    A JSON line that cannot be read is a row of nulls with the line in ``_corrupt_record``;
    ``ingest.quarantined_traces`` lists these.
    """
    if file_format == "json":
        schema = T.StructType([*TRACES, T.StructField(CORRUPT, T.StringType())])
        reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
        return _guarded(reader.json, path)
    return read_table(spark, path)


def read_prompts(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """A prompt corpus with columns ``prompt_index, category, prompt``."""
    reader = spark.read.schema("prompt_index int, category string, prompt string")
    if file_format == "csv":
        reader = reader.options(**CSV_READ)
    return _guarded(reader.format(file_format).load, path)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 100_000
) -> None:
    """Write CSV in files of at most ``rows_per_file`` rows. Texts hold line ends, so a file cannot
    be split: it is read by one task, and more files are what lets more tasks read."""
    writer = df.write.mode(mode).options(**CSV_WRITE).option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _guarded(spark.read.schema(schema).options(**CSV_READ).csv, path)


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, timestamps as milliseconds, the rest as it is."""

    def flat(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            return F.to_json(col).alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_millis(col).alias(field.name)
        return col

    return df.select(*[flat(field) for field in df.schema])
