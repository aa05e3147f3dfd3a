"""Batch readers by format name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidegate.options import ConvertOptions
from tidegate.sources import hadoop, split_files

# Date and timestamp patterns of the CSV dialect.
CSV_DATE = "yyyy-MM-dd"
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

#: Spark source and options for each format name.
FORMATS: dict[str, tuple[str, dict[str, str]]] = {
    "CSV": ("csv", {"header": "true"}),
    "TSV": ("csv", {"header": "true", "sep": "\t"}),
    "JSON": ("json", {}),
    "JSONL": ("json", {}),
    "NDJSON": ("json", {}),
    "JSON_ARRAY": ("json", {"multiLine": "true"}),
    "PARQUET": ("parquet", {}),
}


def check_input(spark: SparkSession, path: str | list[str]) -> None:
    """Refuse inputs that cannot be read, before any plan is made."""
    for one in [path] if isinstance(path, str) else path:
        if one.lower().endswith(".zip"):
            raise ValueError(f"compression format not yet supported: .zip ({one})")
    # Spark itself refuses a missing path of a list when it lists the files.
    if isinstance(path, str) and not hadoop.matches(spark, path):
        raise FileNotFoundError(f"Input file not found: {path}")


def read(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "CSV",
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read ``path`` as the named format.

    Without a schema the types of CSV columns are inferred, which reads the data once more;
    pass ``schema`` for large inputs. Caller options win over the format's own.
    Compressed files are recognised by suffix (.gz, .gzip, .bz2).
    """
    name = file_format.upper()
    if name not in FORMATS:
        raise ValueError(f"Unsupported file format: {file_format}")
    check_input(spark, path)
    source, defaults = FORMATS[name]
    reader = spark.read.format(source).options(**defaults)
    if schema is not None:
        reader = reader.schema(schema)
    elif source == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.options(**(options or {})).load(path)


def csv_settings(dialect: ConvertOptions) -> dict[str, str]:
    """Reader options of a CSV dialect."""
    return {
        "header": str(dialect.header).lower(),
        "sep": dialect.delimiter,
        "quote": dialect.quote,
        "escape": dialect.escape,
        "multiLine": str(dialect.multi_line).lower(),
        "dateFormat": CSV_DATE,
        "timestampFormat": CSV_TIMESTAMP,
    }


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    dialect: ConvertOptions = ConvertOptions(),
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read CSV in a dialect.

    Quoted line breaks are honoured by default, which makes Spark read each file in one task.
    Set ``dialect.split`` for large files, which are then read by many tasks (uncompressed UTF-8
    alone), or turn ``dialect.multi_line`` off for files known to have no quoted line breaks.
    """
    if dialect.split and dialect.multi_line:
        check_input(spark, path)
        settings = {**csv_settings(dialect), **(options or {})}
        return split_files.read_quoted_csv(spark, path, settings, schema)
    return read(spark, path, "CSV", schema, {**csv_settings(dialect), **(options or {})})


def read_registered(spark: SparkSession, source: str, path: str, **options: str) -> DataFrame:
    """Read with any data source that the session knows by name."""
    return spark.read.format(source).options(**options).load(path)
