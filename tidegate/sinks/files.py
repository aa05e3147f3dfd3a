"""Writing results as Parquet, JSON or CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidegate.functions.partitioning import SortField
from tidegate.sources import hadoop

# Rows per file for large results, and timestamp patterns of text outputs.
ROWS_PER_FILE = 50_000
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

#: Spark source and options for each output format.
FORMATS: dict[str, tuple[str, dict[str, str]]] = {
    "PARQUET": (
        "parquet",
        {"parquet.enable.dictionary": "true", "parquet.page.write-checksum.enabled": "true"},
    ),
    "JSON": ("json", {"timestampFormat": JSON_TIMESTAMP}),
    "CSV": ("csv", {"header": "true", "timestampFormat": CSV_TIMESTAMP}),
}


def check_format(file_format: str) -> str:
    name = file_format.upper()
    if name not in FORMATS:
        known = ", ".join(FORMATS)
        raise ValueError(f"Unsupported output format: {file_format} (known: {known})")
    return name


def check_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"partition columns not in the data: {', '.join(missing)}")


def gathered(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of one partition value brought together, so that few files are written for it.

    A rebalance, unlike a plain repartition by these columns, lets adaptive execution split a
    value that holds much of the data over many tasks and join small ones.
    """
    return df.hint("rebalance", *names) if names else df


def write(
    df: DataFrame,
    path: str,
    file_format: str = "PARQUET",
    compression: str = "snappy",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[SortField] = (),
    max_records_per_file: int | None = None,
    mode: str = "overwrite",
    options: dict[str, str] | None = None,
) -> None:
    """Write ``df`` below ``path`` in one execution.

    ``max_records_per_file`` caps each file; pass :data:`ROWS_PER_FILE` for small files.
    Spark leaves a ``_SUCCESS`` marker once all tasks have committed.
    """
    source, defaults = FORMATS[check_format(file_format)]
    check_columns(df, partition_by)
    placed = gathered(df, partition_by)
    if sort_by:
        lead = [SortField(n, "asc", "first") for n in partition_by]
        placed = placed.sortWithinPartitions(*(s.column_order() for s in [*lead, *sort_by]))
    writer = placed.write.mode(mode).format(source).options(**{**defaults, **(options or {})})
    writer = writer.option("compression", compression.lower())
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def write_with_marker(df: DataFrame, path: str, file_format: str = "PARQUET") -> str:
    """Write below ``<path>/data`` and put a ``_SUCCESS`` marker into ``path`` itself."""
    data = f"{path.rstrip('/')}/data"
    write(df, data, file_format, compression="none" if file_format.upper() != "PARQUET" else "snappy")
    hadoop.put_marker(df.sparkSession, f"{path.rstrip('/')}/_SUCCESS", "Processing completed successfully")
    return data


def write_registered(df: DataFrame, source: str, path: str, mode: str = "overwrite", **options: str) -> None:
    """Write with any data source that the session knows by name."""
    df.write.mode(mode).format(source).options(**options).save(path)
