"""Audit columns and row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: runtime label written to the audit columns.
RUNTIME_LABEL = "7.8.0"

SOURCE_SYSTEM = "tidegate"
FRAMEWORK_VERSION = "tidegate-1"


def is_metadata(name: str) -> bool:
    """Columns starting with ``_`` belong to the engine, not to the data."""
    return name.startswith("_")


def data_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if not is_metadata(name)]


def stamp_standard(df: DataFrame, job_id: str, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Audit columns of the standard job."""
    return df.withColumns(
        {
            "_processing_timestamp": F.current_timestamp(),
            "_job_id": F.lit(job_id),
            "_source_system": F.lit(source_system),
            "_emr_version": F.lit(RUNTIME_LABEL),
            "_spark_version": F.lit(df.sparkSession.version),
        }
    )


def stamp_conversion(
    df: DataFrame, job_id: str, target: str, framework_version: str = FRAMEWORK_VERSION
) -> DataFrame:
    """Audit columns of the conversion job."""
    return df.withColumns(
        {
            "_processing_timestamp": F.current_timestamp(),
            "_job_id": F.lit(job_id),
            "_target_name": F.lit(target),
            "_framework_version": F.lit(framework_version),
            "_emr_version": F.lit(RUNTIME_LABEL),
            "_spark_version": F.lit(df.sparkSession.version),
        }
    )


def stamp_basic(df: DataFrame, job_id: str, source_system: str = f"{SOURCE_SYSTEM}-local") -> DataFrame:
    """Audit columns of the basic job."""
    return df.withColumns(
        {
            "_processing_timestamp": F.current_timestamp(),
            "_job_id": F.lit(job_id),
            "_source_system": F.lit(source_system),
        }
    )


def add_row_id(df: DataFrame) -> DataFrame:
    """``_row_id``, unique within the result; neither dense nor the same in another run."""
    return df.withColumn("_row_id", F.monotonically_increasing_id())
