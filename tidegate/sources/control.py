"""Control records, prefix mappings and job events as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.options import Config, Mapping, parse_config

MAPPING = (
    "s3_prefix STRING, target_name STRING, job STRING, file_format STRING, output_format STRING, "
    "max_file_size BIGINT, validate_record_count BOOLEAN, validate_file_size BOOLEAN, "
    "validate_checksum BOOLEAN, required_fields ARRAY<STRING>, position INT"
)


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Control records, one JSON object per line. ``file_path`` may tell the file apart from
    others of the same name. A line that is no JSON gives a row of nulls, which validation
    rejects by reason."""
    schema = schemas.struct(f"file_path STRING, {schemas.CONTROL}")
    return spark.read.schema(schema).json(path)


def load_config(spark: SparkSession, path: str) -> Config:
    """Configuration from one small JSON file."""
    return parse_config(spark.read.text(path, wholetext=True).first()[0])


def mapping_row(mapping: Mapping, position: int) -> tuple:
    return (
        mapping.prefix,
        mapping.target,
        mapping.job,
        mapping.processing.file_format,
        mapping.processing.output_format,
        mapping.processing.max_file_size,
        mapping.rules.validate_record_count,
        mapping.rules.validate_file_size,
        mapping.rules.validate_checksum,
        list(mapping.rules.required_fields),
        position,
    )


def mappings_frame(spark: SparkSession, mappings: Sequence[Mapping]) -> DataFrame:
    """Mappings of a configuration file as rows."""
    rows = [mapping_row(m, i) for i, m in enumerate(mappings)]
    return spark.createDataFrame(rows, MAPPING)


def flatten_job_events(raw: DataFrame) -> DataFrame:
    """Event envelopes to one flat row per event."""
    detail = F.col("detail")
    return raw.select(
        F.col("id").alias("event_id"),
        F.to_timestamp("time").alias("event_time"),
        detail["jobRunId"].alias("job_run_id"),
        detail["applicationId"].alias("application_id"),
        detail["state"].alias("state"),
        detail["stateDetails"].alias("state_details"),
        detail["createdAt"].alias("created_at"),
        detail["updatedAt"].alias("updated_at"),
        detail["name"].alias("name"),
    )


def read_job_events(spark: SparkSession, path: str) -> DataFrame:
    return flatten_job_events(spark.read.schema(schemas.struct(schemas.JOB_EVENT)).json(path))


def stream_job_events(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Job events as files arrive below ``path``."""
    raw = (
        spark.readStream.schema(schemas.struct(schemas.JOB_EVENT))
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    return flatten_job_events(raw)
