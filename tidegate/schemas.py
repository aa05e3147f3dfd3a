"""Schemas of the control-plane tables and the processing states."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Processing states, in the order a file normally passes them.
STATES = (
    "INITIATED",
    "VALIDATING",
    "VALIDATED",
    "STAGING",
    "STAGED",
    "PROCESSING",
    "PROCESSED",
    "LOADING",
    "LOADED",
    "COMPLETED",
    "FAILED",
    "RETRYING",
    "SKIPPED",
)

# Text shown for each state.
STAGE_TEXT = {
    "INITIATED": "File Processing Initiated",
    "VALIDATING": "Validating File and Control File",
    "VALIDATED": "Validation Completed Successfully",
    "STAGING": "Preparing Files for Processing",
    "STAGED": "Files Staged Successfully",
    "PROCESSING": "EMR Serverless Processing",
    "PROCESSED": "Processing Completed Successfully",
    "LOADING": "Loading Data to Target",
    "LOADED": "Data Loaded Successfully",
    "COMPLETED": "All Processing Completed",
    "FAILED": "Processing Failed",
    "RETRYING": "Retrying Failed Processing",
    "SKIPPED": "File Processing Skipped",
}

# Cluster job states after which a run no longer changes.
JOB_SUCCEEDED = "SUCCESS"
JOB_BROKEN = ("FAILED", "CANCELLED")

# Field names and types of the control-plane records.
FILES = "bucket STRING, key STRING, size BIGINT, mod_time TIMESTAMP, etag STRING"

CONTROL = (
    "file_name STRING, file_size BIGINT, file_hash STRING, record_count BIGINT, "
    "column_count INT, created_at TIMESTAMP, batch_id STRING, source_system STRING, "
    "metadata MAP<STRING,STRING>"
)

VALIDATION = (
    "record_count_match BOOLEAN, file_size_match BOOLEAN, checksum_match BOOLEAN, "
    "expected_records BIGINT, actual_records BIGINT, validation_errors ARRAY<STRING>"
)

JOB_DETAILS = (
    "application_id STRING, job_run_id STRING, start_time TIMESTAMP, end_time TIMESTAMP, "
    "status STRING, processed_records BIGINT"
)

LOAD_RESULTS = (
    "target_name STRING, loaded_records BIGINT, rejected_records BIGINT, "
    "load_duration_ms BIGINT, load_id STRING"
)

JOB_EVENT_DETAIL = (
    "jobRunId STRING, applicationId STRING, state STRING, stateDetails STRING, "
    "createdAt STRING, updatedAt STRING, name STRING, executionRole STRING, "
    "jobDriver STRING, configurationOverrides STRING"
)

JOB_EVENT = (
    "version STRING, id STRING, `detail-type` STRING, source STRING, account STRING, "
    f"time STRING, region STRING, detail STRUCT<{JOB_EVENT_DETAIL.replace(' STRING', ': STRING')}>"
)

#: One row per thing that happened to a file within a job. The log is only ever appended to;
#: state, history and counters are queries over it (see ``operators.tracking``).
TRACKING_LOG = (
    "file_path STRING, job_id STRING, event_id STRING, occurred_at TIMESTAMP, kind STRING, "
    "to_state STRING, stage STRING, error_type STRING, error_message STRING, "
    "retryable BOOLEAN, job_run_id STRING, metadata MAP<STRING,STRING>"
)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
