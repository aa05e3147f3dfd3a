"""Job events in the envelope they are delivered in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_envelopes(events: DataFrame) -> DataFrame:
    """Flat job events as the nested JSON objects that ``read_job_events`` reads."""
    at = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return events.select(
        F.lit("0").alias("version"),
        F.col("event_id").alias("id"),
        at.alias("time"),
        F.struct(
            F.col("job_run_id").alias("jobRunId"),
            F.col("state"),
            F.col("state_details").alias("stateDetails"),
        ).alias("detail"),
    )
